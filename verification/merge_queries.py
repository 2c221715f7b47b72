"""Queries over upserts and versioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnlake.functions.keys import row_hash
from cairnlake.operators import dedup, keyed, merge, scd2
from cairnlake.plans.silver import customer_batches, customer_history, prepared
from cairnlake.sources.feeds import FEEDS
from verification.registry import CTES, Tables, query
from verification.silver_sql import ROW_HASH, replaced

TRACKED = FEEDS["cust_master"].tracked

# The monthly customer feed delivered in three parts, one row per customer in each.
PARTS = {"a": ("0000-00", "1997-01"), "b": ("1997-01", "1999-01"), "c": ("1999-01", "9999-99")}
ARRIVED = {"a": "2024-01-01", "b": "2024-02-01", "c": "2024-03-01"}
_COLUMNS = ("customer_id", "segment", "manager", "first_manager", "batch_id")
_UPDATED = ("segment", "manager", "batch_id")


def _part(t: Tables, name: str, *more: str) -> DataFrame:
    low, high = PARTS[name]
    months = customer_batches(t.bronze("cust_master")).filter((F.col("batch_id") >= low) & (F.col("batch_id") < high))
    rows = dedup.latest_per_key(months, ["customer_id"], [F.col("batch_id").desc()]).select(
        "customer_id",
        F.col("customer_segment").alias("segment"),
        F.col("customer_account_manager").alias("manager"),
        F.col("customer_account_manager").alias("first_manager"),
        "batch_id",
        *more,
    )
    return merge.with_audit(rows, F.to_date(F.lit(ARRIVED[name])))


def _upserted(t: Tables, order: str, guard: str | None) -> DataFrame:
    state = _part(t, order[0])
    for name in order[1:]:
        state = merge.upsert(state, _part(t, name), ["customer_id"], _UPDATED, guard, null_keys="absent")
    return state


CTES["m_parts"] = " UNION ALL ".join(
    f"""SELECT customer_id, customer_segment AS segment, customer_account_manager AS manager, batch_id,
               '{name}' AS part, '{ARRIVED[name]}' AS arrived
        FROM {{s_customer_batches}} WHERE batch_id >= '{low}' AND batch_id < '{high}'
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY batch_id DESC) = 1"""
    for name, (low, high) in PARTS.items()
)


def _replayed(order: str, guarded: bool) -> str:
    """The state after the parts arrive in this order, from first and winning arrivals."""
    place = f"strpos('{order}', part)"
    # Under the guard the newest batch wins; without it the last arrival does.
    winner = "batch_id" if guarded else place
    # An arrival touches a row when it is its first, or not older than all before it.
    touched = (
        f"batch_id >= max(batch_id) OVER (PARTITION BY customer_id ORDER BY {place} ROWS UNBOUNDED PRECEDING)"
        if guarded
        else "true"
    )
    return f"""
    SELECT customer_id, max_by(segment, {winner}) AS segment, max_by(manager, {winner}) AS manager,
           min_by(manager, {place}) AS first_manager, max_by(batch_id, {winner}) AS batch_id,
           min_by(arrived, {place}) AS created_timestamp,
           max_by(arrived, CASE WHEN touched THEN {place} ELSE 0 END) AS updated_timestamp
    FROM (SELECT *, {touched} AS touched FROM {{m_parts}}) p GROUP BY customer_id"""


@query(_replayed("abc", True))
def upsert_guarded(t: Tables) -> DataFrame:
    return _upserted(t, "abc", "batch_id")


@query(_replayed("cab", True))
def upsert_late_batch(t: Tables) -> DataFrame:
    """Older parts arrive after the newest: they insert what is missing and change nothing else."""
    return _upserted(t, "cab", "batch_id")


@query(_replayed("cab", False))
def upsert_plain(t: Tables) -> DataFrame:
    return _upserted(t, "cab", None)


@query(_replayed("abc", True))
def upsert_stored(t: Tables) -> DataFrame:
    """The three parts written one after the other to a table partitioned by the customer's city."""
    path, city = t.path("contacts"), "customer_city_id"
    for name in "abc":
        rows = _part(t, name, city).drop(*merge.AUDIT_COLUMNS)
        at = F.to_date(F.lit(ARRIVED[name]))
        merge.upsert_table(path, rows, ["customer_id"], _UPDATED, city, "batch_id", at, null_keys="absent")
    schema = merge.with_audit(rows, at).schema
    return merge.stored(t.spark, path, schema).drop(city)


def _stored_by(t: Tables, partition: str, value) -> DataFrame:
    """The three parts upserted one after the other into a table with this partition column."""
    path = t.path("contacts")
    for name in "abc":
        rows = _part(t, name, "customer_city_id").drop(*merge.AUDIT_COLUMNS).withColumn(partition, value)
        rows = rows if partition == "customer_city_id" else rows.drop("customer_city_id")
        at = F.to_date(F.lit(ARRIVED[name]))
        merge.upsert_table(path, rows, ["customer_id"], _UPDATED, partition, "batch_id", at, null_keys="absent")
    return merge.stored(t.spark, path, merge.with_audit(rows, at).schema)


@query(_replayed("abc", True))
def upsert_stored_null_partition(t: Tables) -> DataFrame:
    """A third of the customers have no city and share the NULL partition."""
    city = F.col("customer_city_id")
    no_city = F.when(F.pmod(F.xxhash64("customer_id"), F.lit(3)) != 0, city)
    return _stored_by(t, "customer_city_id", no_city).drop("customer_city_id")


@query(_replayed("abc", True))
def upsert_stored_moved_key(t: Tables) -> DataFrame:
    """Customers whose segment changes move to another partition."""
    return _stored_by(t, "segment", F.col("segment"))


@query(_replayed("abc", True))
def upsert_stored_boolean_partition(t: Tables) -> DataFrame:
    """Customers move between two partitions named by a truth value."""
    return _stored_by(t, "urgent", F.col("segment") < "3").drop("urgent")


def _keyed(t: Tables, order: str, **layout) -> DataFrame:
    """The parts upserted one after the other into a table whose rows keep their partition."""
    path = t.path("keyed")
    for name in order:
        rows = _part(t, name).drop(*merge.AUDIT_COLUMNS)
        more = {"batch": name} if "guard" in layout else {}
        keyed.upsert_keyed(path, rows, ["customer_id"], _UPDATED, at=F.to_date(F.lit(ARRIVED[name])), **more, **layout)
    return merge.stored(t.spark, path, merge.with_audit(rows, F.to_date(F.lit(ARRIVED[name]))).schema)


@query(_replayed("cab", True))
def upsert_keyed_batches(t: Tables) -> DataFrame:
    """Guarded, each customer in the partition of the delivery that brought it first."""
    return _keyed(t, "cab", guard="batch_id")


@query(_replayed("cab", False))
def upsert_gold_stored(t: Tables) -> DataFrame:
    """Unguarded, in hash buckets of the key: only the buckets of a delivery are read and rewritten."""
    return _keyed(t, "cab", buckets=["customer_id"])


@query(
    """SELECT campaign_id, campaign_sku, CASE WHEN CAST(campaign_id AS INT) < 15 THEN 'old' ELSE 'new' END AS origin
       FROM {s_campaign_sku}
       UNION ALL SELECT NULL, 'no campaign', 'old'"""
)
def upsert_insert_only(t: Tables) -> DataFrame:
    """Links are added, never changed; a link with a NULL side is not added a second time."""
    links = t.silver("campaign_sku").select("campaign_id", "campaign_sku")
    unresolved = links.select(F.lit(None).cast("string").alias("campaign_id"), F.lit("no campaign").alias("campaign_sku"))
    unresolved = unresolved.distinct()
    target = links.filter(F.col("campaign_id").cast("int") < 15).unionByName(unresolved).withColumn("origin", F.lit("old"))
    source = links.unionByName(unresolved).withColumn("origin", F.lit("new"))
    return merge.insert_new(target, source, ["campaign_id", "campaign_sku"])


@query(
    """SELECT order_number, CASE WHEN order_status = 'Pending' AND order_number IN
                  (SELECT order_id FROM {s_shipment} WHERE delivery_date IS NOT NULL)
              THEN 'Delivered' ELSE order_status END AS order_status FROM {s_sales_order}"""
)
def update_only_state(t: Tables) -> DataFrame:
    """A delivery moves a pending order on; orders in another state and unknown orders are left alone."""
    delivered = (
        t.silver("shipment")
        .filter("delivery_date IS NOT NULL AND order_id IS NOT NULL")
        .select(F.col("order_id").alias("order_number"))
        .distinct()
        .withColumn("order_status", F.lit("Delivered"))
    )
    orders = t.silver("sales_order").select("order_number", "order_status")
    return merge.update_matched(
        orders, delivered, ["order_number"], ["order_status"], when=F.col("order_status") == "Pending"
    )


@query("SELECT CUST_ID AS customer_id, batch_id, count(*) AS n_rows FROM {f_cust_master} GROUP BY ALL HAVING count(*) > 1")
def merge_ambiguity_check(t: Tables) -> DataFrame:
    return merge.ambiguous_keys(prepared(t.bronze("cust_master"), FEEDS["cust_master"]), ["customer_id", "batch_id"])


_VERSION_DATES = ("customer_created_date", "valid_from", "valid_to")


@query(replaced("s_cust_master", _VERSION_DATES))
def scd2_history(t: Tables) -> DataFrame:
    return customer_history(t.bronze("cust_master"))


@query(replaced("s_cust_master", _VERSION_DATES))
def scd2_merge(t: Tables) -> DataFrame:
    """History of all batches but the last, then the last one merged as a single step."""
    months = customer_batches(t.bronze("cust_master"))
    last = t.bronze("cust_master").agg(F.max("batch_id").alias("batch_id"))
    before = months.join(last, "batch_id", "left_anti").select(*months.columns)
    batch = months.join(last, "batch_id", "left_semi").select(*months.columns)
    return scd2.merge_versions(scd2.history(before, "customer_id", TRACKED), batch, "customer_id", TRACKED)


@query(replaced("s_cust_master", _VERSION_DATES))
def scd2_stored(t: Tables) -> DataFrame:
    """History up to May 2001 stored, then every later month applied to the stored table, one of them twice."""
    path = t.path("versions")
    months = customer_batches(t.bronze("cust_master"))
    old = scd2.history(months.filter("batch_id <= '2001-05'"), "customer_id", TRACKED)
    scd2.store_history(old, path)
    late = months.filter("batch_id > '2001-05'").select("batch_id").distinct().orderBy("batch_id").collect()
    for batch in [late[0], *late]:
        rows = months.filter(F.col("batch_id") == batch.batch_id)
        scd2.merge_stored(path, rows, "customer_id", TRACKED)
    return merge.stored(t.spark, path, old.schema)


@query(replaced("s_cust_master", _VERSION_DATES))
def scd2_stored_corrected(t: Tables) -> DataFrame:
    """The last month arrives twice: first with wrong segments for half of the customers, then as it is."""
    path = t.path("versions")
    months = customer_batches(t.bronze("cust_master"))
    last = months.agg(F.max("batch_id")).first()[0]
    old = scd2.history(months.filter(F.col("batch_id") < last), "customer_id", TRACKED)
    scd2.store_history(old, path)
    right = months.filter(F.col("batch_id") == last)
    wrong = F.when(F.pmod(F.xxhash64("customer_id"), F.lit(2)) == 0, F.lit("WRONG")).otherwise(F.col("customer_segment"))
    for delivery in (right.withColumn("customer_segment", wrong), right):
        scd2.merge_stored(path, delivery, "customer_id", TRACKED)
    return merge.stored(t.spark, path, old.schema)


@query(replaced("s_cust_master", _VERSION_DATES))
def scd2_stored_withdrawn(t: Tables) -> DataFrame:
    """The last month first arrives with every customer in a wrong segment, then with those it should have held."""
    path = t.path("versions")
    months = customer_batches(t.bronze("cust_master"))
    last = months.agg(F.max("batch_id")).first()[0]
    old = scd2.history(months.filter(F.col("batch_id") < last), "customer_id", TRACKED)
    scd2.store_history(old, path)
    everyone = dedup.latest_per_key(months, ["customer_id"], [F.col("batch_id").desc()])
    wrong = everyone.withColumns({"batch_id": F.lit(last), "customer_segment": F.lit("WRONG")})
    for delivery in (wrong, months.filter(F.col("batch_id") == last)):
        scd2.merge_stored(path, delivery, "customer_id", TRACKED, whole=True)
    return merge.stored(t.spark, path, old.schema)


@query(replaced("s_cust_master", _VERSION_DATES))
def scd2_stored_null_key(t: Tables) -> DataFrame:
    """Every delivery also holds each customer once more without an id; none of these is versioned."""
    path = t.path("versions")
    months = customer_batches(t.bronze("cust_master"))
    first, last = months.agg(F.min("batch_id"), F.max("batch_id")).first()
    middle = scd2.history(months.filter((F.col("batch_id") > first) & (F.col("batch_id") < last)), "customer_id", TRACKED)
    for batch in (first, last):
        rows = months.filter(F.col("batch_id") == batch)
        nameless = rows.withColumn("customer_id", F.lit(None).cast("string"))
        scd2.merge_stored(path, rows.unionByName(nameless), "customer_id", TRACKED)
        if batch == first:
            known = merge.stored(t.spark, path, middle.schema).select(*months.columns)
            both = scd2.history(months.filter(F.col("batch_id") < last), "customer_id", TRACKED)
            assert known.filter("customer_id IS NULL").isEmpty()
            both.write.mode("overwrite").partitionBy("valid_to").parquet(path)
    return merge.stored(t.spark, path, middle.schema)


@query(f"SELECT customer_id, batch_id, {ROW_HASH} AS row_hash FROM {{s_customer_batches}}", name="row_hash")
def hash_of_tracked(t: Tables) -> DataFrame:
    return customer_batches(t.bronze("cust_master")).select("customer_id", "batch_id", row_hash(TRACKED).alias("row_hash"))


@query(
    f"""SELECT customer_id, customer_segment, {ROW_HASH} AS row_hash, '1994-08-01' AS valid_from,
               CAST(NULL AS VARCHAR) AS valid_to, true AS is_current
        FROM {{s_customer_batches}}
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY batch_id DESC) = 1"""
)
def scd2_backfill(t: Tables) -> DataFrame:
    months = customer_batches(t.bronze("cust_master"))
    type_1 = dedup.latest_per_key(months, ["customer_id"], [F.col("batch_id").desc()])
    return scd2.backfill(type_1, TRACKED, "1994-08-01").select(
        "customer_id", "customer_segment", *scd2.VERSION_COLUMNS
    )


@query("SELECT customer_id, customer_segment, CAST(valid_from AS VARCHAR) AS valid_from FROM {s_cust_master} WHERE valid_to IS NULL")
def scd2_current(t: Tables) -> DataFrame:
    return scd2.current_versions(t.silver("cust_master")).select("customer_id", "customer_segment", "valid_from")


_LATE_END = "CASE WHEN CAST(customer_id AS BIGINT) % 7 = 0 THEN valid_to + 20 ELSE valid_to END"


CTES["m_late_versions"] = f"SELECT customer_id, valid_from, {_LATE_END} AS valid_to FROM {{s_cust_master}}"


@query(
    """SELECT a.customer_id, CAST(a.valid_from AS VARCHAR) AS valid_from, CAST(a.valid_to AS VARCHAR) AS ends,
               CAST(min(b.valid_from) AS VARCHAR) AS next_valid_from
        FROM {m_late_versions} a JOIN {m_late_versions} b ON a.customer_id = b.customer_id AND a.valid_from < b.valid_from
        WHERE coalesce(a.valid_to, DATE '2999-12-31') > b.valid_from
        GROUP BY a.customer_id, a.valid_from, a.valid_to"""
)
def scd2_overlap_check(t: Tables) -> DataFrame:
    """Every seventh customer's versions are made to end twenty days too late."""
    late = (F.col("customer_id").cast("long") % 7 == 0) & F.col("valid_to").isNotNull()
    versions = t.silver("cust_master").withColumn(
        "valid_to", F.when(late, F.date_add("valid_to", 20)).otherwise(F.col("valid_to"))
    )
    return scd2.overlapping_versions(versions, "customer_id")


@query(
    """SELECT count(*) AS total_rows, count(DISTINCT customer_id) AS n_keys, count(*) FILTER (WHERE is_current) AS current_versions,
              count(*) FILTER (WHERE NOT is_current) AS closed_versions, count(DISTINCT row_hash) AS distinct_hashes
       FROM {s_cust_master}"""
)
def scd2_profile(t: Tables) -> DataFrame:
    return scd2.profile(t.silver("cust_master"), "customer_id")


@query(
    """SELECT customer_id, customer_segment, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
              is_current FROM {s_cust_master} ORDER BY customer_id, valid_from"""
)
def scd2_customer_history(t: Tables) -> DataFrame:
    versions = t.silver("cust_master").select("customer_id", "customer_segment", "valid_from", "valid_to", "is_current")
    return versions.orderBy("customer_id", "valid_from")


@query(
    """SELECT customer_id, count(*) AS versions FROM {s_cust_master} GROUP BY customer_id HAVING count(*) > 1
       ORDER BY versions DESC, customer_id LIMIT 10"""
)
def top_changed_keys(t: Tables) -> DataFrame:
    counts = t.silver("cust_master").groupBy("customer_id").agg(F.count(F.lit(1)).alias("versions"))
    return counts.filter("versions > 1").orderBy(F.col("versions").desc(), "customer_id").limit(10)
