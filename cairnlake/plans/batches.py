"""Batch runs: the next delivered month through bronze, silver, gold and checks, from log to log.

A month costs what it touches. Each stored upsert hands on the keys it changed, with the old and
new values of the columns that other tables refer to; gold rebuilds only the orders, lines, shipments,
customers and campaigns these lead to. The change sets of all attempts of a batch are kept, so an
attempt that goes on behind a failed one still knows what that one changed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cairnlake.functions.calendar import calendar, spanning_bounds
from cairnlake.operators import checks, clean, joins, keyed, merge, scd2, skew
from cairnlake.operators.batch_log import BatchLog, landed_batches
from cairnlake.plans import dimensions, facts, silver, warehouse
from cairnlake.sources import landing
from cairnlake.sources.feeds import FEEDS

#: Columns by which gold finds what a changed silver row leads to.
CARRIED = {
    "address": ("customer_id",),
    "campaign_log": ("campaign_id",),
    "invoice": ("order_id", "invoice_date"),
    "payment": ("invoice_number", "payment_date"),
    "sales_order": ("order_date",),
    "shipment": ("order_id", "ship_date", "delivery_date"),
}
#: Tables that do not depend on each other are loaded side by side.
THREADS = 8
#: Stored schemas of silver tables, which follow from the feeds' declarations.
_SCHEMAS: dict[str, T.StructType] = {}


@dataclass(frozen=True)
class Lake:
    """The folders of one lakehouse: delivered files, bronze, silver, gold, change sets, the batch log."""

    spark: SparkSession
    landing: str
    root: str

    @property
    def log(self) -> BatchLog:
        return BatchLog(self.spark, f"{self.root}/log")

    def path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def empty(self, schema: T.StructType) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def silver_schema(self, name: str) -> T.StructType:
        if name not in _SCHEMAS:
            bare = self.empty(landing.bronze_schema(FEEDS[name]))
            if FEEDS[name].tracked:
                shaped = scd2.open_versions(silver.customer_batches(bare, name), FEEDS[name].tracked, scd2.batch_start())
            else:
                shaped = merge.with_audit(silver.conform(bare, name))
            _SCHEMAS[name] = shaped.schema
        return _SCHEMAS[name]

    def silver(self, name: str) -> DataFrame:
        """A stored silver table without its audit columns; no rows before its first load."""
        schema = self.silver_schema(name)
        found = merge.stored(self.spark, self.path("silver", name), schema)
        return (self.empty(schema) if found is None else found).drop(*merge.AUDIT_COLUMNS)

    def gold(self, name: str, like: DataFrame) -> DataFrame | None:
        """A stored gold table with the columns of ``like``, or None before its first load."""
        return merge.stored(self.spark, self.path("gold", name), like.schema)

    def declare(self, name: str, df: DataFrame) -> None:
        """Keep the schema of a gold table."""
        row = self.spark.range(1).select(F.lit(name).alias("name"), F.lit(df.schema.json()).alias("schema"))
        row.coalesce(1).write.mode("overwrite").parquet(self.path("schemas", f"table={name}"))

    def changes(self, batch: str, name: str, schema: str | None = None) -> DataFrame | None:
        """What any attempt at this batch has noted under ``name``, or None."""
        try:
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return reader.parquet(self.path("changes", batch, name)).drop("attempt")
        except Exception as missing:
            if getattr(missing, "getCondition", lambda: None)() == "PATH_NOT_FOUND":
                return None
            raise

    def note(self, batch: str, attempt: int, name: str, df: DataFrame) -> DataFrame:
        """Keep a change set; returns those of all attempts."""
        df.write.mode("overwrite").parquet(self.path("changes", batch, name, f"attempt={attempt}"))
        return self.changes(batch, name).distinct()


def _side_by_side(work: Callable[[str], None], names: Sequence[str]) -> None:
    with ThreadPoolExecutor(max_workers=THREADS) as pool:
        list(pool.map(work, names))


def bronze_step(lake: Lake, batch: str, attempt: int, names: Sequence[str]) -> dict[str, int]:
    """Every feed's delivered file replaces the batch's partition; a feed that sent no file has no rows."""
    delivered = {r[0] for r in landed_batches(lake.spark, f"{lake.landing}/{batch}").collect()}

    def load(name: str) -> None:
        feed, table = FEEDS[name], lake.path("bronze", name)
        if name in delivered:
            landing.ingest(lake.spark, feed, lake.landing, table, batch)
        else:
            schema = T.StructType([f for f in landing.bronze_schema(feed).fields if f.name != "batch_id"])
            landing.replace_batch(lake.empty(schema), table, batch)

    _side_by_side(load, names)
    return {"feeds": len(delivered & set(names))}


def silver_step(lake: Lake, batch: str, attempt: int, names: Sequence[str]) -> dict[str, int]:
    """Each feed's batch upserted into its stored table, rows staying in the partition of the batch that brought them."""
    counts: dict[str, int] = {}

    def load(name: str) -> None:
        feed, path = FEEDS[name], lake.path("silver", name)
        bronze = landing.read_batch(lake.spark, lake.path("bronze", name), batch, landing.bronze_schema(feed))
        trail = clean.AuditTrail()
        if feed.tracked:
            rows = silver.customer_batches(bronze, feed, trail)
            stored = merge.stored(lake.spark, path, lake.silver_schema(name))
            known = rows.select(*feed.key)
            if stored is not None:
                # Customers that an earlier delivery of this batch gave a version.
                known = known.union(stored.filter(F.col("valid_from") == scd2.batch_start(F.lit(batch))).select(*feed.key))
            lake.note(batch, attempt, name, known.distinct())
            scd2.merge_stored(path, rows, feed.key[0], feed.tracked, whole=True)
        else:
            rows = silver.conform(bronze, feed, trail)
            keyed.upsert_keyed(
                path, rows, feed.key, feed.update_columns(rows.columns), batch=batch, guard="batch_id", unique=True,
                carried=CARRIED.get(name, ()), changes_path=lake.path("changes", batch, name, f"attempt={attempt}"),
            )
        counts.update({f"{name}.{step}": n for step, n in trail.counts().items()})

    _side_by_side(load, names)
    return counts


def _any_of(*frames: DataFrame | None) -> DataFrame | None:
    found = [f for f in frames if f is not None]
    return reduce(DataFrame.union, found).distinct() if found else None


def _keyed(df: DataFrame, keys: DataFrame | None, on: str) -> DataFrame:
    """The rows of ``df`` whose ``on`` is among ``keys`` (one column of that name)."""
    return df.limit(0) if keys is None else df.join(joins.broadcast_if_small(keys), on, "left_semi").select(*df.columns)


def _upsert_gold(lake: Lake, name: str, fresh: DataFrame, buckets: Sequence[str] = (), batch: str | None = None, replaces: tuple[str, DataFrame] | None = None) -> None:
    lake.declare(name, fresh)
    keys = warehouse.GOLD_KEYS.get(name, ("date_id",))
    update = [c for c in fresh.columns if c not in keys]
    keyed.upsert_keyed(lake.path("gold", name), fresh, keys, update, batch=batch, buckets=buckets, unique=True, replaces=replaces)


def _customers(lake: Lake, batch: str, attempt: int, s: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Both customer dimensions for touched customers.

    Returns what orders have to follow: customers with the first day from which another version holds (NULL:
    from the start), and accounts whose terms are new.
    """
    versions, address, cities, regions = (s[n] for n in ("cust_master", "address", "cities", "regions"))
    moved = lake.changes(batch, "cities")
    if (renamed := lake.changes(batch, "regions")) is not None:
        moved = _any_of(moved.select("city_id"), _keyed(cities, renamed.select("region_id"), "region_id").select("city_id"))
    in_moved = None if moved is None else _keyed(versions, moved.select(F.col("city_id").alias("customer_city_id")), "customer_city_id").select("customer_id")
    addressed = lake.changes(batch, "address")
    known = lake.changes(batch, "cust_master")
    who = _any_of(
        None if known is None else known.select("customer_id"), None if addressed is None else keyed.touched(addressed, "customer_id"), in_moved
    )
    who = lake.note(batch, attempt, "gold_who", who)
    of_who = [_keyed(versions, who, "customer_id"), _keyed(address, who, "customer_id"), cities, regions]

    fresh = keyed.kept(dimensions.dim_customer(*of_who), "customers")
    old = lake.gold("dim_customer", fresh)
    then = (lake.empty(fresh.schema) if old is None else old).join(joins.broadcast_if_small(who), "customer_id", "left_semi")
    ends = lambda c: scd2.end_or_far_future(c)
    now = fresh.select("customer_id", "customer_sk", F.col("valid_from").alias("a"), ends("valid_to").alias("b"), F.col("customer_name").alias("n"))
    was = then.select(F.col("customer_id").alias("_id"), F.col("customer_sk").alias("_sk"), F.col("valid_from").alias("_a"), ends("valid_to").alias("_b"), F.col("customer_name").alias("_n"))
    both = now.join(was, now.customer_sk == was["_sk"], "full_outer")
    since = (
        F.when(F.col("_sk").isNull(), F.col("a")).when(F.col("customer_sk").isNull(), F.col("_a"))
        .when(~F.col("n").eqNullSafe(F.col("_n")), F.col("a")).when(F.col("b") != F.col("_b"), F.least("b", "_b"))
    )
    followed = both.select(F.coalesce("customer_id", "_id").alias("customer_id"), since.alias("since")).filter("since IS NOT NULL")
    followed = lake.note(batch, attempt, "gold_since", followed.groupBy("customer_id").agg(F.min("since").alias("since")))
    _upsert_gold(lake, "dim_customer", fresh, buckets=["customer_id"], replaces=("customer_id", who))

    accounts = keyed.kept(dimensions.dim_customer_account(*of_who), "accounts")
    other_terms = keyed.differing(accounts, lake.gold("dim_customer_account", accounts), ["bill_to_account_sk"], ["account_payment_terms"])
    other_terms = lake.note(batch, attempt, "gold_terms", other_terms.select(F.col("account_id").alias("customer_id")))
    _upsert_gold(lake, "dim_customer_account", accounts, buckets=["account_id"], replaces=("account_id", who.withColumnRenamed("customer_id", "account_id")))
    return followed, other_terms


def _references(lake: Lake, batch: str, attempt: int, s: dict[str, DataFrame]) -> DataFrame:
    """Products, campaigns, their bridge and the calendar. Returns the numbers of products that are new."""
    products = keyed.kept(dimensions.dim_product(s["products"], s["product_sub_categories"]), "products")

    def load_products() -> DataFrame:
        old = lake.gold("dim_product", products)
        arrived = keyed.differing(products, old, ["product_sk"], ["product_id"]).select(F.col("product_id").alias("product_sku")).filter("product_sku IS NOT NULL")
        arrived = lake.note(batch, attempt, "gold_products", arrived)
        _upsert_gold(lake, "dim_product", keyed.differing(products, old, ["product_sk"]), buckets=["product_sk"])
        return arrived

    def load_campaigns() -> None:
        if (logged := lake.changes(batch, "campaign_log")) is not None:
            log = keyed.kept(_keyed(s["campaign_log"], logged.select("campaign_id").distinct(), "campaign_id"), "campaign-log")
            _upsert_gold(lake, "dim_campaign", dimensions.dim_campaign(log), buckets=["campaign_sk"])
            of_log = facts.fact_campaign(log, dimensions.dim_campaign(log))
            _upsert_gold(lake, "fact_campaign", of_log, buckets=["campaign_sk"])

    def load_calendar() -> None:
        dated = [(lake.changes(batch, t), f"_new_{c}") for t, c in (("sales_order", "order_date"), ("invoice", "invoice_date"), ("payment", "payment_date"), ("shipment", "ship_date"), ("shipment", "delivery_date"))]
        days = calendar(spanning_bounds(*[(d, c) for d, c in dated if d is not None]))
        if (held := lake.gold("dim_date", days)) is not None:
            # The calendar has no gap between what it holds and what arrives.
            days = calendar(spanning_bounds((held, "full_date"), *[(d, c) for d, c in dated if d is not None]))
        _upsert_gold(lake, "dim_date", keyed.differing(days, held, ["date_id"], []), buckets=["date_id"])

    with ThreadPoolExecutor(max_workers=3) as pool:
        arrived, *others = [pool.submit(load) for load in (load_products, load_campaigns, load_calendar)]
        for loaded in (arrived, *others):
            loaded.result()
    campaigns = dimensions.dim_campaign(s["campaign_log"].limit(0))
    campaigns = lake.gold("dim_campaign", campaigns) or lake.empty(campaigns.schema)
    bridge = dimensions.bridge_campaign_product(s["campaign_sku"], campaigns, lake.gold("dim_product", products))
    lake.declare("bridge_campaign_product", bridge)
    warehouse.publish(bridge, lake.path("gold", "bridge_campaign_product"))
    return arrived.result()


def gold_step(lake: Lake, batch: str, attempt: int, names: Sequence[str]) -> dict[str, int]:
    """Gold rows that the batch's change sets lead to, upserted into the stored tables."""
    s = {name: lake.silver(name) for name in names}
    with ThreadPoolExecutor(max_workers=2) as pool:
        references = pool.submit(_references, lake, batch, attempt, s)
        since, terms = _customers(lake, batch, attempt, s)
        products_new = references.result()
    orders, invoices, payments, lines, shipments = (s[n] for n in ("sales_order", "invoice", "payment", "sales_order_lines", "shipment"))

    def order(df: DataFrame, column: str = "order_number") -> DataFrame:
        return df.select(F.col(column).alias("order_number")).filter("order_number IS NOT NULL")

    found: list[DataFrame] = []
    if (ch := lake.changes(batch, "sales_order")) is not None:
        found.append(order(ch))
    if (ch := lake.changes(batch, "invoice")) is not None:
        found.append(keyed.touched(ch, "order_id", "order_number"))
    if (ch := lake.changes(batch, "payment")) is not None:
        found.append(order(_keyed(invoices, keyed.touched(ch, "invoice_number"), "invoice_number"), "order_id"))
    if (ch := lake.changes(batch, "exchange_rates")) is not None:
        months = ch.select("currency", "rate_month").distinct().withColumn("_rated", F.lit(True))
        found.append(order(joins.in_month(invoices, months, "currency", "invoice_date", "rate_month", ["_rated"]).filter("_rated"), "order_id"))
    if (ch := lake.changes(batch, "channels")) is not None:
        found.append(order(_keyed(orders, ch.select("channel_code"), "channel_code")))
    found.append(order(orders.join(joins.broadcast_if_small(since), "customer_id").filter(F.to_date("order_date") >= F.col("since"))))
    found.append(order(_keyed(orders, terms, "customer_id")))
    which = lake.note(batch, attempt, "gold_orders", reduce(DataFrame.union, found).distinct())
    by_id = which.withColumnRenamed("order_number", "order_id")

    billed = keyed.kept(_keyed(invoices, by_id, "order_id"), "billed")
    customers = lake.gold("dim_customer", dimensions.dim_customer(s["cust_master"].limit(0), s["address"], s["cities"], s["regions"]))
    accounts = lake.gold("dim_customer_account", dimensions.dim_customer_account(s["cust_master"].limit(0), s["address"], s["cities"], s["regions"]))
    some = keyed.kept(_keyed(orders, which, "order_number"), "orders")
    fresh = facts.fact_sales_order(
        some, billed, _keyed(payments, billed.select("invoice_number").distinct(), "invoice_number"), s["exchange_rates"],
        customers, accounts, s["channels"], hot_customers=skew.hot_keys(some, "customer_id"),
    )
    _upsert_gold(lake, "fact_sales_order", fresh, batch=batch)

    stored_orders = lake.gold("fact_sales_order", fresh)
    products = lake.gold("dim_product", dimensions.dim_product(s["products"].limit(0), s["product_sub_categories"]))

    def load_lines() -> None:
        ch = lake.changes(batch, "sales_order_lines")
        ids = _any_of(
            None if ch is None else ch.select("order_line_id"), _keyed(lines, by_id, "order_id").select("order_line_id"), _keyed(lines, products_new, "product_sku").select("order_line_id")
        )
        some = _keyed(lines, keyed.kept(ids, "line-ids"), "order_line_id")
        _upsert_gold(lake, "fact_sales_order_lines", facts.fact_sales_order_lines(some, stored_orders, products), batch=batch)

    def load_shipments() -> None:
        # An order's shipments are counted together, so all of them come along.
        ch = lake.changes(batch, "shipment")
        shipped = _any_of(by_id, None if ch is None else keyed.touched(ch, "order_id"))
        ids = _any_of(_keyed(shipments, shipped, "order_id").select("shipment_id"), None if ch is None else ch.select("shipment_id"))
        some = keyed.kept(_keyed(shipments, keyed.kept(ids, "shipment-ids"), "shipment_id"), "shipments")
        _upsert_gold(lake, "fact_shipment", facts.fact_shipment(some, stored_orders, skew.hot_keys(some, "order_id")), batch=batch)

    with ThreadPoolExecutor(max_workers=2) as pool:
        for loaded in [pool.submit(load_lines), pool.submit(load_shipments)]:
            loaded.result()
    return {"orders": which.count()}


def gold_tables(lake: Lake) -> dict[str, DataFrame]:
    """The stored gold tables as they stand; a table without rows has no files, so schemas are declared."""
    declared = lake.spark.read.parquet(lake.path("schemas")).collect()
    schemas = {r["name"]: T.StructType.fromJson(json.loads(r["schema"])) for r in declared}
    found = {name: merge.stored(lake.spark, lake.path("gold", name), schema) for name, schema in schemas.items()}
    return {name: lake.empty(schemas[name]) if df is None else df for name, df in found.items()}


def checks_step(lake: Lake, batch: str, attempt: int, names: Sequence[str]) -> dict[str, int]:
    """The whole check suite over stored silver and gold; a failed check fails the batch."""
    report = warehouse.all_checks({name: lake.silver(name) for name in names}, gold_tables(lake))
    report.write.mode("overwrite").parquet(lake.path("reports", batch, f"attempt={attempt}"))
    stored = lake.spark.read.schema(report.schema).parquet(lake.path("reports", batch, f"attempt={attempt}"))
    checks.require_passed(stored)
    return {"checks": stored.count()}


STEPS = (("bronze", bronze_step), ("silver", silver_step), ("gold", gold_step), ("checks", checks_step))


def run_batch(lake: Lake, batch: str, names: Sequence[str] = tuple(FEEDS), again: bool = False) -> bool:
    """Take one batch through all steps. False if another run has it or it is done.

    Steps that a failed attempt has finished are not repeated: each is kept in the log, and what it
    changed is stored. A step that died half-way is run again; all of them may be. ``again`` takes a
    completed batch once more, after its files were delivered again.
    """
    attempt = lake.log.claim(batch, again)
    if attempt is None:
        return False
    try:
        finished = lake.log.finished_steps(batch)
        for name, step in STEPS:
            if name not in finished:
                lake.log.finish_step(batch, attempt, name, step(lake, batch, attempt, names))
    except Exception as error:
        lake.log.fail(batch, attempt, f"{type(error).__name__}: {str(error)[:2000]}")
        raise
    lake.log.complete(batch, attempt)
    return True


def next_batch(lake: Lake) -> str | None:
    """The oldest delivered batch that no run works on or has completed."""
    log = lake.log.states().select("batch_id", "status")
    found = landing.next_batch(landed_batches(lake.spark, lake.landing), log).first()
    return None if found is None else found["batch_id"]


def run_batches(lake: Lake, names: Sequence[str] = tuple(FEEDS)) -> list[str]:
    """All pending batches, oldest first; the first failure ends the run. Returns those completed."""
    done: list[str] = []
    tried: set[str] = set()
    while (batch := next_batch(lake)) is not None and batch not in tried:
        tried.add(batch)
        if run_batch(lake, batch, names):
            done.append(batch)
    return done
