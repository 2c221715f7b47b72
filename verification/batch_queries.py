"""Queries over batch runs: all feeds delivered in three parts, through bronze, silver, gold and checks.

The second part first arrives with a broken file: its run fails and is taken up again once the file
is mended. Every stored table must then equal what a rebuild from the same three deliveries gives.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Window, functions as F

from cairnlake.plans import batches
from cairnlake.sources import landing
from cairnlake.sources.feeds import FEEDS
from verification import check_queries, gold_queries, join_queries, standins  # noqa: F401
from verification.registry import BRONZE, CTES, REGISTRY, Tables, query, without_keys

#: Each month of a feed belongs to the delivery at the end of its span.
DELIVERIES = {"1996-12": ("0000-00", "1997-01"), "1999-12": ("1997-01", "2000-01"), "2099-12": ("2000-01", "9999-99")}
_DELIVERY = "CASE " + " ".join(f"WHEN batch_id < '{high}' THEN '{name}'" for name, (_, high) in DELIVERIES.items()) + " END"

def _delivered_key(name: str) -> list[str]:
    """The key columns of a feed under their delivered names."""
    delivered = {new: old for old, new in FEEDS[name].rename.items()}
    return [delivered.get(k, k) for k in FEEDS[name].key]


def _last_of_key(name: str) -> str:
    """A delivery holds the last month's rows of each key; rows without a key all count."""
    keys = _delivered_key(name)
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"{missing} OR month = max(month) OVER (PARTITION BY {', '.join(keys)}, batch_id)"


#: The stand-in feeds with deliveries as batches; all later tables follow from them.
DELIVERED = dict(CTES)
for _name, _feed in BRONZE.items():
    DELIVERED[f"months_{_feed}"] = CTES[_feed]
    _parts = f"SELECT * EXCLUDE (batch_id), batch_id AS month, {_DELIVERY} AS batch_id FROM {{months_{_feed}}}"
    DELIVERED[_feed] = f"SELECT * EXCLUDE (month) FROM ({_parts}) QUALIFY {_last_of_key(_name)}"


def _sql(body: str) -> str:
    return standins.with_clause(body, DELIVERED)


def deliver(t: Tables, folder: str, name: str, only: tuple[str, ...] = ()) -> None:
    """The files of one delivery, as the sources would drop them."""
    low, high = DELIVERIES[name]
    feeds = {feed: t.bronze(feed) for feed in only or BRONZE}

    def drop(feed: str) -> None:
        months = feeds[feed].filter((F.col("batch_id") >= low) & (F.col("batch_id") < high))
        keys = _delivered_key(feed)
        last = F.max("batch_id").over(Window.partitionBy(*keys)) == F.col("batch_id")
        rows = months.withColumn("_last", last).filter(" OR ".join([*(f"{k} IS NULL" for k in keys), "_last"])).drop("_last", "batch_id")
        place = f"{folder}/{name}/{feed}"
        if FEEDS[feed].file_format == "parquet":
            rows.write.mode("overwrite").parquet(place)
        elif not months.isEmpty():
            plain = rows.write.mode("overwrite").option("header", True)
            plain.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(place)

    # Sources deliver independently of each other.
    with ThreadPoolExecutor(max_workers=batches.THREADS) as pool:
        list(pool.map(drop, feeds))


_LAKES: dict[tuple[str, str], batches.Lake] = {}


def lake(t: Tables) -> batches.Lake:
    """The lakehouse after all three deliveries, built once per session and data folder."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _LAKES:
        built = batches.Lake(t.spark, t.path("deliveries"), t.path("lake"))
        first, second, third = DELIVERIES
        deliver(t, built.landing, first)
        deliver(t, built.landing, second)
        broken = f"{built.landing}/{second}/cust_master"
        t.spark.range(1).selectExpr("id AS CUST_ID", "id AS CUST_NAME").write.mode("overwrite").option("header", True).csv(broken)
        try:
            batches.run_batches(built)
        except Exception as error:
            if "FAILED_READ_FILE" not in str(error):
                raise
        deliver(t, built.landing, second, ("cust_master",))
        deliver(t, built.landing, third)
        batches.run_batches(built)
        _LAKES[key] = built
    return _LAKES[key]


@query(
    """SELECT * FROM (VALUES ('1996-12', 1, 'completed', false), ('1999-12', 1, 'failed', true), ('1999-12', 2, 'completed', false),
       ('2099-12', 1, 'completed', false)) AS log(batch_id, attempt, status, has_error)
       WHERE EXISTS (SELECT 1 FROM {orders})"""
)
def run_batches(t: Tables) -> DataFrame:
    """The log after the three deliveries: the failed attempt stays visible."""
    return lake(t).log.attempts().select("batch_id", "attempt", "status", F.col("error_message").isNotNull().alias("has_error"))


@query(_sql(" UNION ALL ".join(f"SELECT '{name}' AS feed, batch_id, count(*) AS n_delivered FROM {{{feed}}} GROUP BY batch_id" for name, feed in BRONZE.items())))
def run_batches_audit(t: Tables) -> DataFrame:
    """Delivered rows as each silver load has counted them while it ran."""
    steps = lake(t).log.events().filter("step = 'silver'").select("batch_id", F.explode("counts").alias("what", "n_delivered"))
    counted = steps.filter("what LIKE '%.delivered' AND n_delivered > 0")
    return counted.select(F.regexp_replace("what", "\\.delivered$", "").alias("feed"), "batch_id", "n_delivered")


@query(
    _sql(" UNION ALL ".join(
        f"SELECT '{name}' AS feed, batch_id, batch_id || '/{name}' AS delivered_in, count(*) AS n_rows FROM {{{feed}}} GROUP BY batch_id"
        for name, feed in BRONZE.items()
    ))
)
def bronze_ingested(t: Tables) -> DataFrame:
    """All nineteen feeds as scanned from their delivered files, with the folder that each row came from."""
    found, counts = lake(t), None
    for name in BRONZE:
        rows = landing.read_table(t.spark, found.path("bronze", name), landing.bronze_schema(FEEDS[name]))
        place = F.regexp_extract("source_file", r"([^/]+/[^/]+)/[^/]+$", 1)
        loaded = rows.filter("ingestion_timestamp IS NOT NULL").groupBy(F.lit(name).alias("feed"), "batch_id", place.alias("delivered_in"))
        loaded = loaded.agg(F.count(F.lit(1)).alias("n_rows"))
        counts = loaded if counts is None else counts.unionByName(loaded)
    return counts


@query(_sql(REGISTRY["fact_sales_order"][1]))
def run_batches_orders(t: Tables) -> DataFrame:
    """The stored order fact: each delivery has rebuilt only the orders its changes lead to."""
    return without_keys(batches.gold_tables(lake(t))["fact_sales_order"])


@query(_sql(REGISTRY["fact_sales_order_lines"][1]))
def run_batches_lines(t: Tables) -> DataFrame:
    return without_keys(batches.gold_tables(lake(t))["fact_sales_order_lines"])


@query(_sql(REGISTRY["fact_shipment"][1]))
def run_batches_shipments(t: Tables) -> DataFrame:
    return without_keys(batches.gold_tables(lake(t))["fact_shipment"])


@query(_sql(REGISTRY["dim_customer"][1]))
def run_batches_customers(t: Tables) -> DataFrame:
    return without_keys(batches.gold_tables(lake(t))["dim_customer"])


@query(_sql(REGISTRY["dim_customer_account"][1]))
def run_batches_accounts(t: Tables) -> DataFrame:
    return without_keys(batches.gold_tables(lake(t))["dim_customer_account"])


@query(_sql(REGISTRY["fact_campaign"][1]))
def run_batches_campaigns(t: Tables) -> DataFrame:
    return without_keys(batches.gold_tables(lake(t))["fact_campaign"])


@query(_sql(REGISTRY["bridge_campaign_product"][1]))
def run_batches_bridge(t: Tables) -> DataFrame:
    pairs = without_keys(batches.gold_tables(lake(t))["bridge_campaign_product"])
    return pairs.groupBy("has_campaign", "has_product").agg(F.count(F.lit(1)).alias("n_pairs"))


@query(_sql(REGISTRY["check_report"][1]))
def run_batches_checks(t: Tables) -> DataFrame:
    """The report that the last delivery's run has stored."""
    return t.spark.read.parquet(lake(t).path("reports", max(DELIVERIES), "attempt=1"))
