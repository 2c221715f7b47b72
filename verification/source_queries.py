"""Queries over scans, bronze writes and batch discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnlake.sources import landing
from cairnlake.sources.feeds import FEEDS
from verification.registry import BRONZE, Tables, query


@query(
    """SELECT CUST_ID, CUST_NAME, SEGMENT, CREDIT_LIMIT, PAYMENT_TERMS, ACCOUNT_MANAGER, CITY_ID,
              CAST(CREATED_DT AS VARCHAR) AS CREATED_DT, ACTIVE_FLAG FROM {f_cust_master}"""
)
def scan_csv_declared(t: Tables) -> DataFrame:
    path = t.path("csv")
    out = t.feed("f_cust_master").drop("batch_id").write.option("header", True)
    out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return landing.scan_csv(t.spark, path, FEEDS["cust_master"].struct)


@query(
    """SELECT payment_id, invoice_no, CAST(CAST(pay_date AS DATE) AS VARCHAR) AS pay_date, amount, method,
              CAST(CAST(_loaded_at AS DATE) AS VARCHAR) AS _loaded_at FROM {f_payment}"""
)
def scan_parquet_declared(t: Tables) -> DataFrame:
    path = t.path("parquet")
    t.feed("f_payment").write.parquet(path)
    return landing.scan_parquet(t.spark, path, FEEDS["payment"].struct)


@query("SELECT ORDER_NO, CUST_ID, CASE WHEN batch_id >= '1998-01' THEN order_source END AS order_source FROM {f_sales_order}")
def scan_schema_drift(t: Tables) -> DataFrame:
    """Files written before ``order_source`` existed read NULL for it."""
    older, newer = t.path("old"), t.path("new")
    orders = t.feed("f_sales_order")
    orders.filter("batch_id < '1998-01'").drop("order_source", "batch_id").write.parquet(older)
    orders.filter("batch_id >= '1998-01'").drop("batch_id").write.parquet(newer)
    both = landing.scan_parquet(t.spark, [older, newer], FEEDS["sales_order"].struct)
    return both.select("ORDER_NO", "CUST_ID", "order_source")


@query(
    """SELECT * FROM (VALUES ('old', 'order_source', 'missing', 'string', NULL), ('new', 'LOYALTY_CD', 'undeclared', NULL, 'int'),
              ('new', 'CUST_ID', 'type', 'bigint', 'string')) AS drift(delivery, "column", kind, declared, delivered)
       WHERE EXISTS (SELECT 1 FROM {f_sales_order} WHERE batch_id < '1998-01') AND EXISTS (SELECT 1 FROM {f_sales_order} WHERE batch_id >= '1998-01')"""
)
def schema_drift_report(t: Tables) -> DataFrame:
    """Older files lack a column; newer ones have one more, and another type for the customer."""
    folder, orders = t.path("drift"), t.feed("f_sales_order")
    orders.filter("batch_id < '1998-01'").drop("order_source", "batch_id").write.parquet(f"{folder}/old")
    newer = orders.filter("batch_id >= '1998-01'").withColumns({"CUST_ID": F.col("CUST_ID").cast("string"), "LOYALTY_CD": F.lit(1)})
    newer.drop("batch_id").write.parquet(f"{folder}/new")
    found = landing.schema_drift(t.spark, folder, FEEDS["sales_order"].struct)
    return found.select(F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("delivery"), "column", "kind", "declared", "delivered").distinct()


def _bronze_orders(t: Tables) -> str:
    table = t.path("bronze-orders")
    landing.replace_batches(t.feed("f_sales_order"), table)
    return table


@query("SELECT ORDER_NO, CUST_ID, ORD_STATUS, batch_id FROM {f_sales_order} WHERE batch_id = '1997-05'")
def scan_batch(t: Tables) -> DataFrame:
    batch = landing.read_batch(t.spark, _bronze_orders(t), "1997-05", t.feed("f_sales_order").schema)
    return batch.select("ORDER_NO", "CUST_ID", "ORD_STATUS", "batch_id")


@query("SELECT batch_id, count(*) AS n_orders, count(order_source) AS n_sources FROM {f_sales_order} GROUP BY batch_id")
def scan_table(t: Tables) -> DataFrame:
    table = landing.read_table(t.spark, _bronze_orders(t))
    return table.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count("order_source").alias("n_sources")
    )


@query(
    """SELECT shipment_id, CASE WHEN batch_id < '1998-01' THEN '1997-12' ELSE '2001-12' END AS batch_id,
              CASE WHEN batch_id < '1998-01' THEN '1997-12' ELSE '2001-12' END || '/shipment' AS delivered_in,
              true AS has_load_time FROM {f_shipment}"""
)
def ingest_provenance(t: Tables) -> DataFrame:
    """Two delivered batches loaded to bronze; every row knows its file's folder and load time."""
    drop, table = t.path("landing"), t.path("bronze-shipment")
    feed, raw = FEEDS["shipment"], t.feed("f_shipment")
    for batch, rows in (("1997-12", raw.filter("batch_id < '1998-01'")), ("2001-12", raw.filter("batch_id >= '1998-01'"))):
        rows.drop("batch_id").write.parquet(f"{drop}/{batch}/{feed.name}")
        landing.ingest(t.spark, feed, drop, table, batch)
    loaded = landing.read_table(t.spark, table, landing.bronze_schema(feed))
    return loaded.select(
        "shipment_id",
        "batch_id",
        F.regexp_extract("source_file", r"([^/]+/[^/]+)/[^/]+$", 1).alias("delivered_in"),
        F.col("ingestion_timestamp").isNotNull().alias("has_load_time"),
    )


@query(
    """SELECT ORDER_NO, CASE WHEN batch_id = '1997-05' THEN 'CHANGED' ELSE ORD_STATUS END AS ORD_STATUS, batch_id
       FROM {f_sales_order} WHERE batch_id <> '1997-06'"""
)
def replace_batch(t: Tables) -> DataFrame:
    """Load all months, then deliver one month again (twice, changed) and one month empty."""
    table, orders = _bronze_orders(t), t.feed("f_sales_order")
    again = orders.filter("batch_id = '1997-05'").withColumn("ORD_STATUS", F.lit("CHANGED"))
    landing.replace_batch(again, table, "1997-05")
    landing.replace_batch(again, table, "1997-05")
    landing.replace_batch(orders.limit(0), table, "1997-06")
    return landing.read_table(t.spark, table, orders.schema).select("ORDER_NO", "ORD_STATUS", "batch_id")


@query(
    """SELECT batch_id, status, CASE WHEN status = 'failed' THEN 'see log' END AS error_message FROM {f_batch_log}
       UNION ALL
       SELECT DISTINCT batch_id, 'in-progress', NULL FROM {f_sales_order}
       WHERE batch_id NOT IN (SELECT batch_id FROM {f_batch_log} WHERE status <> 'failed')"""
)
def append_missing_cols(t: Tables) -> DataFrame:
    """Start every pending batch; the appended rows have no error message."""
    log = t.feed("f_batch_log").withColumn("error_message", F.when(F.col("status") == "failed", "see log"))
    started = landing.pending_batches(t.feed("f_sales_order"), log).withColumn("status", F.lit("in-progress"))
    return landing.append_rows(log, started)


@query("SELECT DISTINCT batch_id FROM {f_sales_order}")
def distinct_batches(t: Tables) -> DataFrame:
    return landing.distinct_batches(t.feed("f_sales_order"))


@query(
    """SELECT DISTINCT batch_id FROM {f_sales_order}
       EXCEPT SELECT batch_id FROM {f_batch_log} WHERE status IN ('in-progress', 'completed')"""
)
def pending_batches(t: Tables) -> DataFrame:
    return landing.pending_batches(t.feed("f_sales_order"), t.feed("f_batch_log"))


@query(
    """SELECT min(batch_id) AS batch_id FROM {f_sales_order}
       WHERE batch_id NOT IN (SELECT batch_id FROM {f_batch_log} WHERE status IN ('in-progress', 'completed'))"""
)
def next_batch(t: Tables) -> DataFrame:
    return landing.next_batch(t.feed("f_sales_order"), t.feed("f_batch_log"))


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS feed, batch_id, count(*) AS n_rows FROM {{{feed}}} GROUP BY batch_id"
        for name, feed in BRONZE.items()
    )
)
def bronze_feeds(t: Tables) -> DataFrame:
    """All nineteen feeds written to bronze and counted per batch from there."""
    counts = None
    for name in BRONZE:
        table, rows = t.path(f"bronze-{name}"), t.bronze(name)
        landing.replace_batches(rows, table)
        stored = landing.read_table(t.spark, table, rows.schema)
        per_batch = stored.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"))
        per_batch = per_batch.select(F.lit(name).alias("feed"), "batch_id", "n_rows")
        counts = per_batch if counts is None else counts.unionByName(per_batch)
    return counts
