"""Queries over joins and the reductions done before joining."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnlake.functions.calendar import calendar
from cairnlake.functions.keys import date_id
from cairnlake.operators import joins
from cairnlake.plans import facts
from cairnlake.plans.silver import customer_batches
from verification.registry import CTES, Tables, query


@query(
    """SELECT c.customer_id, c.customer_name, a.customer_street FROM {s_cust_master} c
       JOIN {s_address} a ON c.customer_id = a.customer_id
       WHERE c.is_current AND a.customer_address_type = 'SHIP_TO'"""
)
def join_inner(t: Tables) -> DataFrame:
    ship_to = t.silver("address").filter("customer_address_type = 'SHIP_TO'")
    current = t.silver("cust_master").filter("is_current").select("customer_id", "customer_name")
    return current.join(ship_to.select("customer_id", "customer_street"), "customer_id")


@query(
    """SELECT product_sku, product_name, product_sub_category_name, product_category_name FROM {s_products}
       LEFT JOIN {s_product_sub_categories} ON sub_category_id = product_sub_category_id"""
)
def join_left(t: Tables) -> DataFrame:
    groups = t.silver("product_sub_categories")
    joined = t.silver("products").join(groups, F.col("sub_category_id") == F.col("product_sub_category_id"), "left")
    return joined.select("product_sku", "product_name", "product_sub_category_name", "product_category_name")


@query(
    """SELECT payment_id, invoice_number, CAST(payment_date AS VARCHAR) AS payment_date FROM {s_payment}
       QUALIFY payment_date = max(payment_date) OVER (PARTITION BY invoice_number)"""
)
def latest_by_max_join(t: Tables) -> DataFrame:
    payments = t.silver("payment").select("payment_id", "invoice_number", "payment_date")
    return joins.rows_at_max(payments, "invoice_number", "payment_date")


@query(
    """SELECT customer_id, batch_id, customer_segment, max(batch_id) OVER (PARTITION BY customer_id) AS last_batch
       FROM {s_customer_batches}"""
)
def join_using(t: Tables) -> DataFrame:
    months = customer_batches(t.bronze("cust_master")).select("customer_id", "batch_id", "customer_segment")
    last = months.groupBy("customer_id").agg(F.max("batch_id").alias("last_batch"))
    return months.join(last, "customer_id", "left")


@query("SELECT order_number, o.channel_code, channel_name FROM {s_sales_order} o LEFT JOIN {s_channels} c ON o.channel_code = c.channel_code")
def join_broadcast(t: Tables) -> DataFrame:
    orders = t.silver("sales_order").select("order_number", "channel_code")
    return joins.lookup(orders, t.silver("channels").select("channel_code", "channel_name"), "channel_code")


@query(
    """SELECT invoice_number, i.currency, CAST(invoice_date AS VARCHAR) AS invoice_date, CAST(rate_to_gbp AS DOUBLE) AS rate_to_gbp
       FROM {s_invoice} i LEFT JOIN {s_exchange_rates} r
         ON i.currency = r.currency AND invoice_date >= rate_month AND invoice_date < rate_month + INTERVAL 1 MONTH"""
)
def fx_range_join(t: Tables) -> DataFrame:
    invoices = t.silver("invoice").select("invoice_number", "currency", "invoice_date")
    return joins.in_month(
        invoices, t.silver("exchange_rates"), "currency", "invoice_date", "rate_month", ["rate_to_gbp"]
    )


CTES["g_versioned_order"] = """
    SELECT o.*, v.customer_name, v.customer_segment, v.customer_city_id, v.valid_from, v.customer_id IS NOT NULL AS has_customer
    FROM {s_sales_order} o LEFT JOIN {s_cust_master} v
      ON o.customer_id = v.customer_id AND o.order_date >= v.valid_from
     AND o.order_date < coalesce(v.valid_to, DATE '2999-12-31')"""


@query(
    """SELECT order_number, customer_id, CAST(order_date AS VARCHAR) AS order_date,
              CAST(valid_from AS VARCHAR) AS version_start, customer_segment FROM {g_versioned_order}"""
)
def point_in_time_join(t: Tables) -> DataFrame:
    orders = t.silver("sales_order").select("order_number", "customer_id", "order_date")
    versions = t.silver("cust_master").withColumn("version_start", F.col("valid_from"))
    return joins.as_of_version(
        orders, versions, "customer_id", "order_date", ["version_start", "customer_segment"],
        hot=t.hot_customers, spread=["order_number"],
    )


@query(
    """SELECT order_number, customer_id, CAST(order_date AS VARCHAR) AS order_date,
              CAST(valid_from AS VARCHAR) AS version_start, customer_segment FROM {g_versioned_order}"""
)
def point_in_time_sorted(t: Tables) -> DataFrame:
    orders = t.silver("sales_order").select("order_number", "customer_id", "order_date")
    versions = t.silver("cust_master").withColumn("version_start", F.col("valid_from"))
    return joins.as_of_sorted(
        orders, versions, "customer_id", "order_date", ["version_start", "customer_segment"],
        hot=t.hot_customers, spread=["order_number"],
    )


@query(
    """SELECT channel_code, count(*) AS n_rows FROM {s_sales_order}
       WHERE channel_code NOT IN (SELECT channel_code FROM {s_channels}) GROUP BY channel_code"""
)
def orphan_keys(t: Tables) -> DataFrame:
    return joins.missing_references(t.silver("sales_order"), "channel_code", t.silver("channels"), "channel_code")


@query(
    """SELECT strftime(ship_date, '%Y%m%d') AS ship_date_id, count(*) AS n_rows FROM {s_shipment}
       WHERE ship_date < (SELECT min(order_date) FROM {s_sales_order}) OR ship_date > (SELECT max(order_date) FROM {s_sales_order})
       GROUP BY ALL"""
)
def orphan_dates(t: Tables) -> DataFrame:
    """Ship dates outside a calendar that only spans the order dates."""
    bounds = t.silver("sales_order").agg(
        F.to_date(F.min("order_date")).alias("first_day"), F.to_date(F.max("order_date")).alias("last_day")
    )
    shipped = t.silver("shipment").select(date_id("ship_date").alias("ship_date_id"))
    return joins.missing_references(shipped, "ship_date_id", calendar(bounds), "date_id")


@query("SELECT customer_id, CAST(max(order_date) AS VARCHAR) AS last_order_date FROM {s_sales_order} GROUP BY customer_id")
def agg_max_per_key(t: Tables) -> DataFrame:
    return t.silver("sales_order").groupBy("customer_id").agg(F.max("order_date").alias("last_order_date"))


CTES["g_invoice_by_order"] = """
    SELECT order_id, invoice_number, invoice_date, currency, invoice_total FROM {s_invoice} WHERE order_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY invoice_date DESC NULLS LAST, invoice_number) = 1"""
CTES["g_payment_by_invoice"] = """
    SELECT invoice_number, min(payment_date) OVER (PARTITION BY invoice_number) AS first_payment_date, payment_method
    FROM {s_payment} WHERE invoice_number IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY invoice_number ORDER BY payment_date DESC NULLS LAST, payment_id) = 1"""


@query(
    """SELECT order_id, invoice_number, CAST(invoice_date AS VARCHAR) AS invoice_date, currency,
              CAST(invoice_total AS DOUBLE) AS invoice_total FROM {g_invoice_by_order}"""
)
def invoice_by_order(t: Tables) -> DataFrame:
    return facts.invoice_by_order(t.silver("invoice"))


@query(
    """SELECT invoice_number, CAST(first_payment_date AS VARCHAR) AS first_payment_date, payment_method
       FROM {g_payment_by_invoice}"""
)
def payment_by_invoice(t: Tables) -> DataFrame:
    return facts.payment_by_invoice(t.silver("payment"))
