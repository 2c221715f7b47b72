"""Gold facts. Every join is a left join to a side that is unique on its key, so a
fact has exactly the rows of its silver driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnlake.functions.keys import UNKNOWN_SK, date_id, surrogate_key
from cairnlake.operators import dedup, joins, skew

MONEY_TOTAL = "decimal(20,2)"


def invoice_by_order(invoices: DataFrame) -> DataFrame:
    """The order's latest invoice; the smaller number wins on the same day."""
    known = invoices.filter(F.col("order_id").isNotNull())
    order = [F.col("invoice_date").desc_nulls_last(), F.col("invoice_number").asc()]
    return dedup.latest_per_key(
        known.select("order_id", "invoice_number", "invoice_date", "currency", "invoice_total"), ["order_id"], order
    )


def payment_by_invoice(payments: DataFrame) -> DataFrame:
    """First payment date, and the method of the latest payment (smaller id wins a tie).

    The smallest (negated time, id) pair is the latest payment, so one partially
    aggregated pass finds both; a payment without date comes last.
    """
    undated = F.lit(2**63 - 1)
    latest = F.struct(
        F.coalesce(-F.unix_micros("payment_date"), undated).alias("age"), "payment_id", "payment_method"
    )
    return (
        payments.filter(F.col("invoice_number").isNotNull())
        .groupBy("invoice_number")
        .agg(F.to_date(F.min("payment_date")).alias("first_payment_date"), F.min(latest).alias("_latest"))
        .select("invoice_number", "first_payment_date", F.col("_latest.payment_method").alias("payment_method"))
    )


def net_value(quantity: str, price: str, discount: str) -> Column:
    """Quantity times price less the discount share, in cents; no discount counts as zero."""
    gross = F.col(quantity).cast("decimal(10,0)") * F.col(price)
    kept = F.lit(1) - F.coalesce(F.col(discount), F.lit(0).cast("decimal(5,4)"))
    return F.round(gross * kept, 2).cast(MONEY_TOTAL)


def order_keys(
    orders: DataFrame,
    customers: DataFrame,
    accounts: DataFrame,
    hot_customers: DataFrame | None = None,
    hot_rows: int = skew.HOT_ROWS,
) -> DataFrame:
    """What lines and shipments take from their order, without invoices, payments and rates: its keys, dates and status.

    ``hot_customers`` lists customers with very many orders (``skew.hot_keys`` on customer_id).
    """
    account = accounts.withColumnRenamed("account_id", "customer_id")
    versioned = joins.as_of_version(
        orders.select("order_number", "order_date", "customer_id", "order_status", "channel_code"),
        customers,
        "customer_id",
        "order_date",
        ["customer_sk", "customer_name"],
        hot=hot_customers,
        hot_rows=hot_rows,
        spread=["order_number"],
        lookups=[(account, ["bill_to_account_sk", "account_payment_terms"])],
    )
    day = F.to_date("order_date")
    return versioned.select(
        surrogate_key("order_number").alias("order_sk"),
        "order_number", "customer_sk", "customer_name", "bill_to_account_sk", "account_payment_terms", "order_status", "channel_code",
        day.alias("order_date"),
        date_id(day).alias("order_date_id"),
    )


def fact_sales_order(
    orders: DataFrame,
    invoices: DataFrame,
    payments: DataFrame,
    rates: DataFrame,
    customers: DataFrame,
    accounts: DataFrame,
    channels: DataFrame,
    hot_customers: DataFrame | None = None,
    hot_rows: int = skew.HOT_ROWS,
) -> DataFrame:
    """One row per order: latest invoice in GBP, the customer version of the order date, account, channel, payment.

    ``hot_customers`` lists customers with very many orders (``skew.hot_keys`` on customer_id).
    """
    billed = joins.in_month(
        invoice_by_order(invoices), rates, "currency", "invoice_date", "rate_month", ["rate_to_gbp"]
    ).join(payment_by_invoice(payments), "invoice_number", "left")
    billed = billed.select(
        F.col("order_id").alias("order_number"),
        F.to_date("invoice_date").alias("invoice_timestamp"),
        F.col("first_payment_date").alias("payment_timestamp"),
        "payment_method",
        F.round(F.col("invoice_total") * F.col("rate_to_gbp"), 2).cast(MONEY_TOTAL).alias("order_total_gbp"),
    )
    star = order_keys(orders, customers, accounts, hot_customers, hot_rows).join(billed, "order_number", "left")
    star = joins.lookup(star, channels.select("channel_code", "channel_name"), "channel_code")
    return star.select(
        "order_sk",
        "order_number",
        F.col("order_date").alias("order_timestamp"),
        "customer_sk", "customer_name", "bill_to_account_sk", "account_payment_terms",
        "order_status", "channel_name", "payment_method",
        "invoice_timestamp", "payment_timestamp", "order_total_gbp",
        "order_date",
        F.col("invoice_timestamp").alias("invoice_date"),
        F.col("payment_timestamp").alias("payment_date"),
        "order_date_id",
        date_id("invoice_timestamp").alias("invoice_date_id"),
        date_id("payment_timestamp").alias("payment_date_id"),
    )


def fact_sales_order_lines(lines: DataFrame, sales_orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order line; keys and dates come from its order, a missing product is the unknown member.

    ``sales_orders``: the stored order fact, or ``order_keys``.
    """
    order = sales_orders.select(
        F.col("order_number").alias("_order"), "customer_sk", "bill_to_account_sk", "order_sk",
        F.col("order_status").alias("order_line_status"), "order_date", "order_date_id",
    )
    product = products.select(F.col("product_id").alias("_product"), "product_sk")
    keyed = lines.withColumns(
        {
            "_order": skew.spread_key("order_id", "order_line_id"),
            "_product": skew.spread_key("product_sku", "order_line_id"),
        }
    )
    # The product adds one number to a line, the order six columns: what moves twice stays narrow.
    joined = keyed.join(product, "_product", "left").drop("_product").join(order, "_order", "left")
    return joined.select(
        surrogate_key("order_line_id").alias("order_line_sk"),
        F.col("order_id").alias("sales_order_number"),
        F.col("product_sku").alias("product_number"),
        "line_quantity", "line_unit_price", "line_discount_pct",
        net_value("line_quantity", "line_unit_price", "line_discount_pct").alias("net_line_value"),
        "line_total",
        F.coalesce("product_sk", F.lit(UNKNOWN_SK).cast("long")).alias("product_sk"),
        "customer_sk", "bill_to_account_sk", "order_sk", "order_line_status", "order_date", "order_date_id",
    )


def fact_shipment(shipments: DataFrame, sales_orders: DataFrame, hot_orders: DataFrame | None = None) -> DataFrame:
    """One row per shipment: cycle times in days, delivery state, place among the order's shipments.

    ``sales_orders``: the stored order fact, or ``order_keys``.
    ``hot_orders`` lists orders with very many shipments (``skew.hot_keys`` on order_id).
    """
    order = sales_orders.select(
        F.col("order_number").alias("_order"), "order_sk", F.col("customer_sk").alias("ship_to_customer_sk"),
        "order_date",
    )
    keyed = shipments.withColumn("_order", skew.spread_key("order_id", "shipment_id"))
    joined = keyed.join(order, "_order", "left").select(
        "_order",
        surrogate_key("shipment_id").alias("shipment_sk"),
        F.col("shipment_id").alias("shipment_number"),
        "order_sk",
        F.col("order_id").alias("sales_order_number"),
        "ship_to_customer_sk", "shipping_carrier", "order_date",
        F.to_date("ship_date").alias("ship_date"),
        F.to_date("delivery_date").alias("delivery_date"),
        "batch_id",
    )
    placed = place_in_order(joined, hot_orders)
    delivered = F.col("delivery_date").isNotNull()
    return placed.select(
        *joined.drop("_order").columns,
        date_id("order_date").alias("order_date_id"),
        date_id("ship_date").alias("ship_date_id"),
        date_id("delivery_date").alias("delivery_date_id"),
        F.date_diff("ship_date", "order_date").alias("order_to_ship_days"),
        F.date_diff("delivery_date", "ship_date").alias("transit_days"),
        F.date_diff("delivery_date", "order_date").alias("order_to_delivery_days"),
        delivered.alias("is_delivered"),
        F.when(delivered, "Delivered").otherwise("In transit").alias("delivery_status"),
        "shipment_count_on_order", "shipment_sequence",
        (F.col("shipment_count_on_order") > 1).alias("is_split_shipment"),
        (F.col("shipment_sequence") == F.col("shipment_count_on_order")).alias("is_final_shipment"),
    )


def place_in_order(
    shipments: DataFrame, hot_orders: DataFrame | None = None, cell_rows: int = skew.HOT_ROWS
) -> DataFrame:
    """Shipments per order (``_order``) and each one's place by ship date, then number.

    A shipment without order has an ``_order`` of its own: count 1, place 1.
    """
    if hot_orders is not None:
        hot_orders = hot_orders.withColumnRenamed("order_id", "_order")
    return skew.sequence_in_group(
        shipments,
        "_order",
        ["ship_date", "shipment_number"],
        "shipment_count_on_order",
        "shipment_sequence",
        hot=hot_orders,
        cell_rows=cell_rows,
    )


def fact_campaign(log: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row per campaign and day."""
    return log.join(campaigns.select("campaign_id", "campaign_sk"), "campaign_id", "left").select(
        "campaign_sk",
        date_id("campaign_log_date").alias("campaign_log_date_id"),
        "campaign_log_date", "campaign_impressions", "campaign_clicks", "campaign_spend",
    )
