"""Queries over the star schema and the reports on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnlake.functions.calendar import calendar, spanning_bounds
from cairnlake.operators import joins, scd2
from cairnlake.operators.merge import AUDIT_COLUMNS
from cairnlake.plans import dimensions, facts, warehouse
from verification.clean_queries import FISCAL_MONTH, FISCAL_QUARTER, FISCAL_YEAR
from verification.registry import CTES, Tables, query, without_keys
from verification.silver_sql import replaced

CTES["g_dim_customer"] = """
    SELECT true AS has_customer, v.customer_id, v.customer_name, v.customer_segment, v.customer_city_id,
           v.customer_active_flag, a.customer_street, a.customer_postal_code, a.customer_address_type,
           c.city_name AS customer_city_name, c.region_name AS customer_region, r.region_id AS customer_region_id,
           r.region_name AS customer_region_name, v.valid_from, v.valid_to, v.is_current
    FROM {s_cust_master} v
    JOIN (SELECT * FROM {s_address} WHERE customer_address_type = 'SHIP_TO'
          QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY customer_address_id) = 1) a
      ON a.customer_id = v.customer_id
    LEFT JOIN {s_cities} c ON c.city_id = v.customer_city_id
    LEFT JOIN {s_regions} r ON r.region_id = c.region_id"""
CTES["g_dim_customer_account"] = """
    SELECT true AS has_bill_to_account, v.customer_id AS account_id, v.customer_name AS account_name,
           v.customer_segment AS account_segment, v.customer_credit_limit AS account_credit_limit,
           v.customer_payment_terms AS account_payment_terms, v.customer_account_manager AS account_manager,
           v.customer_city_id AS account_city_id, v.customer_created_date AS customer_account_created_date,
           strftime(v.customer_created_date, '%Y%m%d') AS customer_account_created_date_id,
           v.customer_active_flag AS account_active_flag, a.customer_postal_code AS account_bill_to_postal_code,
           a.customer_address_type AS account_bill_to_address_type, c.city_name AS account_city_name,
           c.region_name AS account_region, r.region_id AS account_region_id, r.region_name AS account_region_name
    FROM {s_cust_master} v
    JOIN (SELECT * FROM {s_address} WHERE customer_address_type = 'BILL_TO'
          QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY customer_address_id) = 1) a
      ON a.customer_id = v.customer_id
    LEFT JOIN {s_cities} c ON c.city_id = v.customer_city_id
    LEFT JOIN {s_regions} r ON r.region_id = c.region_id
    WHERE v.is_current"""
CTES["g_dim_product"] = """
    SELECT true AS has_product, product_sku AS product_id, product_name, product_brand, product_price, product_cost,
           product_supplier, product_sub_category_name, product_category_name
    FROM {s_products} LEFT JOIN {s_product_sub_categories} ON sub_category_id = product_sub_category_id
    UNION ALL SELECT true, NULL, 'Unknown', 'Unknown', NULL, NULL, NULL, 'Unknown', 'Unknown'"""
CTES["g_dim_campaign"] = """
    SELECT campaign_id, max_by(campaign_name, campaign_log_date) AS campaign_name,
           max_by(campaign_channel, campaign_log_date) AS campaign_channel,
           avg(campaign_budget) AS total_campaign_budget, min(campaign_start_date) AS campaign_start_date,
           max(campaign_end_date) AS campaign_end_date, true AS has_campaign,
           datediff('day', min(campaign_start_date), max(campaign_end_date)) + 1 AS campaign_duration_days,
           strftime(min(campaign_start_date), '%Y%m%d') AS campaign_start_date_id,
           strftime(max(campaign_end_date), '%Y%m%d') AS campaign_end_date_id
    FROM {s_campaign_log} GROUP BY campaign_id"""
CTES["g_fact_sales_order"] = """
    SELECT true AS has_order, o.order_number, o.order_date, o.has_customer, o.customer_name,
           a.account_id IS NOT NULL AS has_bill_to_account, a.account_payment_terms, o.order_status, c.channel_name,
           p.payment_method, i.invoice_date, p.first_payment_date AS payment_date,
           round(i.invoice_total * e.rate_to_gbp, 2) AS order_total_gbp
    FROM {g_versioned_order} o
    LEFT JOIN {g_dim_customer_account} a ON a.account_id = o.customer_id
    LEFT JOIN {g_invoice_by_order} i ON i.order_id = o.order_number
    LEFT JOIN {s_exchange_rates} e ON e.currency = i.currency AND date_trunc('month', i.invoice_date) = e.rate_month
    LEFT JOIN {s_channels} c ON c.channel_code = o.channel_code
    LEFT JOIN {g_payment_by_invoice} p ON p.invoice_number = i.invoice_number"""
CTES["g_fact_sales_order_lines"] = """
    SELECT l.order_line_id, l.order_id AS sales_order_number, l.product_sku AS product_number, l.line_quantity, l.line_unit_price,
           l.line_discount_pct, l.line_total, l.batch_id,
           round(CAST(l.line_quantity AS DECIMAL(10,0)) * l.line_unit_price
                 * (1 - coalesce(l.line_discount_pct, CAST(0 AS DECIMAL(5,4)))), 2) AS net_line_value,
           coalesce(o.has_customer, false) AS has_customer, coalesce(o.has_bill_to_account, false) AS has_bill_to_account,
           o.order_number IS NOT NULL AS has_order, o.order_status AS order_line_status, o.order_date,
           p.product_id IS NOT NULL AS known_product, p.product_category_name
    FROM {s_sales_order_lines} l
    LEFT JOIN {g_fact_sales_order} o ON o.order_number = l.order_id
    LEFT JOIN {g_dim_product} p ON p.product_id = l.product_sku"""
CTES["g_fact_shipment"] = """
    SELECT true AS has_shipment, s.shipment_id AS shipment_number, o.order_number IS NOT NULL AS has_order,
           s.order_id AS sales_order_number, coalesce(o.has_customer, false) AS has_ship_to_customer, s.shipping_carrier,
           o.order_date, s.ship_date, s.delivery_date, s.batch_id,
           CASE WHEN s.order_id IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY s.order_id) END AS shipment_count_on_order,
           CASE WHEN s.order_id IS NULL THEN 1 ELSE row_number() OVER
               (PARTITION BY s.order_id ORDER BY s.ship_date NULLS FIRST, s.shipment_id) END AS shipment_sequence
    FROM {s_shipment} s LEFT JOIN {g_fact_sales_order} o ON o.order_number = s.order_id"""


@query(replaced("g_dim_customer", ("valid_from", "valid_to")))
def dim_customer(t: Tables) -> DataFrame:
    return without_keys(t.dim_customer)


@query(replaced("g_dim_customer_account", ("customer_account_created_date",)))
def dim_customer_account(t: Tables) -> DataFrame:
    return without_keys(t.dim_customer_account)


@query(replaced("g_dim_product", money=("product_price", "product_cost")))
def dim_product(t: Tables) -> DataFrame:
    return without_keys(t.dim_product)


@query(replaced("g_dim_campaign", ("campaign_start_date", "campaign_end_date")))
def dim_campaign(t: Tables) -> DataFrame:
    return without_keys(t.dim_campaign)


@query(replaced("g_dim_campaign", ("campaign_start_date", "campaign_end_date")), name="gold_rebuild")
def campaigns_rebuilt(t: Tables) -> DataFrame:
    """Campaigns known in mid January, merged with the rebuild from the whole log."""
    known = dimensions.dim_campaign(t.silver("campaign_log").filter("campaign_log_date < '2024-01-16'"))
    first = warehouse.merge_gold(None, known, "dim_campaign")
    merged = warehouse.merge_gold(first, t.dim_campaign, "dim_campaign")
    return without_keys(merged.drop(*AUDIT_COLUMNS))


CTES["g_calendar_days"] = """
    SELECT CAST(unnest(generate_series(
               (SELECT date_trunc('year', least(min(order_date), (SELECT min(ship_date) FROM {s_shipment}))) FROM {s_sales_order}),
               (SELECT date_trunc('year', greatest(max(order_date), (SELECT max(ship_date) FROM {s_shipment})))
                       + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM {s_sales_order}),
               INTERVAL 1 DAY)) AS DATE) AS d"""


@query(
    f"""SELECT CAST(d AS VARCHAR) AS full_date, strftime(d, '%Y%m%d') AS date_id, day(d) AS day_of_month,
               strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_short_name, isodow(d) AS day_of_week,
               isodow(d) >= 6 AS is_weekend, weekofyear(d) AS week_of_year, month(d) AS month_number,
               strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short_name, strftime(d, '%Y-%m') AS month_year,
               strftime(d, '%Y%m') AS month_id, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start_date,
               CAST(last_day(d) AS VARCHAR) AS month_end_date, quarter(d) AS quarter_number,
               'Q' || quarter(d) AS quarter_name, year(d) || '-Q' || quarter(d) AS quarter_year, year(d) AS calendar_year,
               {FISCAL_YEAR.format(d='d')} AS fiscal_year, {FISCAL_MONTH.format(d='d')} AS fiscal_month_number,
               {FISCAL_QUARTER.format(d='d')} AS fiscal_quarter_number
        FROM {{g_calendar_days}}
        UNION ALL
        SELECT NULL, '-1', NULL, 'Unknown', NULL, NULL, NULL, NULL, NULL, 'Unknown', NULL, 'Unknown', NULL, NULL, NULL, NULL,
               'Unknown', NULL, NULL, NULL, NULL, NULL"""
)
def dim_date(t: Tables) -> DataFrame:
    """The calendar of all years in which something was ordered or shipped."""
    return calendar(spanning_bounds((t.silver("sales_order"), "order_date"), (t.silver("shipment"), "ship_date")))


@query(
    """SELECT true AS has_campaign, strftime(campaign_log_date, '%Y%m%d') AS campaign_log_date_id,
              CAST(campaign_log_date AS VARCHAR) AS campaign_log_date, campaign_impressions, campaign_clicks,
              CAST(campaign_spend AS DOUBLE) AS campaign_spend FROM {s_campaign_log}"""
)
def fact_campaign(t: Tables) -> DataFrame:
    return without_keys(facts.fact_campaign(t.silver("campaign_log"), t.dim_campaign))


@query(
    """SELECT has_order, order_number, CAST(order_date AS VARCHAR) AS order_timestamp, has_customer, customer_name,
              has_bill_to_account, account_payment_terms, order_status, channel_name, payment_method,
              CAST(invoice_date AS VARCHAR) AS invoice_timestamp, CAST(payment_date AS VARCHAR) AS payment_timestamp,
              CAST(order_total_gbp AS DOUBLE) AS order_total_gbp, CAST(order_date AS VARCHAR) AS order_date,
              CAST(invoice_date AS VARCHAR) AS invoice_date, CAST(payment_date AS VARCHAR) AS payment_date,
              strftime(order_date, '%Y%m%d') AS order_date_id, strftime(invoice_date, '%Y%m%d') AS invoice_date_id,
              strftime(payment_date, '%Y%m%d') AS payment_date_id
       FROM {g_fact_sales_order}"""
)
def fact_sales_order(t: Tables) -> DataFrame:
    return without_keys(t.fact_sales_order)


@query(
    """SELECT true AS has_order_line, sales_order_number, product_number, line_quantity,
              CAST(line_unit_price AS DOUBLE) AS line_unit_price, CAST(line_discount_pct AS DOUBLE) AS line_discount_pct,
              CAST(net_line_value AS DOUBLE) AS net_line_value, CAST(line_total AS DOUBLE) AS line_total,
              true AS has_product, has_customer, has_bill_to_account, has_order, order_line_status,
              CAST(order_date AS VARCHAR) AS order_date, strftime(order_date, '%Y%m%d') AS order_date_id
       FROM {g_fact_sales_order_lines}"""
)
def fact_sales_order_lines(t: Tables) -> DataFrame:
    lines = facts.fact_sales_order_lines(t.silver("sales_order_lines"), t.order_keys, t.dim_product)
    return without_keys(lines)


@query(
    """SELECT has_shipment, shipment_number, has_order, sales_order_number, has_ship_to_customer, shipping_carrier,
              CAST(order_date AS VARCHAR) AS order_date, CAST(ship_date AS VARCHAR) AS ship_date,
              CAST(delivery_date AS VARCHAR) AS delivery_date, batch_id,
              strftime(order_date, '%Y%m%d') AS order_date_id, strftime(ship_date, '%Y%m%d') AS ship_date_id,
              strftime(delivery_date, '%Y%m%d') AS delivery_date_id,
              datediff('day', order_date, ship_date) AS order_to_ship_days,
              datediff('day', ship_date, delivery_date) AS transit_days,
              datediff('day', order_date, delivery_date) AS order_to_delivery_days,
              delivery_date IS NOT NULL AS is_delivered,
              CASE WHEN delivery_date IS NULL THEN 'In transit' ELSE 'Delivered' END AS delivery_status,
              shipment_count_on_order, shipment_sequence, shipment_count_on_order > 1 AS is_split_shipment,
              shipment_sequence = shipment_count_on_order AS is_final_shipment
       FROM {g_fact_shipment}"""
)
def fact_shipment(t: Tables) -> DataFrame:
    return without_keys(facts.fact_shipment(t.silver("shipment"), t.order_keys, t.hot_orders))


@query(
    """SELECT c.campaign_id IS NOT NULL AS has_campaign, p.product_id IS NOT NULL AS has_product, count(*) AS n_pairs
       FROM {s_campaign_sku} l LEFT JOIN {g_dim_campaign} c ON c.campaign_id = l.campaign_id
       LEFT JOIN {g_dim_product} p ON p.product_id = l.campaign_sku GROUP BY ALL"""
)
def bridge_campaign_product(t: Tables) -> DataFrame:
    pairs = dimensions.bridge_campaign_product(t.silver("campaign_sku"), t.dim_campaign, t.dim_product)
    return without_keys(pairs).groupBy("has_campaign", "has_product").agg(F.count(F.lit(1)).alias("n_pairs"))


@query(
    """SELECT coalesce(b.campaign_name, 'none') AS campaign_name, count(*) AS n_products,
              CAST(sum(p.product_price) AS DOUBLE) AS price_total
       FROM {s_campaign_sku} l LEFT JOIN {g_dim_campaign} b ON b.campaign_id = l.campaign_id
       LEFT JOIN {g_dim_product} p ON p.product_id = l.campaign_sku GROUP BY ALL"""
)
def campaign_products(t: Tables) -> DataFrame:
    """The bridge read back through its surrogate keys: products promoted per campaign."""
    pairs = dimensions.bridge_campaign_product(t.silver("campaign_sku"), t.dim_campaign, t.dim_product)
    resolved = pairs.join(t.dim_campaign.select("campaign_sk", "campaign_name"), "campaign_sk", "left").join(
        t.dim_product.select("product_sk", "product_price"), "product_sk", "left"
    )
    return resolved.groupBy(F.coalesce("campaign_name", F.lit("none")).alias("campaign_name")).agg(
        F.count(F.lit(1)).alias("n_products"), F.sum("product_price").alias("price_total")
    )


def _valued_lines(t: Tables) -> DataFrame:
    return t.silver("sales_order_lines").select(
        "order_line_id", "order_id", "product_sku", "line_total",
        facts.net_value("line_quantity", "line_unit_price", "line_discount_pct").alias("net_line_value"),
    )


@query(
    """SELECT coalesce(CASE WHEN known_product THEN product_category_name ELSE 'Unknown' END, 'Uncategorised') AS category,
              count(*) AS n_lines, CAST(sum(net_line_value) AS DOUBLE) AS net_revenue
       FROM {g_fact_sales_order_lines} GROUP BY ALL"""
)
def unknown_member(t: Tables) -> DataFrame:
    """Revenue by category through the product key: lines without product count under the unknown member."""
    products = t.dim_product
    keyed = _valued_lines(t).join(
        products.select(F.col("product_id").alias("product_sku"), "product_sk"), "product_sku", "left"
    ).withColumn("product_sk", F.coalesce("product_sk", F.lit(-1).cast("long")))
    # Sum per key first: the second join then carries one row per product.
    per_product = keyed.groupBy("product_sk").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("net_line_value").alias("net_revenue")
    )
    named = per_product.join(products.select("product_sk", "product_category_name"), "product_sk", "left")
    category = F.coalesce("product_category_name", F.lit("Uncategorised")).alias("category")
    return named.groupBy(category).agg(F.sum("n_lines").alias("n_lines"), F.sum("net_revenue").alias("net_revenue"))


_REGION_REVENUE = """
    SELECT coalesce(v.customer_segment, 'none') AS segment, coalesce(r.region_name, 'none') AS region,
           year(v.order_date) AS order_year, CAST(sum(n.net) AS DOUBLE) AS net_revenue
    FROM {orders_by} v
    JOIN (SELECT sales_order_number, sum(net_line_value) AS net FROM {g_fact_sales_order_lines} GROUP BY ALL) n
      ON n.sales_order_number = v.order_number
    LEFT JOIN {s_cities} c ON c.city_id = v.customer_city_id
    LEFT JOIN {s_regions} r ON r.region_id = c.region_id
    GROUP BY ALL"""
CTES["g_current_order"] = """
    SELECT o.*, v.customer_segment, v.customer_city_id FROM {s_sales_order} o
    LEFT JOIN {s_cust_master} v ON o.customer_id = v.customer_id AND v.is_current"""


def _region_revenue(t: Tables, orders: DataFrame) -> DataFrame:
    net = _valued_lines(t).groupBy(F.col("order_id").alias("order_number")).agg(F.sum("net_line_value").alias("net"))
    places = t.silver("cities").join(
        t.silver("regions").select("region_id", F.col("region_name").alias("region")), "region_id", "left"
    ).select(F.col("city_id").alias("customer_city_id"), "region")
    named = orders.join(net, "order_number").join(places, "customer_city_id", "left")
    none = F.lit("none")
    return named.groupBy(
        F.coalesce("customer_segment", none).alias("segment"),
        F.coalesce("region", none).alias("region"),
        F.year("order_date").alias("order_year"),
    ).agg(F.sum("net").alias("net_revenue"))


@query(_REGION_REVENUE.replace("{orders_by}", "{g_versioned_order}"))
def revenue_by_region_asof(t: Tables) -> DataFrame:
    """Revenue under the customer version valid on the order date."""
    orders = t.silver("sales_order").select("order_number", "order_date", "customer_id")
    versioned = joins.as_of_version(
        orders, t.silver("cust_master"), "customer_id", "order_date", ["customer_segment", "customer_city_id"],
        hot=t.hot_customers, spread=["order_number"],
    )
    return _region_revenue(t, versioned)


@query(_REGION_REVENUE.replace("{orders_by}", "{g_current_order}"))
def revenue_by_region_current(t: Tables) -> DataFrame:
    """The same revenue restated under the current version, as an overwrite would report it."""
    orders = t.silver("sales_order").select("order_number", "order_date", "customer_id")
    current = scd2.current_versions(t.silver("cust_master")).select(
        "customer_id", "customer_segment", "customer_city_id"
    )
    return _region_revenue(t, orders.join(current, "customer_id", "left"))


@query(
    """SELECT coalesce(order_line_status, 'none') AS order_line_status, CAST(sum(line_total) AS DOUBLE) AS gross,
              CAST(sum(net_line_value) AS DOUBLE) AS net, CAST(sum(line_total) - sum(net_line_value) AS DOUBLE) AS gap
       FROM {g_fact_sales_order_lines} GROUP BY ALL"""
)
def revenue_gap(t: Tables) -> DataFrame:
    status = t.silver("sales_order").select(F.col("order_number").alias("order_id"), "order_status")
    lines = _valued_lines(t).join(status, "order_id", "left")
    totals = lines.groupBy(F.coalesce("order_status", F.lit("none")).alias("order_line_status")).agg(
        F.sum("line_total").alias("gross"), F.sum("net_line_value").alias("net")
    )
    return totals.withColumn("gap", F.col("gross") - F.col("net"))


@query(
    """SELECT campaign_channel, CAST(sum(campaign_clicks) AS BIGINT) AS clicks,
              CAST(sum(campaign_impressions) AS BIGINT) AS impressions,
              CAST(sum(campaign_clicks) AS DOUBLE) / nullif(sum(campaign_impressions), 0) AS click_through,
              CAST(sum(campaign_spend) AS DOUBLE) / nullif(sum(campaign_clicks), 0) AS cost_per_click
       FROM {s_campaign_log} GROUP BY campaign_channel"""
)
def campaign_ratios(t: Tables) -> DataFrame:
    """Ratios of sums, never sums or averages of ratios."""
    channel = t.dim_campaign.select("campaign_sk", "campaign_channel")
    log = facts.fact_campaign(t.silver("campaign_log"), t.dim_campaign).join(channel, "campaign_sk", "left")
    sums = log.groupBy("campaign_channel").agg(
        F.sum("campaign_clicks").alias("clicks"),
        F.sum("campaign_impressions").alias("impressions"),
        F.sum("campaign_spend").alias("spend"),
    )
    clicks = F.nullif(F.col("clicks"), F.lit(0))
    return sums.select(
        "campaign_channel", "clicks", "impressions",
        (F.col("clicks") / F.nullif(F.col("impressions"), F.lit(0))).alias("click_through"),
        (F.col("spend").cast("double") / clicks).alias("cost_per_click"),
    )
