"""Queries over projection, cleaning, deduplication, windows and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnlake.functions import calendar as cal
from cairnlake.functions.keys import date_id, surrogate_key
from cairnlake.operators import clean, dedup, skew
from cairnlake.plans import facts
from cairnlake.plans.silver import customer_batches
from cairnlake.sources.feeds import FEEDS, PRIORITY_NAMES, REGION_NAMES
from verification.registry import Tables, query
from verification.silver_sql import initcap, tidy, yes_no


@query(
    """SELECT CAMPAIGN_ID AS campaign_id, CHANNEL AS campaign_channel, CAST(LOG_DATE AS VARCHAR) AS campaign_log_date,
              IMPRESSIONS AS campaign_impressions FROM {f_campaign_log}"""
)
def rename_project(t: Tables) -> DataFrame:
    names = FEEDS["campaign_log"].rename
    kept = ("CAMPAIGN_ID", "CHANNEL", "LOG_DATE", "IMPRESSIONS")
    return t.bronze("campaign_log").select(*[F.col(c).alias(names[c]) for c in kept])


@query(
    """SELECT line_id AS order_line_id, order_id, sku AS product_sku, Quantity AS line_quantity,
              unit_price AS line_unit_price FROM {f_sales_order_lines}"""
)
def rename_map(t: Tables) -> DataFrame:
    """Names match whatever their case; a name that is not there is ignored."""
    names = {"line_id": "order_line_id", "sku": "product_sku", "QUANTITY": "line_quantity",
             "unit_price": "line_unit_price", "absent": "ignored"}
    lines = t.bronze("sales_order_lines").select("line_id", "order_id", "sku", "Quantity", "unit_price")
    return lines.withColumnsRenamed(names)


@query("SELECT CUST_ID, trim(CUST_NAME) AS CUST_NAME, CREDIT_LIMIT FROM {f_cust_master}")
def trim_strings(t: Tables) -> DataFrame:
    return clean.trim_strings(t.bronze("cust_master").select("CUST_ID", "CUST_NAME", "CREDIT_LIMIT"))


@query(f"SELECT ORDER_NO, {tidy('ORD_STATUS')} AS ORD_STATUS, BILL_ADDR_ID FROM {{f_sales_order_redelivered}}")
def collapse_whitespace(t: Tables) -> DataFrame:
    return clean.trim_strings(t.bronze("sales_order").select("ORDER_NO", "ORD_STATUS", "BILL_ADDR_ID"), collapse=True)


@query("SELECT invoice_no, order_id, customer_id FROM {f_invoice} WHERE order_id IS NOT NULL AND customer_id IS NOT NULL")
def require_keys(t: Tables) -> DataFrame:
    return clean.require_keys(t.bronze("invoice").select("invoice_no", "order_id", "customer_id"), ["order_id", "customer_id"])


@query("SELECT address_id, customer_id FROM {f_address} WHERE address_type = 'SHIP_TO'")
def filter_eq(t: Tables) -> DataFrame:
    return t.bronze("address").filter(F.col("address_type") == "SHIP_TO").select("address_id", "customer_id")


@query(
    f"""SELECT 'city ' || city_id AS entity, country AS code,
               CASE country WHEN 'US' THEN 'United States' WHEN 'EU' THEN 'Europe' WHEN 'APAC' THEN 'Asia Pacific'
                    WHEN 'LATAM' THEN 'Latin America' WHEN 'ME' THEN 'Middle East & Africa' ELSE country END AS name
        FROM {{f_cities}}
        UNION ALL
        SELECT ORDER_NO, PRIORITY_CD, CASE trim(PRIORITY_CD) WHEN 'EXP' THEN 'Express' WHEN 'STD' THEN 'Standard'
               ELSE trim(PRIORITY_CD) END FROM {{f_sales_order}}"""
)
def recode_codes(t: Tables) -> DataFrame:
    cities = t.bronze("cities").select(
        F.concat(F.lit("city "), "city_id").alias("entity"), F.col("country").alias("code"),
        clean.recode(F.col("country"), REGION_NAMES).alias("name"),
    )
    orders = t.feed("f_sales_order").select(
        F.col("ORDER_NO").alias("entity"), F.col("PRIORITY_CD").alias("code"),
        clean.recode(F.trim("PRIORITY_CD"), PRIORITY_NAMES).alias("name"),
    )
    return cities.unionByName(orders)


@query(
    f"""SELECT 'payment' AS feed, payment_id AS row_id, {yes_no('invoice_no IS NULL')} AS key_flag,
               {yes_no('pay_date IS NULL')} AS date_flag, {yes_no('amount IS NULL OR amount <= 0')} AS amount_flag
        FROM {{f_payment}}
        UNION ALL
        SELECT 'invoice', invoice_no, {yes_no('order_id IS NULL')},
               {yes_no('invoice_no IS NOT NULL AND invoice_date IS NULL')}, {yes_no('customer_id IS NULL')}
        FROM {{f_invoice}}
        UNION ALL
        SELECT 'invoice_lines', line_id, {yes_no('invoice_no IS NULL')}, 'N', {yes_no('line_no IS NULL OR line_no <= 0')}
        FROM {{f_invoice_lines}}
        UNION ALL
        SELECT 'shipment', shipment_id, {yes_no('order_id IS NOT NULL')}, {yes_no('ship_date IS NULL')}, 'N'
        FROM {{f_shipment}}"""
)
def dq_flags(t: Tables) -> DataFrame:
    def listing(feed, row_id, key_flag, date_flag, other_flag):
        return t.bronze(feed).select(
            F.lit(feed).alias("feed"), F.col(row_id).alias("row_id"), key_flag.alias("key_flag"),
            date_flag.alias("date_flag"), other_flag.alias("amount_flag"),
        )

    no = F.lit("N")
    return (
        listing("payment", "payment_id", clean.missing_flag("invoice_no"), clean.missing_flag("pay_date"),
                clean.missing_or_not_positive_flag("amount"))
        .unionByName(listing("invoice", "invoice_no", clean.missing_flag("order_id"),
                             clean.missing_beside_key_flag("invoice_date", "invoice_no"),
                             clean.missing_flag("customer_id")))
        .unionByName(listing("invoice_lines", "line_id", clean.missing_flag("invoice_no"), no,
                             clean.missing_or_not_positive_flag("line_no")))
        .unionByName(listing("shipment", "shipment_id", clean.present_flag("order_id"),
                             clean.missing_flag("ship_date"), no))
    )


@query(
    """SELECT 'sales_order_lines' AS feed, count(*) AS rows_read,
              count(CASE WHEN line_id IS NOT NULL AND sku IS NOT NULL THEN 1 END) AS rows_with_keys,
              count(DISTINCT CASE WHEN sku IS NOT NULL THEN line_id END) AS rows_deduplicated FROM {f_sales_order_lines}
       UNION ALL
       SELECT 'invoice', count(*), count(CASE WHEN order_id IS NOT NULL AND customer_id IS NOT NULL THEN 1 END),
              count(DISTINCT CASE WHEN order_id IS NOT NULL AND customer_id IS NOT NULL THEN order_id END) FROM {f_invoice}"""
)
def audit_counts(t: Tables) -> DataFrame:
    lines = clean.audit_counts(t.bronze("sales_order_lines"), ["line_id", "sku"], ["line_id"])
    invoices = clean.audit_counts(t.bronze("invoice"), ["order_id", "customer_id"], ["order_id"])
    return lines.withColumn("feed", F.lit("sales_order_lines")).unionByName(
        invoices.withColumn("feed", F.lit("invoice"))
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_extendedprice
       FROM {lineitem}
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1"""
)
def dedup_key(t: Tables) -> DataFrame:
    rows = t.base("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    kept = dedup.dedup_key(rows, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()])
    return kept.drop("l_suppkey", "l_quantity")


@query("SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM {orders}")
def dedup_full_row(t: Tables) -> DataFrame:
    return dedup.distinct_rows(t.base("orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


@query(
    "SELECT customer_id, batch_id, customer_payment_terms, CAST(customer_created_date AS VARCHAR) AS customer_created_date "
    "FROM {s_customer_batches}"
)
def dedup_latest(t: Tables) -> DataFrame:
    return customer_batches(t.bronze("cust_master")).select(
        "customer_id", "batch_id", "customer_payment_terms", "customer_created_date"
    )


@query("SELECT order_line_id, product_sku, sales_identifcal_flag FROM {s_sales_order_lines}")
def flag_identical_lines(t: Tables) -> DataFrame:
    return t.silver("sales_order_lines").select("order_line_id", "product_sku", "sales_identifcal_flag")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM {lineitem} GROUP BY ALL HAVING count(*) > 1")
def dup_groups(t: Tables) -> DataFrame:
    return dedup.duplicate_groups(t.base("lineitem"), ["l_orderkey", "l_linenumber"])


def _places(t: Tables) -> DataFrame:
    rows = t.silver("shipment").select(
        F.col("shipment_id").alias("shipment_number"), skew.spread_key("order_id", "shipment_id").alias("_order"), "ship_date"
    )
    return facts.place_in_order(rows, t.hot_orders)


@query(
    """SELECT shipment_id AS shipment_number,
              CASE WHEN order_id IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY order_id) END AS shipment_count_on_order
       FROM {s_shipment}"""
)
def shipment_counts(t: Tables) -> DataFrame:
    return _places(t).select("shipment_number", "shipment_count_on_order")


@query(
    """SELECT shipment_id AS shipment_number, CASE WHEN order_id IS NULL THEN 1 ELSE
              row_number() OVER (PARTITION BY order_id ORDER BY ship_date NULLS FIRST, shipment_id) END AS shipment_sequence
       FROM {s_shipment}"""
)
def shipment_sequence(t: Tables) -> DataFrame:
    return _places(t).select("shipment_number", "shipment_sequence")


@query(
    """SELECT address_id AS place_id, customer_id, address_type AS kind FROM {f_address}
       UNION ALL SELECT cust_id, cust_id, is_primary FROM {f_customer_contacts}"""
)
def union_by_name(t: Tables) -> DataFrame:
    addresses = t.bronze("address").select(
        F.col("address_id").alias("place_id"), "customer_id", F.col("address_type").alias("kind")
    )
    contacts = t.bronze("customer_contacts").select(
        F.col("is_primary").alias("kind"), F.col("cust_id").alias("customer_id"), F.col("cust_id").alias("place_id")
    )
    return addresses.unionByName(contacts)


@query(
    f"""SELECT ORDER_NO AS order_number, trim(ORD_STATUS) AS trimmed, {initcap(tidy('ORD_STATUS'))} AS titled,
               ORDER_NO || '/' || CAST(CUST_ID AS VARCHAR) AS joined,
               concat_ws('||', ORDER_NO, order_source, PRIORITY_CD) AS joined_present, CAST(CHANNEL_CD AS VARCHAR) AS as_text,
               coalesce(order_source, 'none') AS or_default,
               CASE WHEN ORD_STATUS = 'DELIVERED' THEN 1 ELSE 0 END AS done,
               CAST(CHANNEL_CD IN (1, 3) AS INT) AS listed FROM {{f_sales_order}}"""
)
def scalar_string(t: Tables) -> DataFrame:
    return t.feed("f_sales_order").select(
        F.col("ORDER_NO").alias("order_number"),
        F.trim("ORD_STATUS").alias("trimmed"),
        F.initcap(clean.tidy("ORD_STATUS")).alias("titled"),
        F.concat("ORDER_NO", F.lit("/"), F.col("CUST_ID").cast("string")).alias("joined"),
        F.concat_ws("||", "ORDER_NO", "order_source", "PRIORITY_CD").alias("joined_present"),
        F.col("CHANNEL_CD").cast("string").alias("as_text"),
        F.coalesce("order_source", F.lit("none")).alias("or_default"),
        F.when(F.col("ORD_STATUS") == "DELIVERED", 1).otherwise(0).alias("done"),
        F.col("CHANNEL_CD").isin(1, 3).cast("int").alias("listed"),
    )


_DAY = "CAST(o_orderdate AS DATE)"


@query(
    f"""SELECT o_orderkey, strftime({_DAY}, '%Y%m%d') AS date_id, day({_DAY}) AS day_of_month,
               strftime({_DAY}, '%A') AS day_name, strftime({_DAY}, '%a') AS day_short_name,
               isodow({_DAY}) AS day_of_week, isodow({_DAY}) >= 6 AS is_weekend, weekofyear({_DAY}) AS week_of_year,
               month({_DAY}) AS month_number, strftime({_DAY}, '%B') AS month_name,
               strftime({_DAY}, '%b') AS month_short_name, strftime({_DAY}, '%Y-%m') AS month_year,
               strftime({_DAY}, '%Y%m') AS month_id, quarter({_DAY}) AS quarter_number, year({_DAY}) AS calendar_year
        FROM {{orders}}"""
)
def scalar_date_parts(t: Tables) -> DataFrame:
    parts = cal.date_attributes(F.to_date("o_orderdate"))
    wanted = ("date_id", "day_of_month", "day_name", "day_short_name", "day_of_week", "is_weekend", "week_of_year",
              "month_number", "month_name", "month_short_name", "month_year", "month_id", "quarter_number",
              "calendar_year")
    return t.base("orders").select("o_orderkey", *[parts[name].alias(name) for name in wanted])


@query(
    f"""SELECT o_orderkey, CAST(CAST({_DAY} + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS month_later,
               CAST(CAST(date_trunc('month', {_DAY}) AS DATE) AS VARCHAR) AS month_start_date,
               CAST(last_day({_DAY}) AS VARCHAR) AS month_end_date,
               datediff('day', {_DAY}, last_day({_DAY})) AS days_left,
               round(CAST(o_totalprice AS DECIMAL(15,2)) * CAST(0.175 AS DECIMAL(4,3)), 2)::DOUBLE AS share,
               CAST(ceil(month({_DAY}) / 3.0) AS INT) AS by_ceiling
        FROM {{orders}}"""
)
def scalar_date_arith(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    money = F.col("o_totalprice").cast("decimal(15,2)") * F.lit("0.175").cast("decimal(4,3)")
    return t.base("orders").select(
        "o_orderkey",
        F.add_months(day, 1).alias("month_later"),
        F.trunc(day, "MM").alias("month_start_date"),
        F.last_day(day).alias("month_end_date"),
        F.date_diff(F.last_day(day), day).alias("days_left"),
        F.round(money, 2).alias("share"),
        F.ceil(F.month(day) / 3).cast("int").alias("by_ceiling"),
    )


FISCAL_YEAR = "year({d}) - CASE WHEN month({d}) < 4 THEN 1 ELSE 0 END"
FISCAL_MONTH = "(month({d}) + 8) % 12 + 1"
FISCAL_QUARTER = "((month({d}) + 8) % 12) // 3 + 1"


@query(
    f"""SELECT o_orderkey, {FISCAL_YEAR.format(d=_DAY)} AS fiscal_year, {FISCAL_MONTH.format(d=_DAY)} AS fiscal_month_number,
               {FISCAL_QUARTER.format(d=_DAY)} AS fiscal_quarter_number FROM {{orders}}"""
)
def scalar_fiscal(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t.base("orders").select(
        "o_orderkey",
        cal.fiscal_year(day).alias("fiscal_year"),
        cal.fiscal_month(day).alias("fiscal_month_number"),
        cal.fiscal_quarter(day).alias("fiscal_quarter_number"),
    )


@query(
    """SELECT 'order' AS entity, count(DISTINCT o_orderkey) AS n_keys, count(DISTINCT o_orderkey) AS n_surrogates FROM {orders}
       UNION ALL SELECT 'part', count(DISTINCT p_partkey), count(DISTINCT p_partkey) FROM {part}
       UNION ALL SELECT 'customer day', count(DISTINCT (o_custkey, o_orderdate)), count(DISTINCT (o_custkey, o_orderdate)) FROM {orders}""",
    name="surrogate_key",
)
def surrogate_key_unique(t: Tables) -> DataFrame:
    """Different business keys get different surrogate keys."""

    def row(entity, df, *key):
        return df.agg(
            F.count_distinct(*key).alias("n_keys"), F.count_distinct(surrogate_key(*key)).alias("n_surrogates")
        ).select(F.lit(entity).alias("entity"), "n_keys", "n_surrogates")

    orders = t.base("orders").withColumn("day_id", date_id("o_orderdate"))
    return (
        row("order", orders, "o_orderkey")
        .unionByName(row("part", t.base("part"), "p_partkey"))
        .unionByName(row("customer day", orders, "o_custkey", "day_id"))
    )
