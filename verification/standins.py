"""Order-to-cash feeds derived from the provided test tables.

Each feed is one SELECT in the SQL that Spark and DuckDB share, so both sides of
a comparison start from the same rows; everything done to a feed afterwards is
written twice, once with the library and once as plain SQL. ``{name}`` stands
for a base table or for another feed.

Columns carry the names and types of the delivered feeds plus ``batch_id``.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_ORDER_NO = "'ORD' || lpad(CAST({k} AS STRING), 12, '0')"
_SKU = "'SKU' || lpad(CAST({k} AS STRING), 10, '0')"
_INVOICE_NO = "'INV' || lpad(CAST({k} AS STRING), 12, '0') || '-{n}'"
_CUSTOMER = "CAST({k} AS STRING)"
_MONTH = "substr(CAST(CAST({d} AS DATE) AS STRING), 1, 7)"

_LINE = f"""
    {_SKU.format(k='l_partkey')} AS any_sku, l_orderkey, l_linenumber, l_quantity,
    l_extendedprice, l_discount, l_shipdate"""

_INVOICE_DATE = "CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INT)"
_CURRENCY = ("CASE o_custkey % 5 WHEN 0 THEN 'GBP' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' "
             "WHEN 3 THEN 'JPY' ELSE 'AED' END")


def _invoice(n: int, extra_days: int, where: str) -> str:
    return f"""
    SELECT {_INVOICE_NO.format(k='o_orderkey', n=n)} AS invoice_no,
           CASE WHEN o_orderkey % 97 <> 0 THEN {_ORDER_NO.format(k='o_orderkey')} END AS order_id,
           CASE WHEN o_orderkey % 101 <> 0 THEN o_custkey END AS customer_id,
           CASE WHEN o_orderkey % 103 <> 0
                THEN CAST({_INVOICE_DATE} + {extra_days} AS TIMESTAMP) END AS invoice_date,
           {_CURRENCY} AS currency,
           o_totalprice AS invoice_total,
           CAST({_INVOICE_DATE} + {extra_days} AS TIMESTAMP) AS _loaded_at,
           {_MONTH.format(d=f'{_INVOICE_DATE} + {extra_days}')} AS batch_id
    FROM {{orders}} WHERE {where}"""


def _payment(n: int) -> str:
    paid = f"{_INVOICE_DATE} + {10 + 30 * (n - 1)}"
    return f"""
    SELECT 'PAY' || lpad(CAST(o_orderkey AS STRING), 12, '0') || '-{n}' AS payment_id,
           {_INVOICE_NO.format(k='o_orderkey', n=1)} AS invoice_no,
           CASE WHEN o_orderkey % 107 <> 0 THEN CAST({paid} AS TIMESTAMP) END AS pay_date,
           CASE WHEN o_orderkey % 50 = 3 THEN 0.0E0 ELSE o_totalprice END AS amount,
           CASE (o_orderkey + {n}) % 3 WHEN 0 THEN 'Card' WHEN 1 THEN ' Bank  transfer ' ELSE 'Cheque' END AS method,
           CAST({paid} AS TIMESTAMP) AS _loaded_at,
           {_MONTH.format(d=paid)} AS batch_id
    FROM {{orders}} WHERE o_orderkey % 8 <> 0 AND o_orderkey % 9 >= 2 AND o_orderkey % 3 >= {n - 1}"""


def _order_line(line_number: str, where: str) -> str:
    return f"""
    SELECT CAST(l_orderkey AS STRING) || '-' || CAST({line_number} AS STRING) AS line_id,
           {_ORDER_NO.format(k='l_orderkey')} AS order_id,
           CASE WHEN (l_orderkey + l_linenumber) % 64 <> 0 THEN {_SKU.format(k='l_partkey')} END AS sku,
           CAST(l_quantity AS BIGINT) AS Quantity,
           l_extendedprice AS unit_price,
           CASE WHEN l_orderkey % 29 <> 0 THEN l_discount END AS discount_pct,
           CAST(CAST(l_quantity AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS line_total,
           CAST(l_shipdate AS TIMESTAMP) AS _loaded_at,
           {_MONTH.format(d='l_shipdate')} AS batch_id
    FROM {{lineitem}} WHERE {where}"""


def _address(kind: str, where: str, street: str, batch: str) -> str:
    return f"""
    SELECT 'A' || CAST(c_custkey AS STRING) || '-{kind}' AS address_id,
           {_CUSTOMER.format(k='c_custkey')} AS customer_id,
           {street} AS street,
           CAST(c_nationkey AS STRING) AS city_id,
           'PC' || CAST(c_custkey % 1000 AS STRING) AS postcode,
           '{kind}' AS address_type,
           '{batch}' AS batch_id
    FROM {{customer}} WHERE {where}"""


FEEDS: dict[str, str] = {
    "f_sales_order": f"""
    SELECT {_ORDER_NO.format(k='o_orderkey')} AS ORDER_NO,
           CAST(o_orderdate AS TIMESTAMP) AS ORD_DT,
           o_custkey AS CUST_ID,
           CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN '  IN  TRANSIT ' ELSE 'Pending' END AS ORD_STATUS,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'EXP' WHEN '5-LOW' THEN ' STD' ELSE o_orderpriority END AS PRIORITY_CD,
           o_orderkey % 5 AS CHANNEL_CD,
           o_custkey * 2 AS BILL_ADDR_ID,
           CASE WHEN {_MONTH.format(d='o_orderdate')} >= '1998-01' THEN 'web' END AS order_source,
           {_MONTH.format(d='o_orderdate')} AS batch_id
    FROM {{orders}}""",
    # Some orders are delivered again a month later, with another status and source.
    "f_sales_order_redelivered": f"""
    SELECT ORDER_NO, ORD_DT, CUST_ID, ORD_STATUS, PRIORITY_CD, CHANNEL_CD, BILL_ADDR_ID, order_source, batch_id
    FROM {{f_sales_order}}
    UNION ALL
    SELECT ORDER_NO, ORD_DT, CUST_ID, 'RETURNED', PRIORITY_CD, CHANNEL_CD, BILL_ADDR_ID, 'phone', '2099-01'
    FROM {{f_sales_order}} WHERE CUST_ID % 10 = 3""",
    "f_sales_order_lines": (
        _order_line("l_linenumber", "l_orderkey >= 0")
        + " UNION ALL "
        + _order_line("(l_linenumber + 10)", "l_orderkey % 50 = 0")
    ),
    "f_products": f"""
    SELECT {_SKU.format(k='p_partkey')} AS sku, '  ' || p_name || ' ' AS product_name, p_brand AS brand,
           p_type AS subcategory_id,
           CAST(p_retailprice AS DECIMAL(18,2)) AS price,
           CAST(CAST(p_retailprice AS DECIMAL(15,2)) * CAST(0.6 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS cost,
           'Supplier ' || CAST(p_size AS STRING) AS supplier,
           '1995-01' AS batch_id
    FROM {{part}}""",
    "f_sub_categories": """
    SELECT DISTINCT p_type AS subcategory_id, lower(p_type) AS subcategory_name,
           'Category ' || substr(p_type, 1, 1) AS category_name, '1995-01' AS batch_id
    FROM {part} WHERE p_type <> 'ECONOMY'""",
    "f_regions": """
    SELECT CAST(r_regionkey AS STRING) AS region_id, r_name AS region_name, '1995-01' AS batch_id
    FROM {region}""",
    "f_cities": """
    SELECT CAST(n_nationkey AS STRING) AS city_id, ' ' || n_name AS city_name,
           CAST(n_regionkey AS STRING) AS region_id,
           CASE n_regionkey WHEN 0 THEN 'ME' WHEN 1 THEN 'US' WHEN 2 THEN 'APAC' WHEN 3 THEN 'EU' ELSE 'OTHER' END AS country,
           '1995-01' AS batch_id
    FROM {nation}""",
    "f_address": (
        _address("SHIP_TO", "c_custkey >= 0", "' ' || c_name || '  Street'", "1995-01")
        + " UNION ALL "
        + _address("BILL_TO", "c_custkey % 50 <> 0", "c_name || ' Road'", "1995-01")
        + " UNION ALL "
        + _address("SHIP_TO", "c_custkey % 10 = 0", "c_name || ' New Street'", "1996-01")
    ),
    # One row per customer and order month, with an older second record for some customers.
    "f_cust_months": f"""
    SELECT {_CUSTOMER.format(k='o_custkey')} AS CUST_ID, o_custkey, {_MONTH.format(d='o_orderdate')} AS batch_id,
           max(o_orderpriority) AS SEGMENT, max(o_orderkey) AS manager_key
    FROM {{orders}} GROUP BY o_custkey, {_MONTH.format(d='o_orderdate')}""",
    "f_cust_master": """
    SELECT m.CUST_ID, ' ' || c.c_name AS CUST_NAME, m.SEGMENT,
           CAST(5000 + 100 * (m.o_custkey % 10) AS INT) AS CREDIT_LIMIT,
           CASE WHEN c.c_mktsegment <> 'BUILDING' THEN c.c_mktsegment END AS PAYMENT_TERMS,
           'Manager ' || CAST(m.manager_key AS STRING) AS ACCOUNT_MANAGER,
           CAST(c.c_nationkey AS STRING) AS CITY_ID,
           CAST('1994-06-15' AS DATE) AS CREATED_DT,
           'Y' AS ACTIVE_FLAG, m.batch_id
    FROM {f_cust_months} m JOIN {customer} c ON m.o_custkey = c.c_custkey
    UNION ALL
    SELECT m.CUST_ID, c.c_name, m.SEGMENT, CAST(5000 AS INT), 'Prepaid',
           'Manager ' || CAST(m.manager_key AS STRING), CAST(c.c_nationkey AS STRING),
           CAST('1993-01-01' AS DATE), 'Y', m.batch_id
    FROM {f_cust_months} m JOIN {customer} c ON m.o_custkey = c.c_custkey
    WHERE m.o_custkey % 50 = 0""",
    "f_customer_contacts": f"""
    SELECT {_CUSTOMER.format(k='c_custkey')} AS cust_id, '  ' || c_name || '   Contact ' AS contact_name,
           lower(c_name) || '@example.com' AS contact_email,
           CAST(c_custkey AS STRING) AS phone, 'Y' AS is_primary, '1995-01' AS batch_id
    FROM {{customer}}""",
    "f_invoice": (
        _invoice(1, 0, "o_orderkey % 8 <> 0") + " UNION ALL " + _invoice(2, 3, "o_orderkey % 40 = 1")
    ),
    "f_invoice_lines": f"""
    SELECT {_INVOICE_NO.format(k='l_orderkey', n=1)} AS invoice_no,
           CAST(CASE WHEN l_orderkey % 70 = 0 THEN 0 ELSE l_linenumber END AS BIGINT) AS line_no,
           CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS line_id,
           l_extendedprice AS amount,
           CAST(l_shipdate AS TIMESTAMP) AS _loaded_at,
           {_MONTH.format(d='l_shipdate')} AS batch_id
    FROM {{lineitem}} WHERE l_orderkey % 8 <> 0""",
    "f_payment": " UNION ALL ".join(_payment(n) for n in (1, 2, 3)),
    "f_exchange_rates": f"""
    SELECT DISTINCT currency,
           CAST({_MONTH.format(d='_loaded_at')} || '-01' AS DATE) AS rate_month,
           CAST(CASE currency WHEN 'GBP' THEN 1.00 WHEN 'USD' THEN 0.70 WHEN 'EUR' THEN 0.80 WHEN 'JPY' THEN 0.10 ELSE 0.20 END
                + CAST(substr({_MONTH.format(d='_loaded_at')}, 6, 2) AS INT) * 0.01 AS DECIMAL(18,6)) AS rate_to_gbp,
           {_MONTH.format(d='_loaded_at')} AS batch_id
    FROM {{f_invoice}}
    WHERE NOT (currency = 'JPY' AND {_MONTH.format(d='_loaded_at')} >= '2001-01')""",
    "f_channels": """
    SELECT CAST(r_regionkey AS STRING) AS channel_code, 'Channel ' || r_name AS channel_name, '1995-01' AS batch_id
    FROM {region} WHERE r_regionkey < 4""",
    "f_shipment": f"""
    SELECT 'SHP' || lpad(CAST(l_orderkey AS STRING), 12, '0') || '-' || CAST(l_suppkey % 3 AS STRING) AS shipment_id,
           CASE WHEN l_orderkey % 100 <> 0 THEN {_ORDER_NO.format(k='l_orderkey')} END AS order_id,
           CASE WHEN l_orderkey % 83 <> 0 THEN CAST(min(l_shipdate) AS TIMESTAMP) END AS ship_date,
           CASE WHEN l_orderkey % 83 <> 0 AND l_orderkey % 5 <> 0
                THEN CAST(CAST(min(l_shipdate) AS DATE) + CAST(l_orderkey % 9 AS INT) AS TIMESTAMP) END AS delivery_date,
           'Carrier ' || CAST((l_orderkey + l_suppkey % 3) % 5 AS STRING) AS carrier,
           CAST(min(l_shipdate) AS TIMESTAMP) AS _loaded_at,
           {_MONTH.format(d='min(l_shipdate)')} AS batch_id
    FROM {{lineitem}} GROUP BY l_orderkey, l_suppkey % 3""",
    "f_campaign_days": """
    SELECT user_id % 25 AS campaign, CAST(ts AS DATE) AS log_date, count(*) AS impressions,
           sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS clicks,
           sum(CAST(value AS DECIMAL(15,2))) AS spend
    FROM {events} GROUP BY user_id % 25, CAST(ts AS DATE)""",
    "f_campaign_log": """
    SELECT CAST(campaign AS STRING) AS CAMPAIGN_ID,
           CASE WHEN campaign = 7 AND log_date >= DATE '2024-01-16' THEN 'Campaign seven renamed'
                ELSE 'Campaign  ' || CAST(campaign AS STRING) END AS CAMPAIGN_NAME,
           CASE campaign % 4 WHEN 0 THEN 'Email' WHEN 1 THEN 'Social' WHEN 2 THEN 'Search' ELSE 'Print' END AS CHANNEL,
           CAST(1000 + 10 * campaign + CAST(substr(CAST(log_date AS STRING), 9, 2) AS INT) % 3 AS INT) AS BUDGET,
           min(log_date) OVER (PARTITION BY campaign) AS START_DT,
           max(log_date) OVER (PARTITION BY campaign) AS End_DT,
           log_date AS LOG_DATE,
           CAST(impressions AS INT) AS IMPRESSIONS, CAST(clicks AS INT) AS CLICKS,
           CAST(spend AS DECIMAL(18,2)) AS SPEND,
           substr(CAST(log_date AS STRING), 1, 7) AS batch_id
    FROM {f_campaign_days}""",
    "f_campaign_sku": f"""
    SELECT DISTINCT CAST(o_custkey % 30 AS STRING) AS campaign_id, {_SKU.format(k='l_partkey')} AS sku, '2024-01' AS batch_id
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "f_sales_targets": f"""
    SELECT DISTINCT CAST({_MONTH.format(d='o_orderdate')} || '-01' AS DATE) AS target_month,
           CAST(n_regionkey AS STRING) AS region_id,
           CAST(100000 + 1000 * n_regionkey + 10 * CAST(substr({_MONTH.format(d='o_orderdate')}, 6, 2) AS INT) AS INT) AS target_revenue,
           {_MONTH.format(d='o_orderdate')} AS batch_id
    FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "f_user_details": """
    SELECT lower(s_name) || '@example.com' AS user_email, s_name AS full_name,
           CAST(s_nationkey % 5 AS STRING) AS region_id, 'Analyst' AS job_title,
           CASE WHEN s_acctbal > 0 THEN 'Y' ELSE 'N' END AS is_active, '1995-01' AS batch_id
    FROM {supplier}""",
    "f_batch_log": f"""
    SELECT DISTINCT {_MONTH.format(d='o_orderdate')} AS batch_id,
           CASE WHEN {_MONTH.format(d='o_orderdate')} <= '2000-10' THEN 'completed'
                WHEN {_MONTH.format(d='o_orderdate')} <= '2000-12' THEN 'failed'
                ELSE 'in-progress' END AS status
    FROM {{orders}} WHERE {_MONTH.format(d='o_orderdate')} <= '2001-01'""",
}


def references(text: str) -> list[str]:
    """Names in braces, in order of first use."""
    return list(dict.fromkeys(field for _, field, _, _ in Formatter().parse(text) if field))


def frame(spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame] | None = None) -> DataFrame:
    """A base table or a stand-in feed as a lazy DataFrame; ``known`` keeps plans already built."""
    known = {} if known is None else known
    if name not in known:
        if name in BASE_TABLES:
            known[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            text = FEEDS[name]
            parts = {ref: frame(spark, sf_dir, ref, known) for ref in references(text)}
            known[name] = spark.sql(text, **parts)
    return known[name]


def with_clause(body: str, library: dict[str, str]) -> str:
    """``body`` as one DuckDB statement: every ``{name}`` it needs becomes a CTE."""
    ordered: dict[str, str] = {}

    def visit(text: str) -> str:
        refs = references(text)
        for ref in refs:
            if ref not in BASE_TABLES and ref not in ordered:
                ordered[ref] = visit(library[ref])
        return text.format_map({ref: ref for ref in refs})

    final = visit(body)
    ctes = ",\n".join(f"{name} AS (\n{text}\n)" for name, text in ordered.items())
    return f"WITH {ctes}\n{final}" if ctes else final
