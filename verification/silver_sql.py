"""Silver tables as DuckDB SQL, and the silver queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnlake.operators.merge import AUDIT_COLUMNS
from cairnlake.plans.silver import load_batch
from verification.registry import BRONZE, CTES, Tables, query


def tidy(column: str) -> str:
    return rf"trim(regexp_replace({column}, '\s+', ' ', 'g'))"


def initcap(text: str) -> str:
    return f"array_to_string(list_transform(string_split({text}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def latest(select: str, key: str, order: str = "batch_id DESC") -> str:
    return f"{select} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


def yes_no(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'Y' ELSE 'N' END"


CTES["s_address"] = latest(
    f"""SELECT address_id AS customer_address_id, customer_id, {tidy('street')} AS customer_street,
               city_id AS customer_city_id, postcode AS customer_postal_code,
               address_type AS customer_address_type, batch_id
        FROM {{f_address}} WHERE address_id IS NOT NULL AND customer_id IS NOT NULL""",
    "customer_address_id, customer_id, customer_address_type",
)
CTES["s_campaign_log"] = latest(
    f"""SELECT CAMPAIGN_ID AS campaign_id, {tidy('CAMPAIGN_NAME')} AS campaign_name, CHANNEL AS campaign_channel,
               BUDGET AS campaign_budget, START_DT AS campaign_start_date, End_DT AS campaign_end_date,
               LOG_DATE AS campaign_log_date, IMPRESSIONS AS campaign_impressions, CLICKS AS campaign_clicks,
               SPEND AS campaign_spend, batch_id
        FROM {{f_campaign_log}}""",
    "campaign_id, campaign_name, campaign_start_date, campaign_channel, campaign_log_date",
)
CTES["s_campaign_sku"] = latest(
    "SELECT campaign_id, sku AS campaign_sku, batch_id FROM {f_campaign_sku} "
    "WHERE campaign_id IS NOT NULL AND sku IS NOT NULL",
    "campaign_id, campaign_sku",
)
CTES["s_channels"] = latest("SELECT channel_code, channel_name, batch_id FROM {f_channels}", "channel_code")
CTES["s_cities"] = latest(
    f"""SELECT city_id, {tidy('city_name')} AS city_name, region_id, country AS region_name, batch_id,
               CASE country WHEN 'US' THEN 'United States' WHEN 'EU' THEN 'Europe' WHEN 'APAC' THEN 'Asia Pacific'
                    WHEN 'LATAM' THEN 'Latin America' WHEN 'ME' THEN 'Middle East & Africa'
                    ELSE country END AS region_full_name
        FROM {{f_cities}}""",
    "city_id",
)
CTES["s_customer_batches"] = latest(
    f"""SELECT CUST_ID AS customer_id, {tidy('CUST_NAME')} AS customer_name, SEGMENT AS customer_segment,
               CREDIT_LIMIT AS customer_credit_limit, PAYMENT_TERMS AS customer_payment_terms,
               ACCOUNT_MANAGER AS customer_account_manager, CITY_ID AS customer_city_id,
               CREATED_DT AS customer_created_date, ACTIVE_FLAG AS customer_active_flag, batch_id
        FROM {{f_cust_master}} WHERE CREATED_DT IS NOT NULL""",
    "customer_id, batch_id",
    "customer_created_date DESC, customer_payment_terms ASC NULLS FIRST",
)
_HASHED = ", '||', ".join(
    f"coalesce(CAST({c} AS VARCHAR), '~NULL~')"
    for c in ("customer_segment", "customer_city_id", "customer_credit_limit", "customer_payment_terms",
              "customer_active_flag")
)
ROW_HASH = f"sha256(concat({_HASHED}))"
# Versions by gaps and islands: number the runs of equal hashes, then take ends of runs.
CTES["s_customer_runs"] = f"""
    SELECT *, sum(CASE WHEN row_hash = before THEN 0 ELSE 1 END) OVER (PARTITION BY customer_id ORDER BY batch_id) AS run
    FROM (SELECT *, lag(row_hash) OVER (PARTITION BY customer_id ORDER BY batch_id) AS before
          FROM (SELECT *, {ROW_HASH} AS row_hash FROM {{s_customer_batches}}) h) l"""
CTES["s_cust_master"] = """
    SELECT customer_id, customer_name, customer_segment, customer_credit_limit, customer_payment_terms,
           customer_account_manager, customer_city_id, customer_created_date, customer_active_flag, batch_id, row_hash,
           valid_from, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to,
           lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) IS NULL AS is_current
    FROM (SELECT customer_id, run,
                 max_by(customer_name, batch_id) AS customer_name,
                 min_by(customer_segment, batch_id) AS customer_segment,
                 min_by(customer_credit_limit, batch_id) AS customer_credit_limit,
                 arg_min_null(customer_payment_terms, batch_id) AS customer_payment_terms,
                 max_by(customer_account_manager, batch_id) AS customer_account_manager,
                 min_by(customer_city_id, batch_id) AS customer_city_id,
                 max_by(customer_created_date, batch_id) AS customer_created_date,
                 min_by(customer_active_flag, batch_id) AS customer_active_flag,
                 max(batch_id) AS batch_id, min(row_hash) AS row_hash,
                 CAST(min(batch_id) || '-01' AS DATE) AS valid_from
          FROM {s_customer_runs} GROUP BY customer_id, run) v"""
CTES["s_customer_contacts"] = latest(
    f"""SELECT cust_id AS customer_id, {tidy('contact_name')} AS customer_contact_name,
               contact_email AS customer_contact_email, is_primary AS is_primary_contact, batch_id
        FROM {{f_customer_contacts}} WHERE cust_id IS NOT NULL""",
    "customer_id",
)
CTES["s_exchange_rates"] = latest(
    "SELECT currency, rate_month, rate_to_gbp, batch_id FROM {f_exchange_rates}", "currency, rate_month"
)
CTES["s_invoice"] = latest(
    f"""SELECT invoice_no AS invoice_number, order_id, CAST(customer_id AS VARCHAR) AS customer_id,
               CAST(invoice_date AS DATE) AS invoice_date, currency,
               CAST(invoice_total AS DECIMAL(18,2)) AS invoice_total, batch_id,
               {yes_no('order_id IS NULL')} AS order_id_null,
               {yes_no('customer_id IS NULL')} AS customer_id_null,
               {yes_no('invoice_no IS NOT NULL AND invoice_date IS NULL')} AS invoice_date_null_flag
        FROM {{f_invoice}}""",
    "invoice_number",
)
CTES["s_invoice_lines"] = latest(
    f"""SELECT invoice_no AS invoice_number, line_no AS line_number, line_id,
               CAST(amount AS DECIMAL(18,2)) AS invoice_amount, batch_id,
               {yes_no('invoice_no IS NULL')} AS invoice_number_null_flag,
               {yes_no('line_no IS NULL OR line_no <= 0')} AS line_number_null_flag
        FROM {{f_invoice_lines}} WHERE invoice_no IS NOT NULL""",
    "line_id",
    "batch_id DESC, _loaded_at DESC, invoice_number, line_number NULLS FIRST, invoice_amount NULLS FIRST",
)
CTES["s_payment"] = latest(
    f"""SELECT payment_id, invoice_no AS invoice_number, CAST(pay_date AS DATE) AS payment_date,
               CAST(amount AS DECIMAL(18,2)) AS payment_amount, {tidy('method')} AS payment_method, batch_id,
               {yes_no('invoice_no IS NULL')} AS invoice_number_null,
               {yes_no('pay_date IS NULL')} AS payment_date_null,
               {yes_no('amount IS NULL OR amount <= 0')} AS payment_amount_null
        FROM {{f_payment}} WHERE payment_id IS NOT NULL""",
    "payment_id",
)
CTES["s_products"] = latest(
    f"""SELECT sku AS product_sku, {tidy('product_name')} AS product_name, brand AS product_brand,
               subcategory_id AS sub_category_id, price AS product_price, cost AS product_cost,
               supplier AS product_supplier, batch_id
        FROM {{f_products}}""",
    "product_sku",
)
CTES["s_regions"] = latest("SELECT region_id, region_name, batch_id FROM {f_regions}", "region_id")
CTES["s_sales_order"] = latest(
    f"""SELECT ORDER_NO AS order_number, CAST(ORD_DT AS DATE) AS order_date, CAST(CUST_ID AS VARCHAR) AS customer_id,
               {initcap(tidy('ORD_STATUS'))} AS order_status,
               CASE {tidy('PRIORITY_CD')} WHEN 'EXP' THEN 'Express' WHEN 'STD' THEN 'Standard'
                    ELSE {tidy('PRIORITY_CD')} END AS priority_code,
               CAST(CHANNEL_CD AS VARCHAR) AS channel_code, BILL_ADDR_ID AS bill_address_id,
               min_by(coalesce(order_source, 'none'), batch_id) OVER (PARTITION BY ORDER_NO) AS first_source, batch_id,
               {yes_no('ORD_DT IS NULL')} AS order_date_nulls, {yes_no('CUST_ID IS NULL')} AS customer_id_nulls
        FROM {{f_sales_order_redelivered}}""",
    "order_number",
)
# Twins count inside one batch.
_TWIN = "order_id, sku, discount_pct, Quantity, unit_price, batch_id"
CTES["s_sales_order_lines"] = latest(
    f"""SELECT line_id AS order_line_id, order_id, sku AS product_sku, Quantity AS line_quantity,
               CAST(unit_price AS DECIMAL(18,2)) AS line_unit_price, CAST(discount_pct AS DECIMAL(5,4)) AS line_discount_pct,
               CAST(line_total AS DECIMAL(18,2)) AS line_total, batch_id,
               sku IS NOT NULL AND min(line_id) OVER (PARTITION BY {_TWIN}) <> max(line_id) OVER (PARTITION BY {_TWIN})
                   AS sales_identifcal_flag,
               {yes_no('sku IS NULL')} AS product_is_null_flag
        FROM {{f_sales_order_lines}} WHERE line_id IS NOT NULL""",
    "order_line_id",
    "batch_id DESC, _loaded_at DESC, order_id, product_sku NULLS FIRST, line_quantity NULLS FIRST, "
    "line_unit_price NULLS FIRST, line_discount_pct NULLS FIRST, line_total NULLS FIRST",
)
CTES["s_sales_targets"] = latest(
    """SELECT target_month AS sales_target_month, region_id AS sales_region_id, target_revenue AS sales_target_revenue,
              batch_id FROM {f_sales_targets}""",
    "sales_target_month, sales_region_id",
)
CTES["s_shipment"] = latest(
    f"""SELECT shipment_id, order_id, CAST(ship_date AS DATE) AS ship_date, CAST(delivery_date AS DATE) AS delivery_date,
               carrier AS shipping_carrier, batch_id, {yes_no('order_id IS NOT NULL')} AS order_flag
        FROM {{f_shipment}} WHERE shipment_id IS NOT NULL""",
    "shipment_id",
)
CTES["s_product_sub_categories"] = latest(
    """SELECT subcategory_id AS product_sub_category_id, subcategory_name AS product_sub_category_name,
              category_name AS product_category_name, batch_id FROM {f_sub_categories}""",
    "product_sub_category_id",
)
CTES["s_user_details"] = latest(
    "SELECT user_email, full_name, region_id, job_title, is_active, batch_id FROM {f_user_details}",
    "full_name, region_id",
)

_DATES = {
    "campaign_log": ("campaign_start_date", "campaign_end_date", "campaign_log_date"),
    "cust_master": ("customer_created_date", "valid_from", "valid_to"),
    "exchange_rates": ("rate_month",),
    "invoice": ("invoice_date",),
    "payment": ("payment_date",),
    "sales_order": ("order_date",),
    "sales_targets": ("sales_target_month",),
    "shipment": ("ship_date", "delivery_date"),
}
_MONEY = {
    "campaign_log": ("campaign_spend",),
    "exchange_rates": ("rate_to_gbp",),
    "invoice": ("invoice_total",),
    "invoice_lines": ("invoice_amount",),
    "payment": ("payment_amount",),
    "products": ("product_price", "product_cost"),
    "sales_order_lines": ("line_unit_price", "line_discount_pct", "line_total"),
}


def replaced(table: str, dates: tuple[str, ...] = (), money: tuple[str, ...] = (), extra: str = "", cut: str = "") -> str:
    """SELECT * with dates as text and decimals as double."""
    changes = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates] + [f"CAST({c} AS DOUBLE) AS {c}" for c in money]
    star = "*" + (f" EXCLUDE ({cut})" if cut else "") + (f" REPLACE ({', '.join(changes)})" if changes else "")
    return f"SELECT {star}{extra} FROM {{{table}}}"


def _register(table: str) -> None:
    extra, cut = "", ""
    if table == "sales_order":
        extra, cut = ", nullif(first_source, 'none') AS order_source", "first_source"
    sql = replaced(f"s_{table}", _DATES.get(table, ()), _MONEY.get(table, ()), extra, cut)
    query(sql, name=f"silver_{table.removeprefix('product_')}")(lambda t: t.silver(table))


for _table in BRONZE:
    _register(_table)


@query(
    replaced("s_sales_order", ("order_date",), extra=", nullif(first_source, 'none') AS order_source", cut="first_source"),
    name="silver_incremental",
)
def loaded_in_steps(t: Tables) -> DataFrame:
    """Orders loaded as three successive deliveries through the guarded upsert."""
    bronze, state = t.bronze("sales_order"), None
    for low, high in (("0000-00", "1997-01"), ("1997-01", "2000-01"), ("2000-01", "9999-99")):
        part = bronze.filter((F.col("batch_id") >= low) & (F.col("batch_id") < high))
        state = load_batch(state, part, "sales_order")
    return state.drop(*AUDIT_COLUMNS)
