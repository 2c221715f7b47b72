"""Queries over the check suite, run on stored silver and gold tables.

The SQL states the totals a check must report, computed from the SQL versions of the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cairnlake.operators import checks
from cairnlake.plans import warehouse
from verification.registry import CTES, Tables, query

PASS = "CASE WHEN expected = actual THEN 'PASS' ELSE 'FAIL' END AS status, '' AS note"


def _rows(*parts: str) -> str:
    inner = " UNION ALL ".join(parts)
    return f'SELECT "check", expected, actual, {PASS} FROM ({inner}) c'


def _zero(name: str, offenders: str) -> str:
    return f"""SELECT '{name}' AS "check", '0' AS expected, CAST(count(*) AS VARCHAR) AS actual FROM ({offenders}) o"""


def _dup(table: str, key: str, name: str) -> str:
    return _zero(f"{name} unique", f"SELECT 1 FROM {{{table}}} GROUP BY {key} HAVING count(*) > 1")


CTES["c_dates"] = "SELECT strftime(d, '%Y%m%d') AS date_id FROM {g_all_days} UNION ALL SELECT '-1'"
CTES["g_all_days"] = """
    SELECT CAST(unnest(generate_series(
        (SELECT date_trunc('year', least(
            (SELECT min(order_date) FROM {s_sales_order}), (SELECT min(invoice_date) FROM {s_invoice}),
            (SELECT min(payment_date) FROM {s_payment}), (SELECT min(ship_date) FROM {s_shipment})))),
        (SELECT date_trunc('year', greatest(
            (SELECT max(order_date) FROM {s_sales_order}), (SELECT max(invoice_date) FROM {s_invoice}),
            (SELECT max(payment_date) FROM {s_payment}), (SELECT max(ship_date) FROM {s_shipment}),
            (SELECT max(delivery_date) FROM {s_shipment}))) + INTERVAL 1 YEAR - INTERVAL 1 DAY),
        INTERVAL 1 DAY)) AS DATE) AS d"""

UNIQUE = [
    _dup("g_dim_customer", "customer_id, valid_from", "dim_customer.customer_sk"),
    _dup("g_dim_customer_account", "account_id", "dim_customer_account.bill_to_account_sk"),
    _dup("g_dim_product", "product_id", "dim_product.product_sk"),
    _dup("g_dim_campaign", "campaign_id", "dim_campaign.campaign_sk"),
    _dup("c_dates", "date_id", "dim_date.date_id"),
    _dup("g_fact_sales_order", "order_number", "fact_sales_order.order_sk"),
    _dup("g_fact_sales_order_lines", "order_line_id", "fact_sales_order_lines.order_line_sk"),
    _dup("g_fact_shipment", "shipment_number", "fact_shipment.shipment_sk"),
]
ONE_CURRENT = [
    _zero("customers with more than one open version",
          "SELECT 1 FROM {s_cust_master} WHERE is_current GROUP BY customer_id HAVING count(*) > 1")
]
NO_OVERLAP = [
    _zero("versions that begin before an earlier one ends",
          "SELECT 1 FROM {s_cust_master} a JOIN {s_cust_master} b ON a.customer_id = b.customer_id "
          "AND a.valid_from < b.valid_from WHERE coalesce(a.valid_to, DATE '2999-12-31') > b.valid_from")
]
VERSION_DATES = [
    _zero("closed versions without an end",
          "SELECT 1 FROM {s_cust_master} WHERE NOT is_current AND valid_to IS NULL"),
    _zero("open versions with an end",
          "SELECT 1 FROM {s_cust_master} WHERE is_current AND valid_to IS NOT NULL"),
]
ROW_COUNTS = [
    f"""SELECT '{fact} rows, silver against gold' AS "check",
               (SELECT CAST(count(*) AS VARCHAR) FROM {{s_{driver}}}) AS expected,
               (SELECT CAST(count(*) AS VARCHAR) FROM {{g_{fact}}}) AS actual"""
    for fact, driver in warehouse.DRIVERS.items()
]
ORPHANS = [
    _zero("fact_sales_order -> dim_customer",
          "SELECT 1 FROM {g_versioned_order} o ANTI JOIN {g_dim_customer} d "
          "ON d.customer_id = o.customer_id AND d.valid_from = o.valid_from WHERE o.has_customer"),
    _zero("fact_sales_order -> dim_customer_account",
          "SELECT 1 FROM {g_fact_sales_order} f JOIN {s_sales_order} o USING (order_number) "
          "ANTI JOIN {g_dim_customer_account} d ON d.account_id = o.customer_id WHERE f.has_bill_to_account"),
    _zero("fact_sales_order_lines -> dim_product",
          "SELECT 1 FROM {g_fact_sales_order_lines} l ANTI JOIN {g_dim_product} d "
          "ON d.product_id = l.product_number WHERE l.known_product"),
    _zero("fact_sales_order_lines -> fact_sales_order",
          "SELECT 1 FROM {g_fact_sales_order_lines} l ANTI JOIN {g_fact_sales_order} o "
          "ON o.order_number = l.sales_order_number WHERE l.has_order"),
    _zero("fact_shipment -> fact_sales_order",
          "SELECT 1 FROM {g_fact_shipment} s ANTI JOIN {g_fact_sales_order} o "
          "ON o.order_number = s.sales_order_number WHERE s.has_order"),
]
DATE_KEYS = [
    _zero(f"{fact}.{column} -> dim_date",
          f"SELECT 1 FROM {{g_{fact}}} f ANTI JOIN {{c_dates}} d "
          f"ON d.date_id = strftime(f.{column.removesuffix('_id')}, '%Y%m%d') WHERE f.{column.removesuffix('_id')} IS NOT NULL")
    for fact, column in warehouse.DATE_KEYS
]
NET_REVENUE = [
    """SELECT 'net line value, silver against gold' AS "check",
              (SELECT CAST(sum(CAST(round(CAST(line_quantity AS DECIMAL(10,0)) * line_unit_price
                  * (1 - coalesce(line_discount_pct, CAST(0 AS DECIMAL(5,4)))), 2) AS DECIMAL(30,2))) AS VARCHAR)
               FROM {s_sales_order_lines}) AS expected,
              (SELECT CAST(sum(CAST(net_line_value AS DECIMAL(30,2))) AS VARCHAR) FROM {g_fact_sales_order_lines}) AS actual"""
]


@query(_rows(*UNIQUE))
def check_unique_keys(t: Tables) -> DataFrame:
    return checks.report(warehouse.unique_key_checks(t.stored()[1]))


@query(_rows(*ONE_CURRENT))
def check_one_current(t: Tables) -> DataFrame:
    return checks.report(warehouse.one_current_checks(t.stored()[0]))


@query(_rows(*NO_OVERLAP))
def check_no_overlap(t: Tables) -> DataFrame:
    return checks.report(warehouse.overlap_checks(t.stored()[0]))


@query(_rows(*VERSION_DATES))
def check_version_dates(t: Tables) -> DataFrame:
    return checks.report(warehouse.version_date_checks(t.stored()[0]))


@query(_rows(*ROW_COUNTS))
def check_row_counts(t: Tables) -> DataFrame:
    return checks.report(warehouse.row_count_checks(*t.stored()))


@query(_rows(*ORPHANS))
def check_orphans(t: Tables) -> DataFrame:
    return checks.report(warehouse.orphan_checks(t.stored()[1]))


@query(_rows(*DATE_KEYS))
def check_date_keys(t: Tables) -> DataFrame:
    return checks.report(warehouse.date_key_checks(t.stored()[1]))


@query(_rows(*NET_REVENUE))
def check_net_revenue(t: Tables) -> DataFrame:
    return checks.report(warehouse.net_revenue_checks(*t.stored()))


@query(_rows(*UNIQUE, *ONE_CURRENT, *NO_OVERLAP, *VERSION_DATES, *ROW_COUNTS, *ORPHANS, *DATE_KEYS, *NET_REVENUE))
def check_report(t: Tables) -> DataFrame:
    return warehouse.all_checks(*t.stored())


@query(_rows(*UNIQUE, *ONE_CURRENT, *NO_OVERLAP, *VERSION_DATES, *ROW_COUNTS, *ORPHANS, *DATE_KEYS, *NET_REVENUE))
def check_report_one_pass(t: Tables) -> DataFrame:
    return warehouse.checks_in_one_pass(*t.stored())
