"""The whole star schema from silver tables, and the check suite over it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from cairnlake.functions.calendar import calendar, spanning_bounds
from cairnlake.operators import checks, merge, skew
from cairnlake.plans import dimensions, facts


def publish(df: DataFrame, path: str) -> DataFrame:
    """Write a table to a fresh path and return it as read back."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def calendar_for(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Calendar over every date a fact of these tables can refer to."""
    return calendar(
        spanning_bounds(
            (silver["sales_order"], "order_date"),
            (silver["invoice"], "invoice_date"),
            (silver["payment"], "payment_date"),
            (silver["shipment"], "ship_date"),
            (silver["shipment"], "delivery_date"),
        )
    )


def build_gold(silver: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write dimensions, then facts, each reading the tables written before it.

    Facts built from stored dimensions and the stored order fact keep every plan
    short: nothing upstream is computed twice, and a lost executor repeats one
    table's stage at most.
    """
    gold: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        gold[name] = publish(df, f"{folder}/{name}")
        return gold[name]

    place = (silver["address"], silver["cities"], silver["regions"])
    customers = store("dim_customer", dimensions.dim_customer(silver["cust_master"], *place))
    accounts = store("dim_customer_account", dimensions.dim_customer_account(silver["cust_master"], *place))
    products = store("dim_product", dimensions.dim_product(silver["products"], silver["product_sub_categories"]))
    campaigns = store("dim_campaign", dimensions.dim_campaign(silver["campaign_log"]))
    store("dim_date", calendar_for(silver))
    orders = store(
        "fact_sales_order",
        facts.fact_sales_order(
            silver["sales_order"], silver["invoice"], silver["payment"], silver["exchange_rates"],
            customers, accounts, silver["channels"],
            hot_customers=skew.hot_keys(silver["sales_order"], "customer_id"),
        ),
    )
    store("fact_sales_order_lines", facts.fact_sales_order_lines(silver["sales_order_lines"], orders, products))
    store("fact_shipment", facts.fact_shipment(silver["shipment"], orders, skew.hot_keys(silver["shipment"], "order_id")))
    store("fact_campaign", facts.fact_campaign(silver["campaign_log"], campaigns))
    store(
        "bridge_campaign_product",
        dimensions.bridge_campaign_product(silver["campaign_sku"], campaigns, products),
    )
    return gold


# Merge key of every gold table; a NULL in it matches nothing, except in the bridge.
GOLD_KEYS = {
    "dim_customer": ("customer_sk",),
    "dim_customer_account": ("bill_to_account_sk",),
    "dim_product": ("product_sk",),
    "dim_campaign": ("campaign_sk",),
    "fact_campaign": ("campaign_sk", "campaign_log_date_id"),
    "fact_sales_order": ("order_sk",),
    "fact_sales_order_lines": ("order_line_sk",),
    "fact_shipment": ("shipment_sk",),
    "bridge_campaign_product": ("campaign_sk", "product_sk"),
}


def merge_gold(target: DataFrame | None, source: DataFrame, name: str) -> DataFrame:
    """New state of a gold table after a rebuild: the latest write wins, first creation times stay."""
    fresh = merge.with_audit(source)
    keys = GOLD_KEYS[name]
    if target is None:
        return fresh
    if name == "bridge_campaign_product":
        return merge.insert_new(target, fresh, keys)
    update = [c for c in fresh.columns if c not in (*keys, "created_timestamp")]
    null_keys = "insert" if name == "fact_campaign" else "absent"
    return merge.upsert(target, fresh, keys, update, null_keys=null_keys)


SURROGATE_KEYS = {
    "dim_customer": "customer_sk",
    "dim_customer_account": "bill_to_account_sk",
    "dim_product": "product_sk",
    "dim_campaign": "campaign_sk",
    "dim_date": "date_id",
    "fact_sales_order": "order_sk",
    "fact_sales_order_lines": "order_line_sk",
    "fact_shipment": "shipment_sk",
}
DRIVERS = {
    "fact_sales_order": "sales_order",
    "fact_sales_order_lines": "sales_order_lines",
    "fact_shipment": "shipment",
}
FOREIGN_KEYS = (
    ("fact_sales_order", "customer_sk", "dim_customer"),
    ("fact_sales_order", "bill_to_account_sk", "dim_customer_account"),
    ("fact_sales_order_lines", "product_sk", "dim_product"),
    ("fact_sales_order_lines", "order_sk", "fact_sales_order"),
    ("fact_shipment", "order_sk", "fact_sales_order"),
)
DATE_KEYS = (
    ("fact_sales_order", "order_date_id"),
    ("fact_sales_order", "invoice_date_id"),
    ("fact_sales_order", "payment_date_id"),
    ("fact_sales_order_lines", "order_date_id"),
    ("fact_shipment", "ship_date_id"),
    ("fact_shipment", "delivery_date_id"),
)


def unique_key_checks(gold: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [checks.unique_key(f"{t}.{k} unique", gold[t], k) for t, k in SURROGATE_KEYS.items()]


def one_current_checks(silver: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [checks.one_current("customers with more than one open version", silver["cust_master"], "customer_id")]


def overlap_checks(silver: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [checks.no_overlap("versions that begin before an earlier one ends", silver["cust_master"], "customer_id")]


def version_date_checks(silver: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [
        checks.closed_have_end("closed versions without an end", silver["cust_master"]),
        checks.current_have_none("open versions with an end", silver["cust_master"]),
    ]


def row_count_checks(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [checks.same_total(f"{f} rows, silver against gold", gold[f], silver[s]) for f, s in DRIVERS.items()]


def orphan_checks(gold: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [checks.no_orphans(f"{f} -> {d}", gold[f], k, gold[d], k) for f, k, d in FOREIGN_KEYS]


def date_key_checks(gold: Mapping[str, DataFrame]) -> list[DataFrame]:
    return [
        checks.no_orphans(f"{f}.{c} -> dim_date", gold[f], c, gold["dim_date"], "date_id") for f, c in DATE_KEYS
    ]


def net_revenue_checks(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Recompute net revenue from silver lines and compare it with the fact, to the cent."""
    recomputed = facts.net_value("line_quantity", "line_unit_price", "line_discount_pct")
    return [
        checks.same_total(
            "net line value, silver against gold",
            gold["fact_sales_order_lines"], silver["sales_order_lines"],
            F.col("net_line_value"), recomputed,
        )
    ]


def checks_in_one_pass(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> DataFrame:
    """The report of ``all_checks``, with each gold table and each silver table it needs read once."""
    references = [*FOREIGN_KEYS, *((f, c, "dim_date") for f, c in DATE_KEYS)]
    recomputed = facts.net_value("line_quantity", "line_unit_price", "line_discount_pct")
    tables = {t: gold[t] for t in SURROGATE_KEYS} | {s: silver[s] for s in DRIVERS.values()}
    sums = {"fact_sales_order_lines": {"net_gold": F.col("net_line_value")}, "sales_order_lines": {"net_silver": recomputed}}
    found = checks.key_faults(tables, SURROGATE_KEYS, references, sums)
    none = F.lit(0)
    names = [f"{f} -> {d}" for f, _, d in FOREIGN_KEYS] + [f"{f}.{c} -> dim_date" for f, c in DATE_KEYS]
    keys = [(f"{t}.{k} unique", none, F.col(f"d{i}")) for i, (t, k) in enumerate(SURROGATE_KEYS.items())]
    orphans = [(name, none, F.col(f"o{i}")) for i, name in enumerate(names)]
    counts = [(f"{f} rows, silver against gold", F.col(f"n_{s}"), F.col(f"n_{f}")) for f, s in DRIVERS.items()]
    net = [("net line value, silver against gold", F.coalesce("net_silver", none), F.coalesce("net_gold", none))]
    versions = checks.version_faults(silver["cust_master"], "customer_id")
    history = [
        ("customers with more than one open version", none, F.col("several_open")),
        ("versions that begin before an earlier one ends", none, F.col("overlapping")),
        ("closed versions without an end", none, F.col("closed_no_end")),
        ("open versions with an end", none, F.col("open_with_end")),
    ]
    return checks.report([checks.listed(found, keys + orphans + counts + net), checks.listed(versions, history)])


def all_checks(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> DataFrame:
    """Every check as one report."""
    return checks.report(
        unique_key_checks(gold)
        + one_current_checks(silver)
        + overlap_checks(silver)
        + version_date_checks(silver)
        + row_count_checks(silver, gold)
        + orphan_checks(gold)
        + date_key_checks(gold)
        + net_revenue_checks(silver, gold)
    )
