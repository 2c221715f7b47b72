"""Registered queries: a Spark plan and, next to it, the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cairnlake.plans import dimensions, facts, warehouse
from cairnlake.plans.silver import silver
from cairnlake.operators import skew
from cairnlake.session import configure, work_path
from verification import standins

# Silver table -> the feed that stands in for its bronze table.
BRONZE = {
    "address": "f_address",
    "campaign_log": "f_campaign_log",
    "campaign_sku": "f_campaign_sku",
    "channels": "f_channels",
    "cities": "f_cities",
    "cust_master": "f_cust_master",
    "customer_contacts": "f_customer_contacts",
    "exchange_rates": "f_exchange_rates",
    "invoice": "f_invoice",
    "invoice_lines": "f_invoice_lines",
    "payment": "f_payment",
    "products": "f_products",
    "regions": "f_regions",
    "sales_order": "f_sales_order_redelivered",
    "sales_order_lines": "f_sales_order_lines",
    "sales_targets": "f_sales_targets",
    "shipment": "f_shipment",
    "product_sub_categories": "f_sub_categories",
    "user_details": "f_user_details",
}

_STORED: dict[tuple[str, str], tuple[dict[str, DataFrame], dict[str, DataFrame]]] = {}


class Tables:
    """Lazy access to feeds, silver and gold of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir
        self._frames: dict[str, DataFrame] = {}
        self._silver: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        return standins.frame(self.spark, self.sf_dir, name, self._frames)

    feed = base

    def bronze(self, name: str) -> DataFrame:
        return self.base(BRONZE[name])

    def silver(self, name: str) -> DataFrame:
        if name not in self._silver:
            self._silver[name] = silver(self.bronze(name), name)
        return self._silver[name]

    def path(self, label: str) -> str:
        return work_path(self.spark, label)

    def _place(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.silver("address"), self.silver("cities"), self.silver("regions")

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dimensions.dim_customer(self.silver("cust_master"), *self._place())

    @cached_property
    def dim_customer_account(self) -> DataFrame:
        return dimensions.dim_customer_account(self.silver("cust_master"), *self._place())

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.dim_product(self.silver("products"), self.silver("product_sub_categories"))

    @cached_property
    def dim_campaign(self) -> DataFrame:
        return dimensions.dim_campaign(self.silver("campaign_log"))

    @cached_property
    def hot_customers(self) -> DataFrame | None:
        """Heavy customers counted on the raw orders, which is cheaper than on silver."""
        raw = self.bronze("sales_order").select(F.col("CUST_ID").cast("string").alias("customer_id"))
        return skew.hot_keys(raw, "customer_id")

    @cached_property
    def hot_orders(self) -> DataFrame | None:
        """Orders with very many shipments."""
        return skew.hot_keys(self.bronze("shipment"), "order_id")

    @cached_property
    def fact_sales_order(self) -> DataFrame:
        return facts.fact_sales_order(
            self.silver("sales_order"), self.silver("invoice"), self.silver("payment"),
            self.silver("exchange_rates"), self.dim_customer, self.dim_customer_account,
            self.silver("channels"), hot_customers=self.hot_customers,
        )

    @cached_property
    def order_keys(self) -> DataFrame:
        return facts.order_keys(self.silver("sales_order"), self.dim_customer, self.dim_customer_account, self.hot_customers)

    def stored(self) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
        """Silver and gold as tables written once per session, for the checks over them."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _STORED:
            folder = self.path("warehouse")
            plans = {name: self.silver(name) for name in BRONZE}
            # Silver tables do not depend on each other; several jobs share the executors.
            with ThreadPoolExecutor(max_workers=4) as pool:
                written = pool.map(lambda name: warehouse.publish(plans[name], f"{folder}/silver/{name}"), plans)
                tables = dict(zip(plans, written))
            _STORED[key] = tables, warehouse.build_gold(tables, f"{folder}/gold")
        return _STORED[key]


def portable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: dates as text, decimals as double, one integer width."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("date").cast("string")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def without_keys(df: DataFrame) -> DataFrame:
    """Replace surrogate keys, which only Spark can hash, by whether they are set."""
    return df.select(
        *[
            F.col(c).isNotNull().alias(f"has_{c.removesuffix('_sk')}") if c.endswith("_sk") else F.col(c)
            for c in df.columns
        ]
    )


REGISTRY: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}
CTES: dict[str, str] = dict(standins.FEEDS)


def query(sql: str | None, name: str | None = None):
    """Register a plan under its function's name together with its DuckDB counterpart."""

    def add(fn: Callable[[Tables], DataFrame]):
        REGISTRY[name or fn.__name__] = (fn, sql)
        return fn

    return add


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: portable(fn(Tables(spark, sf_dir)))

    return {name: bind(fn) for name, (fn, _) in REGISTRY.items()}


def duckdb_queries() -> dict[str, str]:
    return {name: standins.with_clause(sql, CTES) for name, (_, sql) in REGISTRY.items() if sql is not None}
