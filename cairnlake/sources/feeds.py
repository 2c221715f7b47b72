"""The nineteen feeds: delivered schema and how silver conforms it.

Schemas are declared, never inferred. CSV money is read as decimal; Parquet feeds
carry doubles, which silver casts to decimal before any arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, types as T

from cairnlake.operators import clean

MONEY = "decimal(18,2)"
RATE = "decimal(18,6)"
SHARE = "decimal(5,4)"

LINEAGE = ("ingestion_timestamp", "source_file", "batch_id")

# Code names used by the feeds.
REGION_NAMES = {
    "US": "United States",
    "EU": "Europe",
    "APAC": "Asia Pacific",
    "LATAM": "Latin America",
    "ME": "Middle East & Africa",
}
PRIORITY_NAMES = {"EXP": "Express", "STD": "Standard"}


@dataclass(frozen=True)
class Feed:
    """One feed and its silver table.

    ``rename`` maps delivered to silver names, ``derive`` adds columns from renamed
    ones, ``keep_first`` lists columns an upsert inserts but never updates, and
    ``repeat_flag`` names a flag for rows alike in all ``repeat_group`` columns.
    """

    name: str
    file_format: str
    schema: str
    key: tuple[str, ...]
    rename: Mapping[str, str] = field(default_factory=dict)
    drop: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    casts: Mapping[str, str] = field(default_factory=dict)
    recodes: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    derive: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    title_case: tuple[str, ...] = ()
    flags: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    keep_first: tuple[str, ...] = ()
    tracked: tuple[str, ...] = ()
    repeat_flag: str | None = None
    repeat_group: tuple[str, ...] = ()
    tidy_text: bool = True

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)

    def update_columns(self, columns) -> list[str]:
        """Everything an upsert may change on a matched row."""
        fixed = {*self.key, *self.keep_first, *("created_timestamp",)}
        return [c for c in columns if c not in fixed]


def _recoded(name: str, names: Mapping[str, str]) -> Callable[[], Column]:
    from pyspark.sql import functions as F

    return lambda: clean.recode(F.col(name), names)


FEEDS: dict[str, Feed] = {
    f.name: f
    for f in (
        Feed(
            "address", "csv",
            "address_id string, customer_id string, street string, city_id string, postcode string, address_type string",
            key=("customer_address_id", "customer_id", "customer_address_type"),
            rename={"address_id": "customer_address_id", "street": "customer_street", "city_id": "customer_city_id",
                    "postcode": "customer_postal_code", "address_type": "customer_address_type"},
            required=("customer_address_id", "customer_id"),
        ),
        Feed(
            "campaign_log", "csv",
            "CAMPAIGN_ID string, CAMPAIGN_NAME string, CHANNEL string, BUDGET int, START_DT date, End_DT date, "
            f"LOG_DATE date, IMPRESSIONS int, CLICKS int, SPEND {MONEY}",
            key=("campaign_id", "campaign_name", "campaign_start_date", "campaign_channel", "campaign_log_date"),
            rename={"CAMPAIGN_ID": "campaign_id", "CAMPAIGN_NAME": "campaign_name", "CHANNEL": "campaign_channel",
                    "BUDGET": "campaign_budget", "START_DT": "campaign_start_date", "End_DT": "campaign_end_date",
                    "LOG_DATE": "campaign_log_date", "IMPRESSIONS": "campaign_impressions",
                    "CLICKS": "campaign_clicks", "SPEND": "campaign_spend"},
            required=("campaign_id", "campaign_name", "campaign_start_date", "campaign_channel", "campaign_log_date"),
        ),
        Feed(
            "campaign_sku", "csv", "campaign_id string, sku string",
            key=("campaign_id", "campaign_sku"), rename={"sku": "campaign_sku"},
            required=("campaign_id", "campaign_sku"),
        ),
        Feed(
            "channels", "csv", "channel_code string, channel_name string",
            key=("channel_code",), required=("channel_code",), tidy_text=False,
        ),
        Feed(
            "cities", "csv", "city_id string, city_name string, region_id string, country string",
            key=("city_id",), rename={"country": "region_name"}, required=("city_id",),
            derive={"region_full_name": _recoded("region_name", REGION_NAMES)},
        ),
        Feed(
            "cust_master", "csv",
            "CUST_ID string, CUST_NAME string, SEGMENT string, CREDIT_LIMIT int, PAYMENT_TERMS string, "
            "ACCOUNT_MANAGER string, CITY_ID string, CREATED_DT date, ACTIVE_FLAG string",
            key=("customer_id",),
            rename={"CUST_ID": "customer_id", "CUST_NAME": "customer_name", "SEGMENT": "customer_segment",
                    "CREDIT_LIMIT": "customer_credit_limit", "PAYMENT_TERMS": "customer_payment_terms",
                    "ACCOUNT_MANAGER": "customer_account_manager", "CITY_ID": "customer_city_id",
                    "CREATED_DT": "customer_created_date", "ACTIVE_FLAG": "customer_active_flag"},
            required=("customer_created_date",),
            tracked=("customer_segment", "customer_city_id", "customer_credit_limit", "customer_payment_terms",
                     "customer_active_flag"),
        ),
        Feed(
            "customer_contacts", "csv",
            "cust_id string, contact_name string, contact_email string, phone string, is_primary string",
            key=("customer_id",),
            rename={"cust_id": "customer_id", "contact_name": "customer_contact_name",
                    "contact_email": "customer_contact_email", "is_primary": "is_primary_contact"},
            drop=("phone",), required=("customer_id",),
        ),
        Feed(
            "exchange_rates", "csv", f"currency string, rate_month date, rate_to_gbp {RATE}",
            key=("currency", "rate_month"), tidy_text=False,
        ),
        Feed(
            "products", "csv",
            f"sku string, product_name string, brand string, subcategory_id string, price {MONEY}, cost {MONEY}, "
            "supplier string",
            key=("product_sku",),
            rename={"sku": "product_sku", "brand": "product_brand", "subcategory_id": "sub_category_id",
                    "price": "product_price", "cost": "product_cost", "supplier": "product_supplier"},
            required=("product_sku",),
        ),
        Feed("regions", "csv", "region_id string, region_name string", key=("region_id",), required=("region_id",)),
        Feed(
            "sales_targets", "csv", "target_month date, region_id string, target_revenue int",
            key=("sales_target_month", "sales_region_id"),
            rename={"target_month": "sales_target_month", "region_id": "sales_region_id",
                    "target_revenue": "sales_target_revenue"},
            required=("sales_target_month", "sales_region_id"), tidy_text=False,
        ),
        Feed(
            "product_sub_categories", "csv", "subcategory_id string, subcategory_name string, category_name string",
            key=("product_sub_category_id",),
            rename={"subcategory_id": "product_sub_category_id", "subcategory_name": "product_sub_category_name",
                    "category_name": "product_category_name"},
            required=("product_sub_category_id",),
        ),
        Feed(
            "user_details", "csv",
            "user_email string, full_name string, region_id string, job_title string, is_active string",
            key=("full_name", "region_id"), tidy_text=False,
        ),
        Feed(
            "invoice_lines", "parquet",
            "invoice_no string, line_no bigint, line_id string, amount double, _loaded_at timestamp",
            key=("line_id",),
            rename={"invoice_no": "invoice_number", "line_no": "line_number", "amount": "invoice_amount"},
            drop=("_loaded_at",), required=("invoice_number",), casts={"invoice_amount": MONEY},
            flags={"invoice_number_null_flag": lambda: clean.missing_flag("invoice_number"),
                   "line_number_null_flag": lambda: clean.missing_or_not_positive_flag("line_number")},
        ),
        Feed(
            "invoice", "parquet",
            "invoice_no string, order_id string, customer_id bigint, invoice_date timestamp, currency string, "
            "invoice_total double, _loaded_at timestamp",
            key=("invoice_number",), rename={"invoice_no": "invoice_number"}, drop=("_loaded_at",),
            casts={"customer_id": "string", "invoice_total": MONEY},
            flags={"order_id_null": lambda: clean.missing_flag("order_id"),
                   "customer_id_null": lambda: clean.missing_flag("customer_id"),
                   "invoice_date_null_flag": lambda: clean.missing_beside_key_flag("invoice_date", "invoice_number")},
        ),
        Feed(
            "payment", "parquet",
            "payment_id string, invoice_no string, pay_date timestamp, amount double, method string, "
            "_loaded_at timestamp",
            key=("payment_id",),
            rename={"invoice_no": "invoice_number", "pay_date": "payment_date", "amount": "payment_amount",
                    "method": "payment_method"},
            drop=("_loaded_at",), required=("payment_id",), casts={"payment_amount": MONEY},
            flags={"invoice_number_null": lambda: clean.missing_flag("invoice_number"),
                   "payment_date_null": lambda: clean.missing_flag("payment_date"),
                   "payment_amount_null": lambda: clean.missing_or_not_positive_flag("payment_amount")},
        ),
        Feed(
            "sales_order_lines", "parquet",
            "line_id string, order_id string, sku string, Quantity bigint, unit_price double, discount_pct double, "
            "line_total double, _loaded_at timestamp",
            key=("order_line_id",),
            rename={"line_id": "order_line_id", "sku": "product_sku", "Quantity": "line_quantity",
                    "unit_price": "line_unit_price", "discount_pct": "line_discount_pct"},
            drop=("_loaded_at",), required=("order_line_id",),
            casts={"line_unit_price": MONEY, "line_discount_pct": SHARE, "line_total": MONEY},
            flags={"product_is_null_flag": lambda: clean.missing_flag("product_sku")},
            repeat_flag="sales_identifcal_flag",
            repeat_group=("order_id", "product_sku", "line_discount_pct", "line_quantity", "line_unit_price"),
        ),
        Feed(
            "sales_order", "parquet",
            "ORDER_NO string, ORD_DT timestamp, CUST_ID bigint, ORD_STATUS string, PRIORITY_CD string, "
            "CHANNEL_CD bigint, BILL_ADDR_ID bigint, order_source string",
            key=("order_number",),
            rename={"ORDER_NO": "order_number", "ORD_DT": "order_date", "CUST_ID": "customer_id",
                    "ORD_STATUS": "order_status", "PRIORITY_CD": "priority_code", "CHANNEL_CD": "channel_code",
                    "BILL_ADDR_ID": "bill_address_id"},
            required=("order_number",), casts={"customer_id": "string", "channel_code": "string"},
            recodes={"priority_code": PRIORITY_NAMES}, title_case=("order_status",),
            flags={"order_date_nulls": lambda: clean.missing_flag("order_date"),
                   "customer_id_nulls": lambda: clean.missing_flag("customer_id")},
            keep_first=("order_source",),
        ),
        Feed(
            "shipment", "parquet",
            "shipment_id string, order_id string, ship_date timestamp, delivery_date timestamp, carrier string, "
            "_loaded_at timestamp",
            key=("shipment_id",), rename={"carrier": "shipping_carrier"}, drop=("_loaded_at",),
            required=("shipment_id",), flags={"order_flag": lambda: clean.present_flag("order_id")},
        ),
    )
}
