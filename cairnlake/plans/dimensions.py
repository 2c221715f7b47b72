"""Gold dimensions and the campaign bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnlake.functions.calendar import UNKNOWN_TEXT
from cairnlake.functions.keys import UNKNOWN_SK, date_id, surrogate_key
from cairnlake.operators import dedup, joins, scd2


def _place_of_city(cities: DataFrame, regions: DataFrame, city_key: str, prefix: str) -> DataFrame:
    """City with its region's name, under one dimension's column names."""
    named = regions.select("region_id", F.col("region_name").alias("_full"), F.col("region_id").alias("_known"))
    return cities.join(named, "region_id", "left").select(
        F.col("city_id").alias(city_key),
        F.col("city_name").alias(f"{prefix}_city_name"),
        F.col("region_name").alias(f"{prefix}_region"),
        F.col("_known").alias(f"{prefix}_region_id"),
        F.col("_full").alias(f"{prefix}_region_name"),
    )


def _one_address(address: DataFrame, kind: str) -> DataFrame:
    """The address of a type for each customer: of several the one with the smallest id.

    Addresses are keyed by id, customer and type, so a customer may have more than one; a
    second one would double the customer's versions and then its orders.
    """
    of_kind = address.filter(F.col("customer_address_type") == kind)
    return dedup.latest_per_key(of_kind, ["customer_id"], [F.col("customer_address_id").asc()])


def dim_customer(versions: DataFrame, address: DataFrame, cities: DataFrame, regions: DataFrame) -> DataFrame:
    """Every customer version with its ship-to address; the key hashes customer and start date."""
    ship_to = _one_address(address, "SHIP_TO").select(
        "customer_id", "customer_street", "customer_postal_code", "customer_address_type"
    )
    places = _place_of_city(cities, regions, "customer_city_id", "customer")
    return (
        versions.join(ship_to, "customer_id")
        .join(places, "customer_city_id", "left")
        .select(
            surrogate_key("customer_id", "valid_from").alias("customer_sk"),
            "customer_id", "customer_name", "customer_segment", "customer_city_id", "customer_active_flag",
            "customer_street", "customer_postal_code", "customer_address_type",
            "customer_city_name", "customer_region", "customer_region_id", "customer_region_name",
            "valid_from", "valid_to", "is_current",
        )
    )


def dim_customer_account(versions: DataFrame, address: DataFrame, cities: DataFrame, regions: DataFrame) -> DataFrame:
    """Accounts as they stand now (type 1), with the bill-to address."""
    now = joins.rows_at_max(scd2.current_versions(versions), "customer_id", "customer_created_date")
    accounts = now.select(
        F.col("customer_id").alias("account_id"),
        F.col("customer_name").alias("account_name"),
        F.col("customer_segment").alias("account_segment"),
        F.col("customer_credit_limit").alias("account_credit_limit"),
        F.col("customer_payment_terms").alias("account_payment_terms"),
        F.col("customer_account_manager").alias("account_manager"),
        F.col("customer_city_id").alias("account_city_id"),
        F.to_date("customer_created_date").alias("customer_account_created_date"),
        date_id("customer_created_date").alias("customer_account_created_date_id"),
        F.col("customer_active_flag").alias("account_active_flag"),
    )
    bill_to = _one_address(address, "BILL_TO").select(
        F.col("customer_id").alias("account_id"),
        F.col("customer_postal_code").alias("account_bill_to_postal_code"),
        F.col("customer_address_type").alias("account_bill_to_address_type"),
    )
    places = _place_of_city(cities, regions, "account_city_id", "account")
    joined = accounts.join(bill_to, "account_id").join(places, "account_city_id", "left")
    return joined.select(
        surrogate_key("account_id").alias("bill_to_account_sk"),
        *accounts.columns,
        "account_bill_to_postal_code", "account_bill_to_address_type",
        "account_city_name", "account_region", "account_region_id", "account_region_name",
    )


def dim_product(products: DataFrame, sub_categories: DataFrame, unknown: bool = True) -> DataFrame:
    """Products with their categories; ``unknown`` adds the member that lines without product use."""
    joined = products.join(
        sub_categories.select("product_sub_category_id", "product_sub_category_name", "product_category_name"),
        F.col("sub_category_id") == F.col("product_sub_category_id"),
        "left",
    )
    known = joined.select(
        surrogate_key("product_sku").alias("product_sk"),
        F.col("product_sku").alias("product_id"),
        "product_name", "product_brand",
        F.round("product_price", 2).alias("product_price"),
        F.round("product_cost", 2).alias("product_cost"),
        "product_supplier", "product_sub_category_name", "product_category_name",
    )
    return known.unionByName(unknown_product(known)) if unknown else known


def unknown_product(products: DataFrame) -> DataFrame:
    """One row shaped like the dimension, for facts whose product is not known."""
    fixed = {"product_sk": F.lit(UNKNOWN_SK).cast("long")}
    labels = ("product_name", "product_brand", "product_sub_category_name", "product_category_name")
    fixed |= {name: F.lit(UNKNOWN_TEXT) for name in labels}
    row = [fixed.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in products.schema.fields]
    return products.sparkSession.range(1).select(*row)


def dim_campaign(log: DataFrame) -> DataFrame:
    """Campaign days collapsed to one row per campaign id; the latest name and channel win.

    A renamed campaign stays one row, so joining the log to it cannot fan out.
    """
    # Ties on the day (a rename delivered twice) resolve to the later text.
    latest = F.struct("campaign_log_date", "campaign_name", "campaign_channel")
    return (
        log.groupBy("campaign_id")
        .agg(
            F.max(latest).alias("_latest"),
            F.avg("campaign_budget").alias("total_campaign_budget"),
            F.min("campaign_start_date").alias("campaign_start_date"),
            F.max("campaign_end_date").alias("campaign_end_date"),
        )
        .select(
            "campaign_id",
            F.col("_latest.campaign_name").alias("campaign_name"),
            F.col("_latest.campaign_channel").alias("campaign_channel"),
            "total_campaign_budget", "campaign_start_date", "campaign_end_date",
            surrogate_key("campaign_id").alias("campaign_sk"),
            (F.date_diff("campaign_end_date", "campaign_start_date") + 1).alias("campaign_duration_days"),
            date_id("campaign_start_date").alias("campaign_start_date_id"),
            date_id("campaign_end_date").alias("campaign_end_date_id"),
        )
    )


def bridge_campaign_product(links: DataFrame, campaigns: DataFrame, products: DataFrame) -> DataFrame:
    """Campaign-product pairs as surrogate keys; an unresolved side stays NULL."""
    return joins.bridge(
        links.select("campaign_id", F.col("campaign_sku").alias("product_id")),
        (campaigns, "campaign_id", "campaign_sk"),
        (products, "product_id", "product_sk"),
    )
