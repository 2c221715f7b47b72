"""Hot-key paths give the same rows as the plain ones, and skewed joins are split."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cairnlake.operators import dedup, joins, skew
from cairnlake.plans import facts
from tests.conftest import plan, rows

HOT = 50


def orders(spark, n=900):
    """Every third order belongs to one customer; some customers are unknown or NULL."""
    return spark.range(n).select(
        F.concat(F.lit("O"), F.col("id")).alias("order_number"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, F.lit(None).cast("string"))
        .otherwise((F.col("id") % 40).cast("string"))
        .alias("customer_id"),
        F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("id") % 200).cast("int")).alias("order_date"),
    )


def versions(spark):
    keys = spark.range(30).select(F.col("id").cast("string").alias("customer_id")).unionByName(
        spark.range(1).select(F.lit("hot").alias("customer_id"))
    )
    starts = F.explode(F.array(*[F.to_date(F.lit(d)) for d in ("2024-01-15", "2024-03-01", "2024-06-01")]))
    ends = F.when(F.col("valid_from") == "2024-01-15", F.to_date(F.lit("2024-03-01"))).when(
        F.col("valid_from") == "2024-03-01", F.to_date(F.lit("2024-06-01"))
    )
    return keys.withColumn("valid_from", starts).withColumn("valid_to", ends).withColumn(
        "version", F.concat("customer_id", F.lit("@"), F.col("valid_from").cast("string"))
    )


def test_hot_keys(spark):
    found = skew.hot_keys(orders(spark), "customer_id", HOT)
    assert rows(found) == [("hot", 300)]
    assert skew.hot_keys(orders(spark), "customer_id", 10_000) is None


def test_salted_point_in_time_join_equals_plain(spark):
    df, v = orders(spark), versions(spark)
    account = v.select("customer_id", F.upper("customer_id").alias("account")).distinct()
    lookups = [(account, ["account"])]
    plain = joins.as_of_version(df, v, "customer_id", "order_date", ["version"], lookups=lookups)
    hot = skew.hot_keys(df, "customer_id", HOT)
    salted = joins.as_of_version(
        df, v, "customer_id", "order_date", ["version"], hot=hot, hot_rows=HOT, spread=["order_number"], lookups=lookups
    )
    assert rows(plain, "order_number", "version", "account") == rows(salted, "order_number", "version", "account")
    assert plain.count() == df.count()
    assert plain.filter("version IS NOT NULL").count() > 500


def test_sorted_stream_equals_point_in_time_join(spark):
    """With gaps between versions, keys and days that are NULL, rows on a version's first day and empty periods."""
    df = orders(spark).withColumn("order_date", F.when(F.length("order_number") % 3 != 0, F.col("order_date")))
    gaps = versions(spark).filter("valid_from <> '2024-03-01' OR customer_id > '2'")
    odd = gaps.limit(3).withColumns({"valid_to": F.col("valid_from"), "version": F.lit("empty")})
    nobody = gaps.limit(2).withColumn("customer_id", F.lit(None).cast("string"))
    v = gaps.unionByName(odd).unionByName(nobody)
    joined = joins.as_of_version(df, v, "customer_id", "order_date", ["version"])
    plain = joins.as_of_sorted(df, v, "customer_id", "order_date", ["version"])
    hot = skew.hot_keys(df, "customer_id", HOT)
    salted = joins.as_of_sorted(df, v, "customer_id", "order_date", ["version"], hot=hot, hot_rows=HOT, spread=["order_number"])
    assert plain.columns == joined.columns
    assert rows(plain) == rows(joined) == rows(salted)
    assert plain.filter("version IS NOT NULL").count() > 300 and plain.filter("version IS NULL").count() > 100
    fresh = joins.as_of_sorted(df, v, "customer_id", "order_date", ["version"])
    physical = plan(fresh).split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning") == 1 and "Join" not in physical


def test_salt_spreads_the_hot_key_only(spark):
    df = orders(spark)
    per_key = skew.salts(skew.hot_keys(df, "customer_id", HOT), "customer_id", HOT)
    spread = skew.salt_rows(df, "customer_id", per_key, ["order_number"])
    counts = {r.customer_id: r.n for r in spread.groupBy("customer_id").agg(F.count_distinct("_salt").alias("n")).collect()}
    assert counts.pop("hot") == 6
    assert set(counts.values()) == {1}


def shipments(spark):
    """One order has a third of all shipments, others several, some shipments no order and some no date."""
    return spark.range(600).select(
        F.format_string("SHP%012d-%d", F.col("id"), F.col("id") % 3).alias("shipment_number"),
        F.when(F.col("id") % 3 == 0, "HOT")
        .when(F.col("id") % 20 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("O"), F.col("id") % 90))
        .alias("sales_order_number"),
        F.when(F.col("id") % 11 != 0, F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("id") % 7).cast("int"))).alias(
            "ship_date"
        ),
    )


def test_sequence_in_hot_group_equals_window(spark):
    df = shipments(spark).withColumn("_order", skew.spread_key("sales_order_number", "shipment_number"))
    plain = facts.place_in_order(df)
    hot = skew.hot_keys(df, "_order", HOT)
    split = facts.place_in_order(df, hot, cell_rows=HOT)
    assert rows(plain) == rows(split.select(*plain.columns))
    alone = plain.filter("sales_order_number IS NULL").select("shipment_count_on_order", "shipment_sequence")
    assert rows(alone.distinct()) == [(1, 1)]


@pytest.mark.parametrize("shape", ["SHP000000000001-%06d", "%d"])
def test_hot_order_is_split_whatever_its_ids(spark, shape):
    """One order, one ship date, ids with a long common prefix or short ones: no cell holds a large share."""
    df = spark.range(20_000).select(
        F.format_string(shape, F.col("id")).alias("shipment_number"), F.lit("HOT").alias("_order"), F.to_date(F.lit("2024-01-01")).alias("ship_date")
    )
    split = facts.place_in_order(df, skew.hot_keys(df, "_order", HOT), cell_rows=1000)
    placed = split.select("shipment_number", "shipment_sequence", "shipment_count_on_order")
    plain = facts.place_in_order(df).select(*placed.columns)
    assert placed.exceptAll(plain).isEmpty() and placed.count() == 20_000
    path = sorted(Path(spark.conf.get("spark.checkpoint.dir"), "cairnlake").glob("hot-groups-*"), key=lambda p: p.stat().st_mtime)[-1]
    cells = spark.read.parquet(str(path)).groupBy("_cell").count().collect()
    assert len(cells) == 20 and max(c["count"] for c in cells) < 3000


def test_flag_repeated(spark):
    data = [("1", "o", "s", 1), ("2", "o", "s", 1), ("3", "o", None, 1), ("4", "o", None, 1), ("5", "p", "s", None), ("6", "p", "s", None)]
    df = spark.createDataFrame(data, "line string, o string, sku string, q int")
    out = dedup.flag_repeated(df, ["o", "sku", "q"], "line", "twin", "sku")
    assert rows(out, "line", "twin") == [
        ("1", True), ("2", True), ("3", False), ("4", False), ("5", True), ("6", True)
    ]


def test_month_range_for_any_start_day(spark):
    rates = spark.createDataFrame([("GBP", "2024-01-10", 1), ("GBP", "2024-02-10", 2), ("USD", "2024-02-01", 3)], "c string, m string, r int")
    days = spark.createDataFrame(
        [(1, "GBP", "2024-01-09"), (2, "GBP", "2024-01-10"), (3, "GBP", "2024-02-09"), (4, "GBP", "2024-02-10"),
         (5, "USD", "2024-02-29"), (6, "USD", "2024-03-01"), (7, None, "2024-02-01"), (8, "GBP", None)],
        "id int, c string, d string",
    )
    out = joins.in_month(days, rates, "c", "d", "m", ["r"])
    assert rows(out, "id", "r") == [(1, None), (2, 1), (3, 1), (4, 2), (5, 3), (6, None), (7, None), (8, None)]


def test_lookup_broadcasts_only_a_small_table(spark):
    df = spark.range(20).select((F.col("id") % 5).alias("code"))
    table = spark.range(4).select(F.col("id").alias("code"), F.lit("x").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(joins.lookup(df, table, "code"))
        beyond = joins.lookup(df, table, "code", max_rows=3)
        assert "BroadcastHashJoin" not in plan(beyond)
        assert rows(beyond) == rows(joins.lookup(df, table, "code"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_adaptive_execution_splits_a_skewed_fact_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts_df = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.sha1(F.col("id").cast("string")).alias("v")
        )
        dim = spark.range(1000).select(F.col("id").alias("k"), F.lit("d").alias("name"))
        joined = facts_df.join(dim, "k", "left")
        assert joined.agg(F.count("*")).first()[0] == 200_000
        out = joined.groupBy("name").agg(F.max("v").alias("v"))
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for k in settings:
            spark.conf.unset(k)
