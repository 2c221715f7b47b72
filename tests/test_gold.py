"""Star schema integrity on the smallest data, calendar, checks and plan shapes."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cairnlake.functions import calendar as cal
from cairnlake.functions.keys import row_hash, surrogate_key
from cairnlake.operators import checks, clean, skew
from cairnlake.plans import dimensions, facts, warehouse
from tests.conftest import plan, rows
from verification.registry import Tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF_DIR)


def test_all_checks_pass(tables):
    report = warehouse.all_checks(*tables.stored())
    assert report.count() == 27
    checks.require_passed(report)


def test_broken_tables_fail(tables):
    silver, gold = tables.stored()
    lines = gold["fact_sales_order_lines"]
    broken = dict(gold)
    broken["fact_sales_order_lines"] = lines.unionByName(lines.limit(1)).withColumn("product_sk", F.lit(5).cast("long"))
    failed = {r["check"] for r in warehouse.all_checks(silver, broken).filter("status = 'FAIL'").collect()}
    assert {
        "fact_sales_order_lines.order_line_sk unique",
        "fact_sales_order_lines rows, silver against gold",
        "fact_sales_order_lines -> dim_product",
        "net line value, silver against gold",
    } == failed
    with pytest.raises(checks.ChecksFailed, match="4 check"):
        checks.require_passed(warehouse.all_checks(silver, broken))


def _damaged(silver, gold):
    """Every kind of fault at once: repeated and NULL keys, lost parents, dates off the calendar, broken versions."""
    broken, raw = dict(gold), dict(silver)
    lines, orders = gold["fact_sales_order_lines"], gold["fact_sales_order"]
    broken["fact_sales_order_lines"] = lines.unionByName(lines.orderBy("order_line_sk").limit(3))
    broken["fact_sales_order"] = orders.filter("order_sk % 7 <> 0")
    nameless = gold["dim_product"].filter("product_sk % 5 = 0").withColumn("product_sk", F.lit(None).cast("long"))
    broken["dim_product"] = gold["dim_product"].filter("product_sk % 5 <> 0").unionByName(nameless)
    broken["dim_date"] = gold["dim_date"].filter("date_id NOT LIKE '%15'")
    versions = silver["cust_master"]
    again = versions.filter("is_current").withColumn("valid_from", F.date_add("valid_from", 3))
    late = versions.filter("is_current").limit(4).withColumn("valid_to", F.lit(datetime.date(2030, 1, 1)))
    lost = versions.limit(2).withColumns({"is_current": F.lit(False), "valid_to": F.lit(None).cast("date")})
    raw["cust_master"] = versions.unionByName(again).unionByName(late).unionByName(lost)
    return raw, broken


def test_one_pass_reports_what_single_checks_do(tables):
    silver, gold = tables.stored()
    assert rows(warehouse.checks_in_one_pass(silver, gold)) == rows(warehouse.all_checks(silver, gold))
    damaged = _damaged(silver, gold)
    single = rows(warehouse.all_checks(*damaged), "check", "expected", "actual", "status")
    assert rows(warehouse.checks_in_one_pass(*damaged), "check", "expected", "actual", "status") == single
    assert sum(r[3] == "FAIL" for r in single) >= 14


def test_one_pass_reads_each_table_once(tables):
    silver, gold = tables.stored()
    physical = plan(warehouse.checks_in_one_pass(silver, gold)).split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == len(warehouse.SURROGATE_KEYS) + len(warehouse.DRIVERS) + 1
    assert "Join" not in physical


def test_one_pass_over_empty_tables(tables):
    silver, gold = ({k: v.limit(0) for k, v in side.items()} for side in tables.stored())
    assert rows(warehouse.checks_in_one_pass(silver, gold)) == rows(warehouse.all_checks(silver, gold))


def test_surrogate_keys_resolve(tables):
    _, gold = tables.stored()
    orders, customers = gold["fact_sales_order"], gold["dim_customer"]
    joined = orders.join(customers, "customer_sk")
    assert joined.count() == orders.filter("customer_sk IS NOT NULL").count() == orders.count()
    outside = (F.col("order_date") < F.col("valid_from")) | (F.col("order_date") >= F.col("valid_to"))
    assert joined.filter(outside).isEmpty()


def test_facts_are_the_same_when_keys_are_hot(tables):
    silver, gold = tables.stored()
    customers = skew.hot_keys(silver["sales_order"], "customer_id", 5)
    orders = facts.fact_sales_order(
        silver["sales_order"], silver["invoice"], silver["payment"], silver["exchange_rates"],
        gold["dim_customer"], gold["dim_customer_account"], silver["channels"], hot_customers=customers, hot_rows=5,
    )
    assert customers.count() > 10 and rows(orders) == rows(gold["fact_sales_order"])
    hot_orders = skew.hot_keys(silver["shipment"], "order_id", 2)
    shipments = facts.fact_shipment(silver["shipment"], gold["fact_sales_order"], hot_orders)
    assert hot_orders.count() > 10 and rows(shipments) == rows(gold["fact_shipment"])


def test_unknown_product_keeps_revenue(tables):
    silver, gold = tables.stored()
    lost = gold["fact_sales_order_lines"].filter("product_sk = -1").count()
    assert lost == silver["sales_order_lines"].filter("product_sku IS NULL").count() > 0


def test_facts_have_the_documented_columns(tables):
    _, gold = tables.stored()
    assert gold["fact_sales_order"].columns == [
        "order_sk", "order_number", "order_timestamp", "customer_sk", "customer_name", "bill_to_account_sk",
        "account_payment_terms", "order_status", "channel_name", "payment_method", "invoice_timestamp",
        "payment_timestamp", "order_total_gbp", "order_date", "invoice_date", "payment_date", "order_date_id",
        "invoice_date_id", "payment_date_id",
    ]
    assert len(gold["fact_shipment"].columns) == 22
    assert len(gold["dim_date"].columns) == 22


def test_hash_and_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "k string, v string")
    assert df.select(row_hash(["k", "v"])).distinct().count() == 2
    same = df.select(surrogate_key("k").alias("x"), F.xxhash64(F.lit("a")).alias("y")).distinct().first()
    assert same.x == same.y


def test_default_calendar(spark):
    days = cal.calendar(cal.fixed_bounds(spark))
    assert days.count() == 1462
    r = days.filter("date_id = '20240331'").first()
    assert (r.day_name, r.day_of_week, r.is_weekend, r.week_of_year) == ("Sunday", 7, True, 13)
    assert (r.fiscal_year, r.fiscal_month_number, r.fiscal_quarter_number) == (2023, 12, 4)
    assert (r.quarter_year, r.month_id, r.month_end_date) == ("2024-Q1", "202403", datetime.date(2024, 3, 31))
    unknown = days.filter("date_id = '-1'").first()
    assert (unknown.full_date, unknown.month_name, unknown.calendar_year) == (None, "Unknown", None)


def test_latest_payment_names_the_method(spark):
    data = [("P2", "I1", "2024-01-05", "Card"), ("P1", "I1", "2024-01-05", "Cash"), ("P3", "I1", "2024-01-01", "Wire"),
            ("P4", "I1", None, "Odd"), ("P5", "I2", None, "Only"), ("P6", None, "2024-01-01", "Lost")]
    df = spark.createDataFrame(data, "payment_id string, invoice_number string, d string, payment_method string")
    out = facts.payment_by_invoice(df.withColumn("payment_date", F.to_timestamp("d")))
    assert [tuple(map(str, r)) for r in rows(out)] == [("I1", "2024-01-01", "Cash"), ("I2", "None", "Only")]


def test_tidy_handles_every_blank(spark):
    df = spark.createDataFrame([("a\tb",), ("a\x0bb ",), ("\fa",), ("a\r\n b",), ("abc",), (None,), ("  x   y ",)], "s string")
    assert [r.t for r in df.select(clean.tidy("s").alias("t")).collect()] == ["a b", "a b", "a", "a b", "abc", None, "x y"]


def test_net_value(spark):
    df = spark.createDataFrame([(3, "10.05", "0.05"), (1, "10.00", None)], "q bigint, p string, d string")
    df = df.select("q", F.col("p").cast("decimal(18,2)").alias("p"), F.col("d").cast("decimal(5,4)").alias("d"))
    assert [str(r.n) for r in df.select(facts.net_value("q", "p", "d").alias("n")).collect()] == ["28.64", "10.00"]


def test_dedup_is_limited_before_the_shuffle(tables):
    text = plan(tables.silver("sales_order_lines"))
    physical = text[text.index("Physical Plan"):]
    assert physical.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["fact_sales_order", "fact_sales_order_lines", "fact_shipment", "scd2_merge",
                                  "fx_range_join", "upsert_guarded", "silver_sales_order"])
def test_no_nested_loop_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_required_keys_reach_the_scan(spark, tmp_path):
    from cairnlake.plans.silver import prepared
    from cairnlake.sources import landing
    from cairnlake.sources.feeds import FEEDS

    feed, table = FEEDS["shipment"], str(tmp_path / "shipment")
    landing.replace_batch(spark.createDataFrame([], landing.bronze_schema(feed)), table, "2024-01")
    stored = landing.read_batch(spark, table, "2024-01", landing.bronze_schema(feed))
    text = plan(prepared(stored, feed).select("shipment_id"))
    assert "PushedFilters: [IsNotNull(shipment_id)]" in text
    assert "ReadSchema: struct<shipment_id:string>" in text


@pytest.mark.parametrize("name", sorted(warehouse.GOLD_KEYS))
def test_rebuilding_gold_changes_no_row(tables, name):
    _, gold = tables.stored()
    once = warehouse.merge_gold(None, gold[name], name)
    twice = warehouse.merge_gold(once, gold[name], name)
    assert rows(twice.select(*gold[name].columns)) == rows(gold[name])


def test_second_address_does_not_double_versions(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    address = tables.silver("address")
    twice = address.unionByName(address.withColumn("customer_address_id", F.concat("customer_address_id", F.lit("z"))))
    places = tables.silver("cities"), tables.silver("regions")
    for build in (dimensions.dim_customer, dimensions.dim_customer_account):
        plain = build(tables.silver("cust_master"), address, *places)
        assert rows(build(tables.silver("cust_master"), twice, *places)) == rows(plain)


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f.name for top in folders for f in Path(top).rglob("shuffle_*") if f.is_file()}


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    counted = spark.range(50_000).groupBy((F.col("id") % 7_000).alias("k")).count()
    stored = warehouse.publish(counted, str(tmp_path / "t"))
    assert _shuffle_files(spark) <= before
    assert stored.count() == 7_000 and counted.count() == 7_000


def test_one_pass_shuffles_values_once(tables):
    silver, gold = tables.stored()
    refs = [*warehouse.FOREIGN_KEYS, *((f, c, "dim_date") for f, c in warehouse.DATE_KEYS)]
    found = checks.key_faults({t: gold[t] for t in warehouse.SURROGATE_KEYS}, warehouse.SURROGATE_KEYS, refs)
    # One by value, one for the single row.
    assert plan(found).split("== Physical Plan ==")[1].count("Exchange") == 2


def test_lines_without_their_flag_cost_no_twin_search(tables):
    lines = tables.silver("sales_order_lines")
    optimized = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "_repeated" in optimized(lines)
    fact = optimized(facts.fact_sales_order_lines(lines, tables.order_keys, tables.dim_product))
    assert "_repeated" not in fact
    # The outermost join brings the order's columns, after the product's key.
    assert "_order#" in next(line for line in fact.splitlines() if "Join LeftOuter" in line)
