import pytest
from pyspark.sql import functions as F

from cairnlake.plans.silver import silver
from cairnlake.sources import landing
from cairnlake.sources.feeds import FEEDS, Feed
from tests.conftest import plan, rows

SCHEMA = "code string, amount int, day date"


def csv(tmp_path, text, name="data.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_csv_reads_declared_types(spark, tmp_path):
    df = landing.scan_csv(spark, csv(tmp_path, "code,amount,day\n a,1,2024-01-02\n,,\n"), SCHEMA)
    assert [(c, t) for c, t in df.dtypes] == [("code", "string"), ("amount", "int"), ("day", "date")]
    assert [tuple(map(str, r)) for r in df.collect()] == [(" a", "1", "2024-01-02"), ("None", "None", "None")]


@pytest.mark.parametrize(
    "text",
    [
        "amount,code,day\n1,a,2024-01-02\n",  # header in another order
        "code,amount,day\na,not a number,2024-01-02\n",
        "code,amount,day\na,1,2024-01-02,extra\n",
    ],
)
def test_csv_that_differs_fails_even_on_a_partial_read(spark, tmp_path, text):
    df = landing.scan_csv(spark, csv(tmp_path, text), SCHEMA).select("amount")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        df.collect()


def test_late_column_reads_null(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    spark.range(2).write.parquet(old)
    spark.range(1).withColumn("source", F.lit("web")).write.parquet(new)
    df = landing.scan_parquet(spark, [old, new], "id bigint, source string")
    assert df.filter("source IS NULL").count() == 2


def batch(spark, value, n, batch_id):
    return spark.range(n).select(F.lit(value).alias("v"), F.lit(batch_id).alias("batch_id"))


def counts(spark, table):
    return rows(landing.read_table(spark, table).groupBy("batch_id", "v").count(), "batch_id", "v", "count")


def test_replace_batch(spark, tmp_path):
    table = str(tmp_path / "bronze")
    landing.replace_batches(batch(spark, "a", 3, "2024-01").unionByName(batch(spark, "b", 2, "2024-02")), table)
    for _ in range(2):
        landing.replace_batch(batch(spark, "c", 5, "2024-02"), table, "2024-02")
    assert counts(spark, table) == [("2024-01", "a", 3), ("2024-02", "c", 5)]
    landing.replace_batch(batch(spark, "c", 0, "2024-02"), table, "2024-02")
    assert counts(spark, table) == [("2024-01", "a", 3)]
    wider = batch(spark, "d", 1, "2024-03").withColumn("late", F.lit(1))
    landing.replace_batch(wider, table, "2024-03")
    assert rows(landing.read_table(spark, table).select("batch_id", "late").distinct()) == [
        ("2024-01", None), ("2024-03", 1)
    ]


def test_many_batches_replace_only_themselves(spark, tmp_path):
    table = str(tmp_path / "bronze")
    landing.replace_batches(batch(spark, "a", 3, "2024-01").unionByName(batch(spark, "b", 2, "2024-02")), table)
    landing.replace_batches(batch(spark, "z", 4, "2024-02"), table)
    assert counts(spark, table) == [("2024-01", "a", 3), ("2024-02", "z", 4)]


@pytest.mark.parametrize("bad", ["", "2024", "2024-13", "2024-1", "../x", None])
def test_batch_id_format(bad):
    with pytest.raises(ValueError):
        landing.require_batch_id(bad)


def test_batch_read_prunes_partitions(spark, tmp_path):
    table = str(tmp_path / "bronze")
    landing.replace_batches(batch(spark, "a", 3, "2024-01").unionByName(batch(spark, "b", 2, "2024-02")), table)
    one = landing.read_batch(spark, table, "2024-02")
    assert "PartitionFilters: [isnotnull(batch_id" in plan(one)
    assert rows(one, "v") == [("b",), ("b",)]


def test_landing_to_silver(spark, tmp_path):
    """A delivered CSV batch through bronze to silver, with its provenance."""
    drop, table = tmp_path / "landing", str(tmp_path / "bronze")
    (drop / "2024-01" / "cities").mkdir(parents=True)
    csv(drop / "2024-01" / "cities", "city_id,city_name,region_id,country\n1,  Big   Town ,9,ME\n1,Big Town,9,ME\n,Nowhere,9,US\n")
    feed: Feed = FEEDS["cities"]
    for _ in range(2):
        landing.ingest(spark, feed, str(drop), table, "2024-01")
    bronze = landing.read_table(spark, table, landing.bronze_schema(feed))
    assert bronze.count() == 3
    (city,) = silver(bronze, "cities").collect()
    assert (city.city_name, city.region_name, city.region_full_name) == ("Big Town", "ME", "Middle East & Africa")
    assert city.source_file.endswith("data.csv") and city.ingestion_timestamp is not None


def test_pending_batches(spark):
    landed = spark.createDataFrame([("2024-01",), ("2024-02",), ("2024-03",), ("2024-02",)], "batch_id string")
    log = spark.createDataFrame([("2024-01", "completed"), ("2024-02", "failed")], "batch_id string, status string")
    assert rows(landing.pending_batches(landed, log)) == [("2024-02",), ("2024-03",)]
    assert rows(landing.next_batch(landed, log)) == [("2024-02",)]
    done = landed.select("batch_id", F.lit("completed").alias("status")).distinct()
    assert rows(landing.next_batch(landed, done)) == []


def test_append_fills_missing_columns(spark):
    log = spark.createDataFrame([("2024-01", "failed", "disk")], "batch_id string, status string, error_message string")
    new = spark.createDataFrame([("2024-02", "in-progress")], "batch_id string, status string")
    assert rows(landing.append_rows(log, new)) == [("2024-01", "failed", "disk"), ("2024-02", "in-progress", None)]
