"""Landing to bronze: declared scans, provenance, replace-batch writes, batch discovery."""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cairnlake.operators.merge import overwrite_partitions
from cairnlake.sources.feeds import Feed

BATCH_FORMAT = re.compile(r"\d{4}-(0[1-9]|1[0-2])")


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def scan_csv(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """Header CSV under a declared schema; a malformed row, or a header that differs, fails the read.

    A declared schema alone would be applied by position, so the header is compared
    too (``enforceSchema`` off), and every declared column is parsed even when a
    query needs only some, so a row with surplus fields cannot slip through.
    """
    return (
        spark.read.schema(_schema(schema))
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .csv(path)
    )


def scan_parquet(spark: SparkSession, path: str | list[str], schema: str | T.StructType) -> DataFrame:
    """Parquet under a declared schema: a declared column an older file lacks reads NULL."""
    return spark.read.schema(_schema(schema)).parquet(*([path] if isinstance(path, str) else path))


def schema_drift(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """How delivered Parquet files differ from the declaration: ``file``, ``column``, ``kind``, ``declared``, ``delivered``.

    Kinds: ``missing`` (the scan reads NULL), ``undeclared`` (the scan drops it), ``type``. Only
    footers are read; names match whatever their case, as in the scan. Files of one delivery are few.
    """
    declared = {f.name.lower(): f for f in _schema(schema).fields}
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(place, True)
    files = []
    while listed.hasNext():
        found = listed.next().getPath()
        if not found.getName().startswith(("_", ".")):
            files.append(found.toString())

    def differences(file: str) -> list[tuple]:
        delivered = {f.name.lower(): f for f in spark.read.parquet(file).schema.fields}
        kind = lambda f: f.dataType.simpleString()
        gone = [(file, f.name, "missing", kind(f), None) for n, f in declared.items() if n not in delivered]
        new = [(file, f.name, "undeclared", None, kind(f)) for n, f in delivered.items() if n not in declared]
        both = [(declared[n], f) for n, f in delivered.items() if n in declared]
        return gone + new + [(file, d.name, "type", kind(d), kind(f)) for d, f in both if kind(d) != kind(f)]

    with ThreadPoolExecutor(max_workers=8) as pool:
        rows = [row for some in pool.map(differences, sorted(files)) for row in some]
    return spark.createDataFrame(rows, "file string, column string, kind string, declared string, delivered string")


def scan_feed(spark: SparkSession, feed: Feed, path: str | list[str]) -> DataFrame:
    scan = scan_csv if feed.file_format == "csv" else scan_parquet
    return scan(spark, path, feed.struct)


def with_provenance(df: DataFrame) -> DataFrame:
    """Load time and physical file of every row of a file scan."""
    return df.withColumns(
        {"ingestion_timestamp": F.current_timestamp(), "source_file": F.col("_metadata.file_path")}
    )


def require_batch_id(batch_id: str) -> str:
    if not BATCH_FORMAT.fullmatch(batch_id or ""):
        raise ValueError(f"batch id {batch_id!r} is not yyyy-MM")
    return batch_id


def replace_batch(df: DataFrame, table: str, batch_id: str) -> None:
    """Make one batch of a bronze table exactly ``df``; other batches are not touched.

    Dynamic overwrite swaps the batch's partition when the job commits, so running a
    batch again never duplicates it and a failed run leaves the old rows. It would leave
    them for an empty delivery too, so that case overwrites the partition folder itself.
    """
    require_batch_id(batch_id)
    delivered = df.drop("batch_id")
    if delivered.isEmpty():
        delivered.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
        return
    stamped = delivered.withColumn("batch_id", F.lit(batch_id))
    overwrite_partitions(stamped, table, "batch_id")


def replace_batches(df: DataFrame, table: str) -> None:
    """Replace every batch named in ``df.batch_id`` at once (backfill of many months).

    The rebalance hint lets adaptive execution split a large month over several
    tasks and files and merge small ones.
    """
    overwrite_partitions(df.hint("rebalance", "batch_id"), table, "batch_id")


def read_table(spark: SparkSession, table: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Bronze table; batches written before a column existed read NULL for it."""
    reader = spark.read.option("basePath", table)
    if schema is not None:
        declared = T.StructType([f for f in _schema(schema).fields if f.name != "batch_id"])
        return reader.schema(declared.add("batch_id", T.StringType())).parquet(table)
    df = reader.option("mergeSchema", True).parquet(table)
    return df.withColumn("batch_id", F.col("batch_id").cast("string"))


def read_batch(spark: SparkSession, table: str, batch_id: str, schema: str | T.StructType | None = None) -> DataFrame:
    """One batch; the filter prunes partitions."""
    return read_table(spark, table, schema).filter(F.col("batch_id") == batch_id)


def ingest(spark: SparkSession, feed: Feed, landing: str, table: str, batch_id: str) -> None:
    """Load one delivered batch of one feed: ``landing/<batch>/<feed>`` to its bronze table."""
    delivered = scan_feed(spark, feed, f"{landing}/{require_batch_id(batch_id)}/{feed.name}")
    replace_batch(with_provenance(delivered), table, batch_id)


def bronze_schema(feed: Feed) -> T.StructType:
    """Delivered columns plus provenance and batch."""
    return feed.struct.add("ingestion_timestamp", "timestamp").add("source_file", "string").add("batch_id", "string")


def append_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Table with rows added; columns the rows lack become NULL."""
    return table.unionByName(rows, allowMissingColumns=True).select(*table.columns)


def distinct_batches(table: DataFrame) -> DataFrame:
    return table.select("batch_id").distinct()


def pending_batches(landed: DataFrame, log: DataFrame, taken: Iterable[str] = ("in-progress", "completed")) -> DataFrame:
    """Landed batches nobody works on or has finished; failed ones stay eligible."""
    busy = log.filter(F.col("status").isin(*taken))
    return distinct_batches(landed).join(busy, "batch_id", "left_anti")


def next_batch(landed: DataFrame, log: DataFrame) -> DataFrame:
    """The oldest pending batch, or no row."""
    return pending_batches(landed, log).orderBy("batch_id").limit(1)
