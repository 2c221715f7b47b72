"""Hot-key handling: find heavy keys, salt joins on them, rank inside them.

Results never depend on what counts as hot; only the distribution of work does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnlake.session import work_path

# A key with more rows than this is spread over several tasks.
HOT_ROWS = 5_000_000


def spread_key(key: str, row_id: str) -> Column:
    """Join or grouping key in which a NULL becomes a value of its own per row.

    NULL matches nothing, yet all rows with a NULL key would hash to one partition of
    a left join or a window. The leading NUL character keeps the replacement apart
    from every real key.
    """
    return F.coalesce(F.col(key), F.concat(F.lit("\0"), F.col(row_id)))


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows and their count, or None when there is no such key.

    One partially aggregated pass over the key column decides it before the real plan
    is built, so tables without a hot key get the plain plan. At most
    ``total rows / hot_rows`` keys can come out (200,000 for 10**12 rows): that is the
    bound that makes fetching and broadcasting them safe.
    """
    heavy = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter((F.col("n_rows") > hot_rows) & F.col(key).isNotNull())
    )
    found = heavy.collect()
    return df.sparkSession.createDataFrame(found, heavy.schema) if found else None


def salts(hot: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Number of salt values per hot key, about ``hot_rows`` rows each."""
    return hot.select(key, F.ceil(F.col("n_rows") / F.lit(hot_rows)).cast("int").alias("_salts"))


def salt_rows(df: DataFrame, key: str, per_key: DataFrame, spread: Sequence[str]) -> DataFrame:
    """Add ``_salt``: 0 for ordinary keys, a hash of ``spread`` for rows of a hot key."""
    return (
        df.join(F.broadcast(per_key), key, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(
                F.pmod(F.xxhash64(*spread), F.col("_salts")).cast("int")
            ),
        )
        .drop("_salts")
    )


def replicate_rows(df: DataFrame, key: str, per_key: DataFrame) -> DataFrame:
    """Copy the rows of hot keys once per salt, so each salted row meets all of them."""
    return (
        df.join(F.broadcast(per_key), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )


def sequence_in_group(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    count_as: str,
    sequence_as: str,
    hot: DataFrame | None = None,
    cell_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the size of each row's group and the row's place in it.

    ``order`` must be unique inside a group (NULLs first) and ``group`` must be set
    (see ``spread_key``). Ordinary groups use one window. The rows of the groups listed in
    ``hot`` are range-partitioned by group and order into cells of about ``cell_rows`` rows,
    whatever their values look like, and written, as cells must not change between
    their two uses; rows are ranked inside their cell and shifted by the number of rows in
    earlier cells, so no task sees a whole hot group.
    """
    w = Window.partitionBy(group)

    def by_window(rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {
                count_as: F.count(F.lit(1)).over(w),
                sequence_as: F.row_number().over(w.orderBy(*order)).cast("long"),
            }
        )

    if hot is None:
        return by_window(df)
    cells_needed = hot.agg(F.ceil(F.sum("n_rows") / F.lit(cell_rows))).first()[0]
    names = F.broadcast(hot.select(group))
    ordinary = by_window(df.join(names, group, "left_anti"))
    ranges = df.join(names, group).repartitionByRange(max(2, int(cells_needed)), group, *order)
    path = work_path(df.sparkSession, "hot-groups")
    placed = ranges.withColumn("_cell", F.spark_partition_id())
    placed.write.parquet(path)
    heavy = df.sparkSession.read.schema(placed.schema).parquet(path)
    cells = heavy.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    shifts = cells.select(
        group,
        "_cell",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(group)).alias(count_as),
    )
    in_cell = Window.partitionBy(group, "_cell").orderBy(*order)
    ranked = (
        heavy.withColumn("_place", F.row_number().over(in_cell))
        .join(shifts, [group, "_cell"])
        .withColumn(sequence_as, F.col("_shift") + F.col("_place"))
    )
    return ordinary.unionByName(ranked.select(*ordinary.columns))
