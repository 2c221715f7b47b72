"""Deduplication and repeated-row flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnlake.functions.keys import surrogate_key


def total_order(df: DataFrame, first: Sequence[Column] = (), skip: Sequence[str] = ()) -> list[Column]:
    """``first``, then every other column ascending, so a survivor is never arbitrary."""
    return [*first, *[F.col(c).asc() for c in df.columns if c not in set(skip)]]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order``.

    ``row_number() = 1`` is planned with a group limit below the shuffle, so each
    map task sends at most one row per key and a hot key costs nothing extra.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def dedup_key(df: DataFrame, keys: Sequence[str], newest: Sequence[Column] = ()) -> DataFrame:
    """Composite-key dedup with a reproducible survivor."""
    return latest_per_key(df, keys, total_order(df, newest, skip=keys))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def flag_repeated(
    df: DataFrame, group: Sequence[str], identity: str, flag: str, present: str, among: DataFrame | None = None
) -> DataFrame:
    """Mark rows alike in all ``group`` values with a row of another ``identity``, where ``present`` is set.

    ``among`` holds the rows to look for twins in (default: ``df`` itself). Twins are
    found with a pre-aggregated min and max of the identity's surrogate key (a number,
    so the hash aggregate applies) joined back to the rows, not with a window: a group
    holding a large part of the table is reduced before the shuffle, and its rows stay
    spread (a skewed join side is split). The struct key makes NULL equal NULL, as
    grouping does.
    """
    alike = F.when(F.col(present).isNotNull(), F.struct(*group))
    twins = (
        (df if among is None else among)
        .filter(F.col(present).isNotNull())
        .select(alike.alias("_group"), surrogate_key(identity).alias("_id"))
        .groupBy("_group")
        .agg(F.min("_id").alias("_lo"), F.max("_id").alias("_hi"))
        .filter("_lo <> _hi")
        .select("_group", F.lit(True).alias("_repeated"))
    )
    return (
        df.withColumn("_group", alike)
        .join(twins, "_group", "left")
        .withColumn(flag, F.coalesce("_repeated", F.lit(False)))
        .drop("_group", "_repeated")
    )
