"""Lookup, month-range and point-in-time joins, and per-key reductions used before joining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from cairnlake.operators import skew
from cairnlake.operators.scd2 import end_or_far_future

# Largest lookup table, in rows, that is sent whole to every executor.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint after counting at most ``max_rows + 1`` rows; a larger side is left to shuffle."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def lookup(df: DataFrame, table: DataFrame, on: str | Sequence[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join to a reference table, broadcast when its checked size allows."""
    return df.join(broadcast_if_small(table, max_rows), on, "left")


def in_month(
    df: DataFrame, rates: DataFrame, on: str, day: str, month_start: str, values: Sequence[str]
) -> DataFrame:
    """Left join to the monthly row whose ``[month_start, month_start + 1 month)`` holds ``day``.

    Each monthly row is listed under the one or two calendar months its period
    touches, which turns the range into an equality on (``on``, month) that hashes
    or broadcasts by size; the range itself stays as the residual condition.
    """
    end = F.add_months(F.col("_start"), 1)
    listed = rates.select(
        F.col(on).alias("_on"), F.to_date(month_start).alias("_start"), *values
    ).withColumn(
        "_month",
        F.explode(F.array_distinct(F.array(F.trunc("_start", "month"), F.trunc(F.date_sub(end, 1), "month")))),
    )
    met = (
        (F.col(on) == F.col("_on"))
        & (F.trunc(F.to_date(day), "month") == F.col("_month"))
        & (F.to_date(day) >= F.col("_start"))
        & (F.to_date(day) < end)
    )
    return df.join(listed, met, "left").drop("_on", "_start", "_month")


def as_of_version(
    df: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    values: Sequence[str],
    hot: DataFrame | None = None,
    hot_rows: int = skew.HOT_ROWS,
    spread: Sequence[str] | None = None,
    lookups: Sequence[tuple[DataFrame, Sequence[str]]] = (),
) -> DataFrame:
    """Left join each row to the version of its key that was valid on ``day``.

    Periods are half open and do not overlap, so the row count never changes. The
    key is the equality, the period the residual. With ``hot`` (see ``skew.hot_keys``)
    the rows of those keys are salted by a hash of the ``spread`` columns over several
    tasks and the few versions of the key copied to each of them; ``hot`` may come from
    any cheaper count of the same key, as it steers distribution only. ``lookups`` are
    (table, columns) pairs unique on the same key; they are left joined on the same
    partitioning, so ``df`` is shuffled once for all of them. Rows without a (text) key
    are spread by the first ``spread`` column.
    """
    on = ["_key"]
    spread = list(spread or df.columns)
    is_text = isinstance(df.schema[key].dataType, T.StringType)
    df = df.withColumn("_key", skew.spread_key(key, spread[0]) if is_text else F.col(key))
    periods = versions.select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_from"), end_or_far_future().alias("_until"), *values
    )
    tables = [table.select(F.col(key).alias("_key"), *columns) for table, columns in lookups]
    if hot is not None:
        on = ["_key", "_salt"]
        per_key = skew.salts(hot, key, hot_rows).withColumnRenamed(key, "_key")
        df = skew.salt_rows(df, "_key", per_key, spread)
        periods = skew.replicate_rows(periods, "_key", per_key)
        tables = [skew.replicate_rows(table, "_key", per_key) for table in tables]
    date = F.to_date(F.col(f"d.{day}"))
    met = (date >= F.col("v._from")) & (date < F.col("v._until"))
    for k in on:
        met = met & (F.col(f"d.{k}") == F.col(f"v.{k}"))
    out = df.alias("d").join(periods.alias("v"), met, "left").select("d.*", *[f"v.{c}" for c in values])
    for table in tables:
        out = out.join(table, on, "left")
    return out.drop("_key", "_salt")


def as_of_sorted(
    df: DataFrame,
    versions: DataFrame,
    key: str,
    day: str,
    values: Sequence[str],
    hot: DataFrame | None = None,
    hot_rows: int = skew.HOT_ROWS,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of ``as_of_version`` from one sorted stream of versions and rows, without a join.

    Versions and rows of a key are sorted by date together and the last version begun is carried
    forward; it holds if it has not ended by the row's day. A key costs a sort of its versions
    plus its rows, where a join on the key tests each row against each version. One exchange
    serves both sides. Use it for keys with many versions; for few, the join can broadcast.

    With ``hot`` the rows of those keys are spread by a hash of ``spread`` over several tasks, each of
    which gets all versions of the key. Periods of a key do not overlap; one that is empty or
    has no start matches nothing, and so does a row without key or day.
    """
    spread = list(spread or df.columns)
    is_text = isinstance(df.schema[key].dataType, T.StringType)
    rows = df.select(
        (skew.spread_key(key, spread[0]) if is_text else F.col(key)).alias("_key"),
        F.to_date(day).alias("_at"), F.lit(1).alias("_kind"), F.struct(*df.columns).alias("_row"),
        *([F.xxhash64(*spread).alias("_spread")] if hot is not None else []),
    )
    begun = versions.select(
        F.col(key).alias("_key"), F.col("valid_from").cast("date").alias("_at"), F.lit(0).alias("_kind"),
        F.struct(end_or_far_future().alias("_until"), *values).alias("_version"),
    ).filter("_key IS NOT NULL AND _at < _version._until")
    by = ["_key"]
    if hot is not None:
        by = ["_key", "_salt"]
        per_key = skew.salts(hot, key, hot_rows).withColumnRenamed(key, "_key")
        rows = skew.salt_rows(rows, "_key", per_key, ["_spread"]).drop("_spread")
        begun = skew.replicate_rows(begun, "_key", per_key)
    # A version that begins on the row's day comes before the row.
    carried = Window.partitionBy(*by).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stream = rows.unionByName(begun, allowMissingColumns=True)
    met = stream.withColumn("_last", F.last("_version", ignorenulls=True).over(carried)).filter("_kind = 1")
    holds = F.col("_key").isNotNull() & (F.col("_at") < F.col("_last._until"))
    return met.select("_row.*", *[F.when(holds, F.col(f"_last.{c}")).alias(c) for c in values])


def rows_at_max(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows that hold the largest ``value`` of their key; ties stay."""
    peak = df.groupBy(key).agg(F.max(value).alias("_peak"))
    return df.join(peak, key).filter(F.col(value) == F.col("_peak")).drop("_peak")


def missing_references(df: DataFrame, column: str, table: DataFrame, table_key: str) -> DataFrame:
    """Non-null foreign key values without a counterpart, with the number of rows that use them.

    References are counted per value first, so the anti join sees each value once
    however often it occurs.
    """
    used = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    known = table.select(F.col(table_key).alias(column))
    return used.join(known, column, "left_anti")


def bridge(links: DataFrame, left: tuple[DataFrame, str, str], right: tuple[DataFrame, str, str]) -> DataFrame:
    """Resolve a link table to the surrogate keys of its two dimensions.

    Each side is (dimension, its business key named as in ``links``, its surrogate key).
    """
    out = links
    for dim, business_key, sk in (left, right):
        out = out.join(dim.select(business_key, sk), business_key, "left")
    return out


