"""Stored tables with one row per key, each row in a partition it never leaves.

The partition is either a hash bucket of some columns, or the batch that first brought the key. So an
upsert replaces the partitions it touches in one dynamic overwrite: no row moves and none
is ever stored twice, also when a run dies half-way.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cairnlake.operators.joins import BROADCAST_ROWS, broadcast_if_small
from cairnlake.operators.merge import AUDIT_COLUMNS, _any_null, replace_partitions, require_unambiguous, stored, with_audit
from cairnlake.session import work_path

#: The partition column.
PLACE = "_place"
OLD, NEW = "_old_", "_new_"


def bucket(columns: Sequence[str], buckets: int) -> Column:
    """A hash bucket as text, so that it can share its column's type with batches."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("string")


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The stored rows with their partition, or None before the first load."""
    return stored(spark, path, T.StructType([*schema.fields, T.StructField(PLACE, T.StringType())]))


def kept(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``df`` written once and read back, for plans that use it several times."""
    path = path or work_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [left[k] == F.col(f"{prefix}{k}") for k in keys])


def upsert_keyed(
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    batch: str | None = None,
    buckets: Sequence[str] = (),
    n_buckets: int = 64,
    guard: str | None = None,
    at: Column | None = None,
    carried: Sequence[str] = (),
    unique: bool = False,
    replaces: tuple[str, DataFrame] | None = None,
    changes_path: str | None = None,
) -> DataFrame:
    """Create a stored table from ``source`` or upsert into it, with audit columns; returns what was touched.

    Give either ``batch``, where new keys go to the partition of that name, or ``buckets``, the columns
    (part of the key, or fixed for one) whose hash is the partition. Of a table in buckets only those of the
    source's rows are read; of one in batches also the key columns of all. ``guard`` names a column
    that must not go backwards. Rows with a NULL key match nothing: those that an earlier run of the
    same batch has added are replaced, so that a batch may run again.

    ``replaces`` is a column that ``buckets`` consists of, and values of it: stored rows with one of these
    values that the source lacks are removed.

    A source of a checked small size is broadcast, and then the target is neither shuffled nor sorted;
    a larger one is joined by shuffling both.

    Returns one row per source row: the keys, and each column in ``carried`` as it was (``_old_...``, NULL
    for a new key) and as delivered (``_new_...``). It is stored, at ``changes_path`` if given, before
    the table changes, so a run that dies leaves it behind.
    """
    if (batch is None) == (not buckets):
        raise ValueError("give either a batch or bucket columns")
    spark = source.sparkSession
    here = F.lit(batch) if batch is not None else bucket(buckets, n_buckets)
    rows = with_audit(source, at)
    rows = kept((rows if unique else require_unambiguous(rows, keys)).withColumn(PLACE, here), "delivered")
    target = read(spark, path, T.StructType(rows.schema.fields[:-1]))
    if target is None:
        told = rows.select(*keys, *[x for c in carried for x in (F.lit(None).cast(rows.schema[c].dataType).alias(f"{OLD}{c}"), F.col(c).alias(f"{NEW}{c}"))])
        state, emptied = rows, []
    else:
        # New keys of a batch all go to its own partition.
        touched = {batch} if batch is not None else {r[0] for r in rows.select(PLACE).distinct().collect()}
        if replaces is not None:
            gone_in = replaces[1].select(bucket([replaces[0]], n_buckets).alias(PLACE)).distinct()
            touched |= {r[0] for r in gone_in.collect()}
        looked_in = target if batch is not None else target.filter(F.col(PLACE).isin(*touched))
        # Everything joined to the target has at most the source's rows.
        few = rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        sent = F.broadcast if few else (lambda df: df)
        asked = sent(rows.select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
        found = looked_in.join(asked, _same(looked_in, keys, "_k_")).select(*keys, PLACE, *[F.col(c).alias(f"{OLD}{c}") for c in carried])
        met = kept(found, "met")
        touched |= {r[0] for r in met.select(PLACE).distinct().collect()}
        affected = target.filter(F.col(PLACE).isin(*touched)) if touched else target.limit(0)
        emptied = []
        if batch is not None:
            again = F.coalesce(_any_null(keys) & (F.col(PLACE) == batch), F.lit(False))
            if not affected.filter(again).isEmpty():
                affected, emptied = affected.filter(~again), [batch]
        news = sent(rows.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*rows.columns).alias("_new")))
        joined = affected.join(news, _same(affected, keys, "_k_"), "left")
        if replaces is not None:
            values = broadcast_if_small(replaces[1].select(F.col(replaces[0]).alias("_value")).distinct())
            joined = joined.join(values, F.col(replaces[0]) == F.col("_value"), "left")
            joined = joined.filter(F.col("_value").isNull() | F.col("_new").isNotNull())
            emptied = sorted(touched)
        hit = F.col("_new").isNotNull()
        if guard is not None:
            hit = hit & F.coalesce(F.col("_new")[guard] >= F.col(guard), F.lit(False))
        changed = {*update, "updated_timestamp"}
        old_rows = joined.select(*[F.when(hit, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in rows.columns])
        known = sent(met.select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
        state = old_rows.unionByName(rows.join(known, _same(rows, keys, "_k_"), "left_anti"))
        old = met.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[f"{OLD}{c}" for c in carried])
        told = rows.join(old, _same(rows, keys, "_k_"), "left").select(*keys, *[x for c in carried for x in (F.col(f"{OLD}{c}"), F.col(c).alias(f"{NEW}{c}"))])
    changes = kept(told, "changes", changes_path)
    replace_partitions(state.hint("rebalance", PLACE), path, PLACE, emptied)
    return changes


def differing(fresh: DataFrame, old: DataFrame | None, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``fresh`` that the stored table lacks or holds with other values in ``columns`` (all but audit)."""
    if old is None:
        return fresh
    compared = [c for c in columns or fresh.columns if c not in (*keys, *AUDIT_COLUMNS, PLACE)]
    before = old.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*compared).alias("_before"))
    same = reduce(lambda a, b: a & b, [fresh[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    both = fresh.join(before, same, "left")
    return both.filter(F.col("_before").isNull() | ~F.struct(*compared).eqNullSafe(F.col("_before"))).select(*fresh.columns)


def touched(changes: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """The values that ``column`` had before or has now in the changed rows."""
    both = changes.select(F.explode(F.array(f"{OLD}{column}", f"{NEW}{column}")).alias(name or column))
    return both.filter(F.col(name or column).isNotNull()).distinct()
