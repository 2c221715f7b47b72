"""Upserts expressed as joins that return the new state of a table.

A source must hold one row per merge key: a merge fails where it does not, unless
``unique=True`` says that the caller has just deduplicated it.
A NULL merge key matches nothing unless asked to, so such rows are set aside
before the join instead of piling up in the one partition NULL hashes to.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cairnlake.operators.dedup import latest_per_key, total_order

AUDIT_COLUMNS = ("created_timestamp", "updated_timestamp")


def with_audit(df: DataFrame, at: Column | None = None) -> DataFrame:
    """First-load form of a row: created and updated at the same moment."""
    moment = F.current_timestamp() if at is None else at
    return df.withColumns({name: moment for name in AUDIT_COLUMNS})


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def ambiguous_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge keys found on more than one source row; NULL keys cannot match and are left out."""
    return (
        source.filter(~_any_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def require_unambiguous(source: DataFrame, keys: Sequence[str], null_keys: bool = True) -> DataFrame:
    """``source`` as it is, but the job fails when two rows would match one target row, as a merge must.

    The count is a window over the merge key, whose partitioning the join then uses, so
    it costs a sort and no shuffle or job of its own. Rows with a NULL key match nothing and
    may repeat; each is put in a group of its own. ``null_keys=False`` promises there are none.
    """
    parts = [F.col(k) for k in keys]
    if null_keys:
        # Random, so that many rows with NULL keys do not meet in one task.
        parts.append(F.when(_any_null(keys), F.rand(7)))
    alone = F.count(F.lit(1)).over(Window.partitionBy(*parts)) == 1
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
    told = F.raise_error(F.concat(F.lit("several source rows share merge key "), shown)).cast("boolean")
    checked = source.withColumn("_alone", alone)
    fails = ~F.col("_alone")
    if null_keys:
        fails = fails & ~_any_null(keys)
    return checked.filter(F.when(fails, told).otherwise(F.lit(True))).drop("_alone")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    guard: str | None = None,
    null_keys: str = "insert",
    unique: bool = False,
) -> DataFrame:
    """Update the listed columns of matched rows, insert the others whole.

    ``guard`` names a column that must not go backwards: a matched row whose source
    value is lower than the target's (or unknown) stays as it is.
    ``null_keys``: "insert" adds such source rows every time, "match" treats NULL as
    equal to NULL, "absent" promises there are none. One pass over either side serves
    all three: rows with a NULL key meet nothing and are spread over all tasks.
    """
    if null_keys not in ("insert", "match", "absent"):
        raise ValueError(f"unknown null_keys {null_keys!r}")
    columns = target.columns
    updated = set(update) | ({"updated_timestamp"} & set(columns))
    if not unique and null_keys != "match":
        source = require_unambiguous(source, keys, null_keys == "insert")
    elif not unique:
        source = require_unambiguous(source, keys, null_keys=False)
    t = target.withColumn("_in_target", F.lit(True))
    s = source.withColumn("_in_source", F.lit(True))
    same = [
        F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) if null_keys == "match" else F.col(f"t.{k}") == F.col(f"s.{k}")
        for k in keys
    ]
    if null_keys == "insert":
        # A row with a NULL key gets a place of its own, else all would hash to one partition.
        t = t.withColumn("_apart", F.when(_any_null(keys), F.rand(1)).otherwise(F.lit(0.0)))
        s = s.withColumn("_apart", F.when(_any_null(keys), F.rand(2) + 1).otherwise(F.lit(0.0)))
        same.append(F.col("t._apart") == F.col("s._apart"))
    t, s = t.alias("t"), s.alias("s")
    is_new = F.col("_in_target").isNull()
    replaces = F.col("_in_source").isNotNull()
    if guard is not None:
        replaces = replaces & F.coalesce(F.col(f"s.{guard}") >= F.col(f"t.{guard}"), F.lit(False))

    def merged(name: str) -> Column:
        old = F.col(f"t.{name}")
        new = F.col(f"s.{name}") if name in source.columns else F.lit(None)
        if name in keys:
            return F.coalesce(old, new).alias(name)
        taken = (is_new | replaces) if name in updated else is_new
        return F.when(taken, new).otherwise(old).alias(name)

    return t.join(s, reduce(lambda a, b: a & b, same), "full_outer").select(*[merged(c) for c in columns])


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Add the source rows whose key the target lacks (a link table has nothing to update)."""
    t = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    same = [
        F.col(k).eqNullSafe(F.col(f"_t_{k}")) if null_safe else F.col(k) == F.col(f"_t_{k}") for k in keys
    ]
    new = source.join(t, reduce(lambda a, b: a & b, same), "left_anti")
    return target.unionByName(new.select(*target.columns))


def update_matched(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    when: Column | None = None,
    unique: bool = False,
) -> DataFrame:
    """Change matched target rows for which ``when`` (over target columns) holds; insert nothing."""
    source = source if unique else require_unambiguous(source, keys)
    s = source.select(*keys, F.struct(*update).alias("_new"))
    hit = F.col("_new").isNotNull() if when is None else F.col("_new").isNotNull() & F.coalesce(when, F.lit(False))
    changed = {c: F.when(hit, F.col("_new")[c]).otherwise(F.col(c)) for c in update}
    return target.join(s, list(keys), "left").withColumns(changed).select(*target.columns)


def fold_batches(
    batches: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str],
    keep_first: Sequence[str] = (),
    null_keys: bool = True,
) -> DataFrame:
    """The table a guarded upsert of all batches in order would leave, in one pass.

    The row with the highest ``recency`` columns wins. Columns outside the update list
    (``keep_first``) hold the value of the first batch. Rows with a NULL key were all
    inserted, so all of them stay; ``null_keys=False`` promises there are none.
    """
    keyed = batches.filter(~_any_null(keys)) if null_keys else batches
    if keep_first:
        # First and last row of a key from the same partially aggregated shuffle.
        rest = [c for c in keyed.columns if c not in {*keys, *recency, *keep_first}]
        ends = keyed.groupBy(*keys).agg(
            F.max(F.struct(*recency, *rest)).alias("_last"),
            F.min(F.struct(*recency, *keep_first)).alias("_first"),
        )
        taken = {c: "_first" for c in keep_first} | {c: "_last" for c in [*recency, *rest]}
        latest = ends.select(
            *[F.col(f"{taken[c]}.{c}").alias(c) if c in taken else F.col(c) for c in batches.columns]
        )
    else:
        newest = [F.col(c).desc_nulls_last() for c in recency]
        latest = latest_per_key(keyed, keys, total_order(keyed, newest, skip=keys))
    return latest.unionByName(batches.filter(_any_null(keys))) if null_keys else latest


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at ``path`` under the given schema, or None before its first load."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


#: Partition values that may become a static filter; beyond them the filter is a join.
STATIC_PARTITIONS = 10_000


def upsert_table(
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    partition: str,
    guard: str | None = None,
    at: Column | None = None,
    null_keys: str = "insert",
    unique: bool = False,
) -> None:
    """Create a stored table from ``source`` or upsert into it, with audit columns.

    Only the partitions that the source names, or in which its keys stand by now, are read
    whole and rewritten (NULL is a partition like any other, and an empty text is stored as
    NULL), so a monthly batch does not rewrite the whole history; of the others only the key
    columns are read. Dynamic overwrite swaps them when the job commits. A row whose partition
    value changes moves; its old partition is rewritten without it. Should a run
    end between the two, the next one finds the key twice and keeps the row updated last.

    The source is one batch and used several times, so it is kept (memory, then disk) for
    the length of the call.
    """
    as_stored = F.when(F.col(partition).cast("string") != "", F.col(partition))
    source = with_audit(source.withColumn(partition, as_stored), at).persist()
    try:
        target = stored(source.sparkSession, path, source.schema)
        if target is None:
            checked = source if unique else require_unambiguous(source, keys)
            overwrite_partitions(checked.hint("rebalance", partition), path, partition)
            return
        present = source.select(F.col(partition).alias("value"), F.lit(False).alias("left"))
        if partition not in keys:
            mine = source.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(partition).alias("_to"))
            same = [target[k].eqNullSafe(F.col(f"_{k}")) if null_keys == "match" else target[k] == F.col(f"_{k}") for k in keys]
            met = target.join(mine, reduce(lambda a, b: a & b, same))
            present = present.union(met.select(partition, ~F.col(partition).eqNullSafe(F.col("_to"))))
        # Spark, not Python, names a value's folder: true is not True there.
        named_values = present.groupBy("value", F.col("value").cast("string").alias("name")).agg(F.max("left").alias("left"))
        values = named_values.limit(STATIC_PARTITIONS + 1).collect()
        touched = [r.value for r in values]
        if len(touched) <= STATIC_PARTITIONS:
            named = F.col(partition).isin([v for v in touched if v is not None])
            affected = target.filter(named | F.col(partition).isNull() if None in touched else named)
        else:
            some = present.select(F.col("value").alias("_some")).distinct()
            affected = target.join(some, target[partition].eqNullSafe(F.col("_some")), "left_semi")
        if partition not in keys:
            affected = _last_updated(affected, keys)
        changed = list(update) if partition in keys else [*update, partition]
        state = upsert(affected, source, keys, changed, guard, null_keys, unique)
        # With more partitions than are fetched, any of them may have lost its rows.
        few = len(touched) <= STATIC_PARTITIONS
        left = [r.name for r in values if r.left] if few else [r.name for r in named_values.filter("left").select("name").distinct().collect()]
        replace_partitions(state.hint("rebalance", partition), path, partition, left)
    finally:
        source.unpersist()


def _last_updated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the one updated last; rows with a NULL key all stay."""
    apart = F.when(_any_null(keys), F.rand(3))
    w = Window.partitionBy(*keys, apart).orderBy(F.col("updated_timestamp").desc_nulls_last(), *total_order(df, skip=keys))
    placed = df.withColumn("_place", F.row_number().over(w))
    return placed.filter((F.col("_place") == 1) | _any_null(keys)).drop("_place")


def overwrite_partitions(df: DataFrame, path: str, *partition: str) -> None:
    """Replace exactly the partitions ``df`` has rows for; they are swapped when the job commits."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition).parquet(path)


def _partition_folder(partition: str, name: str | None) -> str:
    """The folder of a partition value given as text, with the characters escaped that file systems reserve."""
    if name is None:
        return f"{partition}=__HIVE_DEFAULT_PARTITION__"
    escaped = "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "\"#%'*/:=?\\\x7f{[]^" else c for c in name)
    return f"{partition}={escaped}"


def replace_partitions(df: DataFrame, path: str, partition: str, left: Sequence[str | None]) -> None:
    """``overwrite_partitions``, and partitions in ``left`` (values as text) that ``df`` has no row for become empty.

    An overwrite leaves alone what it has no rows for. So these are written once more, as a
    file without rows, after the rows have reached their new place. ``left`` names the few
    partitions that rows have left.
    """
    if left:
        staying = {r[0] for r in df.select(F.col(partition).cast("string")).distinct().collect()}
        left = [v for v in left if v not in staying]
    bare = df.sparkSession.createDataFrame([], df.drop(partition).schema)
    overwrite_partitions(df, path, partition)
    for value in left:
        bare.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_partition_folder(partition, value)}")
