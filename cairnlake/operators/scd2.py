"""Slowly changing history (type 2): step-wise merge, set-based history, backfill, integrity."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnlake.functions.keys import row_hash
from cairnlake.operators.merge import replace_partitions, require_unambiguous, stored

VERSION_COLUMNS = ("row_hash", "valid_from", "valid_to", "is_current")
# Fixed value: the end date a version without one is compared with.
FAR_FUTURE = "2999-12-31"


def batch_start(batch_id: str | Column = "batch_id") -> Column:
    """A monthly batch takes effect on its first day."""
    batch = F.col(batch_id) if isinstance(batch_id, str) else batch_id
    return F.to_date(F.concat(batch, F.lit("-01")))


def end_or_far_future(valid_to: str | Column = "valid_to") -> Column:
    return F.coalesce(valid_to, F.to_date(F.lit(FAR_FUTURE)))


def open_versions(df: DataFrame, tracked: Sequence[str], valid_from: Column) -> DataFrame:
    """Give every row its hash and an open validity period."""
    return df.withColumns(
        {
            "row_hash": row_hash(tracked),
            "valid_from": valid_from,
            "valid_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def backfill(df: DataFrame, tracked: Sequence[str], valid_from: str) -> DataFrame:
    """Turn a type 1 table into first versions that start on one fixed day."""
    return open_versions(df, tracked, F.to_date(F.lit(valid_from)))


def history(batches: DataFrame, key: str, tracked: Sequence[str], effective_from: Column | None = None) -> DataFrame:
    """All versions from all batches at once (one source row per key and batch).

    One shuffle and one sort by key and effective date serve every step: a row opens
    a version when its hash differs from the row before, and the last row of a run
    carries the run's untracked values. A key has at most one row per batch, so the
    number of batches bounds what one window group can hold.
    """
    start = batch_start() if effective_from is None else effective_from
    rows = batches.withColumn("row_hash", row_hash(tracked)).withColumn("_effective", start)
    w = Window.partitionBy(key).orderBy("_effective")
    opens = F.lag("row_hash").over(w)
    following_hash = F.lead("row_hash").over(w)
    return (
        rows.withColumn("_opened", F.when(opens.isNull() | (opens != F.col("row_hash")), F.col("_effective")))
        .withColumn("valid_from", F.last("_opened", ignorenulls=True).over(w))
        .withColumn("_next_hash", following_hash)
        .withColumn("_next_effective", F.lead("_effective").over(w))
        .filter(F.col("_next_hash").isNull() | (F.col("_next_hash") != F.col("row_hash")))
        .withColumn("valid_to", F.col("_next_effective"))
        .withColumn("is_current", F.col("_next_effective").isNull())
        .drop("_effective", "_opened", "_next_hash", "_next_effective")
        .select(*batches.columns, *VERSION_COLUMNS)
    )


def merge_versions(
    target: DataFrame, source: DataFrame, key: str, tracked: Sequence[str], effective_from: Column | None = None
) -> DataFrame:
    """Apply one batch (one row per key) to a table of versions.

    New key: first version. Same hash: untracked columns are overwritten in place.
    Other hash: the open version is closed and a new one opened. A source row that
    takes effect before the open version started is ignored; one that takes effect on
    the same day (a batch delivered again) replaces that version, and if it brings back
    the values of the version before, that one is open again. Other closed versions
    and keys the batch does not mention stay as they are.
    """
    return touched_versions(target, source, key, tracked, effective_from).select(*target.columns)


def touched_versions(
    target: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective_from: Column | None = None,
    delivered: Sequence[date] = (),
) -> DataFrame:
    """The given versions after one batch. Versions closed on another day than the batch's may be left out.

    A key met twice in the source fails the job. ``delivered`` lists the days for which the source is
    the whole delivery: an open version that began on one of them, and whose key the source lacks,
    came from an earlier delivery of the same batch. It is withdrawn, and the version before it is
    open again.
    """
    start = batch_start() if effective_from is None else effective_from
    payload = [c for c in source.columns if c != key]
    src = open_versions(require_unambiguous(source.filter(F.col(key).isNotNull()), [key]), tracked, start)
    s = src.select(key, F.struct(*payload, *VERSION_COLUMNS).alias("_new"))
    both = target.select(key, F.struct(*payload, *VERSION_COLUMNS).alias("_old")).join(s, key, "full_outer")

    # All versions of a key meet, of which there is one per batch at most.
    old, new, of_key = F.col("_old"), F.col("_new"), Window.partitionBy(key)
    both = both.withColumn("_open", F.max(F.when(old["is_current"], old["valid_from"])).over(of_key))
    late, again = new["valid_from"] < F.col("_open"), new["valid_from"] == F.col("_open")
    # The version before the open one, where the batch's values are its values.
    returns = again & ~old["is_current"] & (old["valid_to"] == F.col("_open")) & (old["row_hash"] == new["row_hash"])
    both = both.withColumn("_returns", F.coalesce(returns, F.lit(False)))
    both = both.withColumn("_returned", F.max("_returns").over(of_key))

    def version(row: Column, since: Column, until: Column, is_current: bool) -> Column:
        return F.struct(
            *[row[c].alias(c) for c in payload],
            row["row_hash"].alias("row_hash"),
            since.alias("valid_from"),
            until.alias("valid_to"),
            F.lit(is_current).alias("is_current"),
        )

    in_place = version(new, old["valid_from"], F.lit(None).cast("date"), True)
    reopened = version(old, old["valid_from"], F.lit(None).cast("date"), True)
    nothing = F.array().cast(f"array<{both.schema['_old'].dataType.simpleString()}>")
    withdrawn = new.isNull() & F.coalesce(F.col("_open").isin(*delivered), F.lit(False)) if delivered else F.lit(False)
    outcome = (
        F.when(old.isNull(), F.array(new))
        .when(withdrawn & old["is_current"], nothing)
        .when(withdrawn & (old["valid_to"] == F.col("_open")), F.array(reopened))
        .when(new.isNull() | late, F.array(old))
        .when(F.col("_returns"), F.array(in_place))
        .when(~old["is_current"], F.array(old))
        .when(F.col("_returned"), nothing)
        .when((new["row_hash"] == old["row_hash"]) | again, F.array(in_place))
        .otherwise(F.array(version(old, old["valid_from"], new["valid_from"], False), new))
    )
    return both.select(key, F.explode(outcome).alias("_row")).select(key, "_row.*")


def store_history(versions: DataFrame, path: str) -> None:
    """Write a version table partitioned by end date; open versions share the NULL partition."""
    versions.hint("rebalance", "valid_to").write.partitionBy("valid_to").parquet(path)


def merge_stored(
    path: str, source: DataFrame, key: str, tracked: Sequence[str], effective_from: Column | None = None, whole: bool = False
) -> None:
    """Apply one batch to a stored version table.

    Only the open versions and those closed on a day the batch takes effect on are read. One
    dynamic overwrite replaces these partitions, so a batch costs as much as the current
    customers, not as their history; a batch delivered again, changed or not, leaves the
    versions that applying only its last delivery would have left (untracked values that the earlier delivery overwrote in a version of an earlier
    batch are not brought back). The effective days are few: one for each month a delivery holds. Rows without
    key are not versioned. ``whole``: the source is all of its batch, so a key it lacks is withdrawn.
    """
    start = batch_start() if effective_from is None else effective_from
    source = source.filter(F.col(key).isNotNull())
    target = stored(source.sparkSession, path, open_versions(source, tracked, start).schema)
    if target is None:
        store_history(open_versions(require_unambiguous(source, [key], null_keys=False), tracked, start), path)
        return
    days = [r[0] for r in source.select(start.alias("day")).distinct().collect() if r[0] is not None]
    affected = target.filter(F.col("valid_to").isNull() | F.col("valid_to").isin(days))
    state = touched_versions(affected, source, key, tracked, effective_from, days if whole else ())
    # Only a repeated delivery finds versions closed on its day, and may open the last of them again.
    closed = [r[0] for r in affected.filter("valid_to IS NOT NULL").select(F.col("valid_to").cast("string")).distinct().collect()]
    replace_partitions(state.hint("rebalance", "valid_to"), path, "valid_to", closed)


def current_versions(versions: DataFrame) -> DataFrame:
    return versions.filter("is_current")


def overlapping_versions(versions: DataFrame, key: str) -> DataFrame:
    """Periods that end after a later version of the same key has begun.

    Versions that share a start date are one period with the latest end. Looking at
    the next start then finds an overlap whenever a pairwise self join would, without
    pairing all versions of a key.
    """
    spans = versions.groupBy(key, "valid_from").agg(F.max(end_or_far_future()).alias("ends"))
    by_start = Window.partitionBy(key).orderBy("valid_from")
    return spans.withColumn("next_valid_from", F.lead("valid_from").over(by_start)).filter(
        F.col("ends") > F.col("next_valid_from")
    )


def profile(versions: DataFrame, key: str) -> DataFrame:
    """Totals of a version table in one row."""
    return versions.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(key).alias("n_keys"),
        F.count_if(F.col("is_current")).alias("current_versions"),
        F.count_if(~F.col("is_current")).alias("closed_versions"),
        F.count_distinct("row_hash").alias("distinct_hashes"),
    )
