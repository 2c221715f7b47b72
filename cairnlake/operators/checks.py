"""Reconciliation and integrity checks: each is one aggregated row, a report is their union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnlake.operators import dedup, joins, scd2


class ChecksFailed(Exception):
    """At least one check of a report did not hold."""


def _row(name: str, expected: Column, actual: Column, note: str) -> list[Column]:
    return [
        F.lit(name).alias("check"),
        expected.cast("string").alias("expected"),
        actual.cast("string").alias("actual"),
        F.lit(note).alias("note"),
    ]


def no_rows(name: str, offenders: DataFrame, note: str = "") -> DataFrame:
    """Passes when the frame of offending rows is empty."""
    return offenders.agg(F.count(F.lit(1)).alias("n")).select(*_row(name, F.lit(0), F.col("n"), note))


def same_total(name: str, actual: DataFrame, expected: DataFrame, measure: Column | None = None,
               expected_measure: Column | None = None, note: str = "") -> DataFrame:
    """Compare a sum (or the row count) of two tables in one aggregate over their union."""
    one = F.lit(1).cast("long")
    a = actual.select((one if measure is None else measure).alias("a"))
    e = expected.select((one if expected_measure is None else expected_measure).alias("e"))
    both = a.unionByName(e, allowMissingColumns=True)
    totals = both.agg(F.sum("a").alias("a"), F.sum("e").alias("e"))
    zero = F.lit(0)
    return totals.select(*_row(name, F.coalesce("e", zero), F.coalesce("a", zero), note))


def unique_key(name: str, df: DataFrame, key: str) -> DataFrame:
    return no_rows(name, dedup.duplicate_groups(df, [key]))


def one_current(name: str, versions: DataFrame, key: str) -> DataFrame:
    return no_rows(name, dedup.duplicate_groups(scd2.current_versions(versions), [key]))


def no_overlap(name: str, versions: DataFrame, key: str) -> DataFrame:
    return no_rows(name, scd2.overlapping_versions(versions, key))


def closed_have_end(name: str, versions: DataFrame) -> DataFrame:
    return no_rows(name, versions.filter("NOT is_current AND valid_to IS NULL"))


def current_have_none(name: str, versions: DataFrame) -> DataFrame:
    return no_rows(name, versions.filter("is_current AND valid_to IS NOT NULL"))


def no_orphans(name: str, df: DataFrame, column: str, table: DataFrame, table_key: str) -> DataFrame:
    """Counts referring rows, not distinct values, as a row-wise anti join would."""
    lost = joins.missing_references(df, column, table, table_key)
    return lost.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")).select(*_row(name, F.lit(0), F.col("n"), ""))


#: Roles of a counted value: it identifies a row of its own table, or it points at another table.
OWN = "own"


def counted_values(df: DataFrame, columns: Sequence[str], sums: Mapping[str, Column] = {}) -> DataFrame:
    """``field``, ``value``, ``n``: each value of each column as a count of one, for the caller's one aggregate to add up.

    The aggregate combines before its shuffle, so a value with a third of all rows travels once a task, and
    there is no shuffle before it. Each row also gives one with ``field`` NULL, which holds the named sums' terms.
    """
    nothing = lambda x: F.when(F.lit(False), F.col(x)).alias(x)
    one = F.lit(1).cast("long").alias("n")
    named = {f"_f{i}": F.col(c).cast("string") for i, c in enumerate(columns)}
    slim = df.select(*[c.alias(k) for k, c in (named | dict(sums)).items()])
    entries = [F.struct(F.lit(name).alias("field"), F.col(k).alias("value"), one, *[nothing(x) for x in sums]) for k, name in zip(named, columns)]
    whole = F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"), one, *[F.col(x).alias(x) for x in sums])
    return slim.select(F.inline(F.array(*entries, whole)))


def key_faults(
    tables: Mapping[str, DataFrame],
    own: Mapping[str, str],
    references: Sequence[tuple[str, str, str]],
    sums: Mapping[str, Mapping[str, Column]] = {},
) -> DataFrame:
    """All key checks over some tables in one pass: each table is read once.

    own: the key column of each table with one; references: (table, column, table pointed at); sums: named sums of a
    table. Returns one row: ``d{i}``, number of values of the i-th own key that occur twice or more; ``o{i}``, number of rows
    whose i-th reference finds no key; ``n_{table}``, rows of each table; each named sum under its name.

    Values of a key and of the columns that point at it meet in one group: one row a column, so
    groups are small however often a value occurs. NULL is a key value like any other for the
    first kind of count and refers to nothing in the second, as in the single checks.
    """
    target = lambda t: f"{t}.{own[t]}"
    parts = []
    for t, df in tables.items():
        points = [(i, c, to) for i, (at, c, to) in enumerate(references) if at == t]
        columns = list(dict.fromkeys([*([own[t]] if t in own else []), *[c for _, c, _ in points]]))
        roles = [F.when(F.col("field") == own[t], F.struct(F.lit(target(t)).alias("domain"), F.lit(OWN).alias("role")))] if t in own else []
        roles += [F.when((F.col("field") == c) & F.col("value").isNotNull(), F.struct(F.lit(target(to)).alias("domain"), F.lit(f"o{i}").alias("role"))) for i, c, to in points]
        roles.append(F.when(F.col("field").isNull(), F.struct(F.lit("rows").alias("domain"), F.lit(t).alias("role"))))
        rows = counted_values(df, columns, sums.get(t, {})).withColumn("at", F.explode(F.filter(F.array(*roles), lambda x: x.isNotNull())))
        parts.append(rows.select("at.domain", "value", "at.role", "n", *sums.get(t, {})))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    of = lambda role: F.sum(F.when(F.col("role") == role, F.col("n")))
    names = [name for some in sums.values() for name in some]
    met = every.groupBy("domain", "value").agg(
        of(OWN).alias("known"), *[of(f"o{i}").alias(f"o{i}") for i in range(len(references))],
        *[of(t).alias(f"n_{t}") for t in tables], *[F.sum(name).alias(name) for name in names],
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return met.agg(
        *[zero(F.sum(F.when((F.col("domain") == target(t)) & (F.col("known") > 1), 1))).alias(f"d{i}") for i, t in enumerate(own)],
        *[zero(F.sum(F.when(F.col("known").isNull(), F.col(f"o{i}")))).alias(f"o{i}") for i in range(len(references))],
        *[zero(F.sum(f"n_{t}")).alias(f"n_{t}") for t in tables], *[F.sum(name).alias(name) for name in names],
    )


def version_faults(versions: DataFrame, key: str) -> DataFrame:
    """All checks of a version table in one pass and one shuffle: a row with ``several_open``, ``overlapping``, ``closed_no_end``, ``open_with_end``.

    Versions that share a start are one period with the latest end, as in ``scd2.overlapping_versions``.
    """
    flag = lambda condition: F.sum(F.expr(f"CASE WHEN {condition} THEN 1 ELSE 0 END"))
    spans = versions.groupBy(key, "valid_from").agg(
        F.max(scd2.end_or_far_future()).alias("ends"), flag("is_current").alias("n_open"),
        flag("NOT is_current AND valid_to IS NULL").alias("no_end"), flag("is_current AND valid_to IS NOT NULL").alias("with_end"),
    )
    # Partitioned by key, which serves the window, the groups of keys and nothing else.
    ahead = spans.withColumn("next", F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from")))
    per_key = ahead.groupBy(key).agg(
        F.sum("n_open").alias("n_open"), flag("ends > next").alias("crossing"), F.sum("no_end").alias("no_end"), F.sum("with_end").alias("with_end")
    )
    return per_key.agg(
        F.coalesce(flag("n_open > 1"), F.lit(0)).alias("several_open"), *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("crossing", "overlapping"), ("no_end", "closed_no_end"), ("with_end", "open_with_end"))]
    )


def listed(faults: DataFrame, entries: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """The report's rows of a one-row table: (name, expected, actual) each."""
    rows = [F.struct(*_row(name, expected, actual, "")) for name, expected, actual in entries]
    return faults.select(F.inline(F.array(*rows)))


def report(checks: Sequence[DataFrame]) -> DataFrame:
    """One row per check with its verdict."""
    rows = reduce(DataFrame.unionByName, checks)
    verdict = F.when(F.col("actual") == F.col("expected"), "PASS").otherwise("FAIL")
    return rows.select("check", "expected", "actual", verdict.alias("status"), "note")


def require_passed(result: DataFrame) -> None:
    """Raise with the names of the failed checks (a report has one row per check)."""
    failed = [r["check"] for r in result.filter("status <> 'PASS'").select("check").collect()]
    if failed:
        raise ChecksFailed(f"{len(failed)} check(s) failed: {', '.join(failed)}")
