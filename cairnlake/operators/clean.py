"""Row-wise cleaning: whitespace, required keys, recodes, quality flags, audit counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T


# The characters that match "\s", as SQL string literals.
WHITESPACE = (" ", r"\t", r"\n", r"\u000B", r"\u000C", r"\r")


def tidy(name: str) -> Column:
    """The named text column with inner whitespace runs as one blank and outer ones gone.

    Most values (keys, codes) hold no whitespace at all; a plain byte search spares
    them the regular expression.
    """
    has_space = " OR ".join(f"contains(`{name}`, '{c}')" for c in WHITESPACE)
    return F.expr(rf"CASE WHEN {has_space} THEN trim(regexp_replace(`{name}`, '\\s+', ' ')) ELSE `{name}` END")


def trim_strings(df: DataFrame, collapse: bool = False, keep: Iterable[str] = ()) -> DataFrame:
    """Trim all string columns in one projection; other types pass unchanged."""
    untouched = set(keep)
    fix = tidy if collapse else F.trim
    return df.select(
        *[
            fix(f.name).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in untouched
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the rows in which every key column is present (plain conditions a scan can push down)."""
    return df.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))


def recode(code: Column, names: Mapping[str, str]) -> Column:
    """Replace known codes; anything else passes through."""
    out = None
    for old, new in names.items():
        out = F.when(code == old, new) if out is None else out.when(code == old, new)
    return code if out is None else out.otherwise(code)


def yes_no(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def missing_flag(name: str) -> Column:
    return yes_no(F.col(name).isNull())


def present_flag(name: str) -> Column:
    return yes_no(F.col(name).isNotNull())


def missing_or_not_positive_flag(name: str) -> Column:
    return yes_no(F.col(name).isNull() | (F.col(name) <= 0))


def missing_beside_key_flag(name: str, key: str) -> Column:
    return yes_no(F.col(key).isNotNull() & F.col(name).isNull())


def audit_counts(df: DataFrame, required: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Row counts before cleaning, with all required keys, and after key dedup, in one pass."""
    complete = reduce(and_, [F.col(name).isNotNull() for name in required])
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count(F.when(complete, 1)).alias("rows_with_keys"),
        F.count_distinct(F.when(complete, F.struct(*key))).alias("rows_deduplicated"),
    )


class AuditTrail:
    """Row counts of the steps of one load, taken by the job that runs it: no second pass, no further job."""

    def __init__(self) -> None:
        self._steps: dict[str, Observation] = {}

    def mark(self, df: DataFrame, step: str) -> DataFrame:
        """``df``, whose rows count as those of ``step`` when an action runs."""
        self._steps[step] = Observation(step)
        return df.observe(self._steps[step], F.count(F.lit(1)).alias("n_rows"))

    def counts(self) -> dict[str, int]:
        """Rows of every step; waits for the first action on the marked rows."""
        return {step: seen.get["n_rows"] for step, seen in self._steps.items()}
