"""Surrogate keys, change hashes and date keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

UNKNOWN_SK = -1


def surrogate_key(*business_key: str | Column) -> Column:
    """64-bit key that depends only on the business key, so a rebuild keeps it."""
    parts = [F.col(k) if isinstance(k, str) else k for k in business_key]
    text = parts[0].cast("string") if len(parts) == 1 else F.concat_ws("||", *parts)
    return F.xxhash64(text)


def row_hash(tracked: Sequence[str]) -> Column:
    """SHA-256 over the tracked columns as text; NULL is told apart from an empty string."""
    texts = (F.coalesce(F.col(name).cast("string"), F.lit("~NULL~")) for name in tracked)
    return F.sha2(F.concat_ws("||", *texts), 256)


def date_id(day: str | Column) -> Column:
    """``yyyyMMdd`` text key of the calendar; NULL stays NULL."""
    return F.date_format(day, "yyyyMMdd")
