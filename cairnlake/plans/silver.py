"""Bronze to silver: one recipe, driven by the feed declarations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from cairnlake.operators import clean, dedup, merge, scd2
from cairnlake.sources.feeds import FEEDS, LINEAGE, Feed


def _recency(df: DataFrame) -> list[str]:
    """Later batch, then later load time, then (customers) later created date wins."""
    return [c for c in ("batch_id", "_loaded_at", "customer_created_date") if c in df.columns]


def _renamed(df: DataFrame, feed: Feed) -> DataFrame:
    """Rename, tidy, cast and recode in a single projection."""
    out = []
    for f in df.schema.fields:
        if f.name in feed.drop and f.name != "_loaded_at":
            continue
        name = feed.rename.get(f.name, f.name)
        value = F.col(f.name)
        if feed.tidy_text and isinstance(f.dataType, T.StringType) and f.name not in LINEAGE:
            value = clean.tidy(f.name)
        if name in feed.recodes:
            value = clean.recode(value, feed.recodes[name])
        if name in feed.title_case:
            value = F.initcap(value)
        if name in feed.casts:
            value = value.cast(feed.casts[name])
        out.append(value.alias(name))
    return df.select(*out)


def _flagged(df: DataFrame, feed: Feed) -> DataFrame:
    return df.withColumns({name: make() for name, make in feed.flags.items()}) if feed.flags else df


def prepared(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Conformed rows before deduplication.

    Required keys are tested under their delivered names, where the scan can apply
    the test; no cleaning step turns a present value into NULL.
    """
    if feed.required:
        delivered = {new: old for old, new in feed.rename.items()}
        bronze = clean.require_keys(bronze, [delivered.get(k, k) for k in feed.required])
    df = _renamed(bronze, feed)
    return df.withColumns({name: make() for name, make in feed.derive.items()}) if feed.derive else df


def conform(bronze: DataFrame, feed: Feed | str, trail: clean.AuditTrail | None = None) -> DataFrame:
    """Silver state of all given batches: one row per business key, the latest batch winning.

    On a single batch this is the source of the upsert; on the whole bronze table it
    is what loading every batch in order would have left. ``trail`` gets the rows delivered, with
    their required keys, and kept; the scan then sees all rows, as they have to be counted.
    """
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    df = _audited(bronze, feed, trail)
    latest = merge.fold_batches(
        df, feed.key, _recency(df), feed.keep_first, null_keys=not set(feed.key) <= set(feed.required)
    )
    if feed.repeat_flag:
        # Twins are looked for inside one batch, so the flag does not depend on how many are loaded at once, and
        # among all delivered rows; only rows that are kept are marked, and no query that ignores the flag pays for it.
        latest = dedup.flag_repeated(
            latest, [*feed.repeat_group, "batch_id"], feed.key[0], feed.repeat_flag, present="product_sku", among=df
        )
    kept = _flagged(latest.drop("_loaded_at"), feed)
    return kept if trail is None else trail.mark(kept, "kept")


def _audited(bronze: DataFrame, feed: Feed, trail: clean.AuditTrail | None) -> DataFrame:
    if trail is None:
        return prepared(bronze, feed)
    return trail.mark(prepared(trail.mark(bronze, "delivered"), feed), "with_keys")


def customer_batches(bronze: DataFrame, feed: Feed | str = "cust_master", trail: clean.AuditTrail | None = None) -> DataFrame:
    """One row per customer and batch: the latest created date, then payment terms, wins. ``trail``: see ``conform``."""
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    df = _audited(bronze, feed, trail).dropna(subset=list(feed.key))
    order = [F.col("customer_created_date").desc(), F.col("customer_payment_terms").asc()]
    keys = [*feed.key, "batch_id"]
    latest = dedup.latest_per_key(df, keys, dedup.total_order(df, order, skip=keys))
    return latest if trail is None else trail.mark(latest, "kept")


def customer_history(bronze: DataFrame) -> DataFrame:
    """All customer versions from all batches."""
    feed = FEEDS["cust_master"]
    return scd2.history(customer_batches(bronze, feed), feed.key[0], feed.tracked)


def load_batch(target: DataFrame | None, batch: DataFrame, feed: Feed | str) -> DataFrame:
    """New silver state after one batch; without a target the batch is the first load."""
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    if feed.tracked:
        rows = customer_batches(batch, feed)
        if target is None:
            return scd2.open_versions(rows, feed.tracked, scd2.batch_start())
        return scd2.merge_versions(target, rows, feed.key[0], feed.tracked)
    source = merge.with_audit(conform(batch, feed))
    if target is None:
        return source
    # Keys in the required list were checked above, so no row can lack one.
    null_keys = "absent" if set(feed.key) <= set(feed.required) else "insert"
    return merge.upsert(
        target, source, feed.key, feed.update_columns(source.columns), "batch_id", null_keys, unique=True
    )


def silver(bronze: DataFrame, name: str) -> DataFrame:
    """Silver table ``name`` from its whole bronze table."""
    return customer_history(bronze) if FEEDS[name].tracked else conform(bronze, name)
