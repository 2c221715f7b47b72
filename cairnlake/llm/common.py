"""Helpers shared by the operators: column picking, written tables, folds, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairnlake.session import work_path


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names.

    Columns are found by position, so any further columns, also such that differ in case
    only or repeat a name, do no harm. The first column of a name counts.
    """
    found = {new: df.columns.index(old) for new, old in columns.items()}
    by_place = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return by_place.select(*[F.col(f"_c{i}").alias(new) for new, i in found.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared work folder: cuts the lineage and survives lost executors."""
    path = work_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """A written table, marked for broadcast only if it has at most ``rows`` (narrow) rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def fold(column: str, folds: int):
    """crc32 of a number's decimal text modulo ``folds``; NULL for NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def texts_of(rows: DataFrame, picked: DataFrame) -> DataFrame:
    """The rows (``id``, ``text``, ...) that ``picked`` names by ``h`` and ``k``, the hashes of id and text; one of each.

    picked: a sample whose size is bounded by a parameter, chosen without touching any text;
    texts travel only for what it holds.
    """
    keyed = rows.withColumns({"h": F.xxhash64("id"), "k": F.xxhash64("text")})
    return keyed.join(F.broadcast(picked.select("h", "k")), ["h", "k"]).dropDuplicates(["h", "k"])


def components(nodes: DataFrame, edges: DataFrame, label: str) -> DataFrame:
    """The smallest node id reachable from each node.

    nodes: ``node``; edges: ``a``, ``b`` (undirected, both among the nodes). Returns ``node``,
    ``component``. Every round takes the least label of all neighbours, then the label's own
    label (pointer jumping), so chains shrink geometrically. Minima combine before the shuffle
    and adaptive execution splits the join of a node with very many edges. Only a count of
    changes reaches the driver; each round's labels are a written table.
    """
    both = written(
        edges.filter("a != b").select("a", "b").unionByName(edges.filter("a != b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{label}-edges",
    )
    # Nodes without any edge keep their own id and take no part in the rounds.
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("component")), f"{label}-labels")
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        step = labels.join(near, labels.node == near.a, "left").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        up = labels.select(F.col("node").alias("up"), F.col("component").alias("up_component"))
        after = written(
            step.join(up, step.component == up.up, "left").select("node", "old", F.least("component", "up_component").alias("component")),
            f"{label}-labels",
        )
        labels = after.select("node", "component")
        if after.filter("component != old").isEmpty():
            break
    return nodes.join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
