"""Near-duplicate vectors: NN-descent finds the neighbour graph, components settle saturated lists."""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cairnlake.llm.common import components, pick, table, written
from cairnlake.llm.markov_model import word_hash

LEAST_COSINE = 0.9
#: Entries of a neighbour list; random trees to start from, and the size of their leaves.
NEIGHBOURS, TREES, LEAF = 10, 4, 256
#: Rounds of neighbours-of-neighbours joins; less if fewer than this share of entries change.
ROUNDS, SETTLED = 3, 0.01
#: Chance that a pair at the threshold shares no leaf in which components are compared.
MISSED = 0.005
#: Vectors whose links are counted against all others to audit recall: at first, and at most; of them, those with
#: links that are wanted. The recall asked for, and retries.
AUDITED, MOST_AUDITED, AUDITED_LINKED, LEAST_RECALL, RETRIES = 200, 12_800, 200, 0.99, 4
#: Members of a component that are compared in one go.
BLOCK = 1024
#: Leaves in which linked components are looked for hold so many times LEAF; larger ones are compared in blocks.
CROSSING_LEAVES = 8
#: Error that single precision may have at the threshold.
MARGIN = 1e-4
#: Two vectors this near to a third are linked to each other, as their angles add up to the threshold's.
CORE_COSINE = sqrt((1 + LEAST_COSINE) / 2) + 1e-9


def unit_vectors(rows: DataFrame) -> DataFrame:
    """``id``, ``node``, ``dim``, ``unit``: equal vectors share a node; unusable ones have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, dims, units = [], [], []
            for v in batch.column("vector").to_pylist():
                unit = None
                if v and None not in v:
                    x = np.array(v, np.float64)
                    largest = np.abs(x).max()
                    if np.isfinite(largest) and largest > 0:
                        # Scaled first, so that squares neither overflow nor vanish.
                        x = x / largest
                        unit = x / np.sqrt(x @ x)
                nodes.append(None if unit is None else word_hash(unit.tobytes()))
                dims.append(None if unit is None else len(unit))
                units.append(None if unit is None else unit.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(nodes, pa.int64()), pa.array(dims, pa.int32()), pa.array(units, pa.binary())], names=["id", "node", "dim", "unit"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, node long, dim int, unit binary")


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    cells = column.to_pylist()
    return np.frombuffer(b"".join(cells), kind).reshape(len(cells), -1)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, put together over batch borders."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            now = tuple(c[a] for c in columns)
            if now != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


_EDGE = "a long, b long, cosine float"


def _edges(a: list, b: list, c: list) -> pa.RecordBatch:
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
    return pa.RecordBatch.from_arrays([pa.array(join(a, np.int64)), pa.array(join(b, np.int64)), pa.array(join(c, np.float32))], names=["a", "b", "cosine"])


def leaf_bits(count: int, leaf: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1, count / leaf)))))


def trees_for(bits: int) -> int:
    """Trees of so many bits until a pair at the threshold shares a leaf but for a chance of MISSED.

    A random plane parts two vectors with probability angle / pi, whatever the other vectors are.
    """
    together = (1 - acos(LEAST_COSINE) / pi) ** bits
    return 1 if bits == 0 else ceil(log(MISSED) / log(1 - together))


def leaves(classes: DataFrame, bits: int, trees: int, seed: int) -> DataFrame:
    """``tree``, ``leaf``, ``node``, ``small`` (the unit vector in single precision) of every class and tree.

    A leaf is the sign pattern of ``bits`` random projections.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                chosen = pa.array(np.flatnonzero(dims == dim))
                nodes = batch.column("node").take(chosen)
                x = _matrix(batch.column("unit").take(chosen), "<f8")
                small = pa.array([row.tobytes() for row in x.astype("<f4")], pa.binary())
                for tree in range(trees):
                    planes = np.random.default_rng((seed, tree, int(dim))).normal(size=(int(dim), bits))
                    leaf = ((x @ planes > 0) * (1 << np.arange(bits))).sum(1) + (int(dim) << 40) if bits else np.full(len(x), int(dim) << 40)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), tree, np.int32)), pa.array(leaf.astype(np.int64)), nodes, small], names=["tree", "leaf", "node", "small"])

    return classes.select("node", "dim", "unit").mapInArrow(run, "tree int, leaf long, node long, small binary")


def first_graph(classes: DataFrame, count: int, seed: int) -> DataFrame:
    """Each class's nearest ones within its leaves; a large leaf is dealt into blocks by hash."""
    placed = leaves(classes, leaf_bits(count, LEAF), TREES, seed)
    sizes = placed.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / (2 * LEAF)).alias("blocks"))
    cells = placed.join(sizes, ["tree", "leaf"]).withColumn("block", F.pmod(F.xxhash64("node", "tree"), F.col("blocks")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _runs(batches, ["tree", "leaf", "block"]):
            if cell.num_rows < 2:
                continue
            nodes = cell.column("node").to_numpy()
            x = _matrix(cell.column("small").combine_chunks(), "<f4")
            a, b, c = [], [], []
            k = min(NEIGHBOURS, len(nodes) - 1)
            for at in range(0, len(nodes), BLOCK):
                s = x[at : at + BLOCK] @ x.T
                s[np.arange(len(s)), at + np.arange(len(s))] = -2
                best = np.argpartition(-s, k - 1, axis=1)[:, :k]
                a.append(np.repeat(nodes[at : at + BLOCK], k))
                b.append(nodes[best].ravel())
                c.append(np.take_along_axis(s, best, 1).ravel())
            yield _edges(a, b, c)

    found = cells.select("tree", "leaf", "block", "node", "small").repartition("tree", "leaf", "block").sortWithinPartitions("tree", "leaf", "block").mapInArrow(run, _EDGE)
    return nearest(found)


def nearest(edges: DataFrame) -> DataFrame:
    """The best NEIGHBOURS entries of each list."""
    by = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    once = edges.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    return once.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= NEIGHBOURS).drop("place")


def refine(graph: DataFrame, classes: DataFrame) -> DataFrame:
    """One round: at each class its neighbours, those it is a neighbour of, and itself meet.

    The meeting holds at most 2 * NEIGHBOURS + 1, as of those that list a class only its nearest
    come. A pair is reported if it would enter one of both lists.
    """
    by = Window.partitionBy("b").orderBy(F.desc("cosine"), "a")
    reverse = graph.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= NEIGHBOURS)
    meet = (
        graph.select(F.col("a").alias("at"), F.col("b").alias("node"))
        .union(reverse.select(F.col("b").alias("at"), F.col("a").alias("node")))
        .union(graph.select(F.col("a").alias("at"), F.col("a").alias("node")))
        .distinct()
    )
    lists = graph.groupBy("a").agg(F.min("cosine").alias("worst"), F.count("*").alias("n")).select(F.col("a").alias("node"), F.when(F.col("n") < NEIGHBOURS, F.lit(-2.0)).otherwise(F.col("worst")).cast("float").alias("worst"))
    members = meet.join(classes.select("node", "unit").join(lists, "node"), "node")

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _runs(batches, ["at"]):
            if cell.num_rows < 2:
                continue
            nodes, worst = cell.column("node").to_numpy(), cell.column("worst").to_numpy()
            x = _matrix(cell.column("small").combine_chunks(), "<f4")
            s = x @ x.T
            s[np.arange(len(s)), np.arange(len(s))] = -3
            i, j = np.nonzero(s > worst[:, None] + 1e-6)
            if len(i):
                yield _edges([nodes[i]], [nodes[j]], [s[i, j]])

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(u, "<f8").astype("<f4").tobytes() for u in batch.column("unit").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("node"), batch.column("worst"), pa.array(rows, pa.binary())], names=["at", "node", "worst", "small"])

    sent = members.select("at", "node", "worst", "unit").mapInArrow(small, "at long, node long, worst float, small binary")
    return sent.repartition("at").sortWithinPartitions("at").mapInArrow(narrow, _EDGE)


def _spanning(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of those pairs that join what earlier ones have not."""
    up: dict[int, int] = {}

    def root(c: int) -> int:
        while up.setdefault(c, c) != c:
            up[c] = c = up[up[c]]
        return c

    out = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        p, q = root(x), root(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append(k)
    return out


def crossing_edges(classes: DataFrame, labels: DataFrame, count: int, seed: int) -> DataFrame:
    """Pairs above the threshold whose classes are in different components, though lists are full without them.

    labels: ``node``, ``component``. In each leaf that holds several components all pairs of different
    ones are compared, in blocks if the leaf is large, so no list limits what is found. The number of
    trees grows with that of the leaves (see trees_for). Pairs surely
    above the threshold are reduced in the task to those that join components, at most one less
    than its components; such within MARGIN of it are all reported, for exact_edges to decide.
    """
    bits = leaf_bits(count, CROSSING_LEAVES * LEAF)
    placed = leaves(classes, bits, trees_for(bits), seed).join(labels, "node")
    sizes = placed.groupBy("tree", "leaf").agg(
        F.ceil(F.count("*") / (2 * CROSSING_LEAVES * LEAF)).cast("int").alias("blocks"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    cells = placed.join(sizes.filter("low != high").drop("low", "high"), ["tree", "leaf"]).withColumn("block", F.pmod(F.xxhash64("node", "tree"), F.col("blocks")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    keys = ["tree", "leaf", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _runs(batches, keys):
            nodes, component, block = (cell.column(c).to_numpy() for c in ("node", "component", "block"))
            x = _matrix(cell.column("small").combine_chunks(), "<f4")
            # Sorted by block: the first one against the second, or one block with itself.
            n = int((block == block[0]).sum())
            start = n if cell.column("i")[0].as_py() != cell.column("j")[0].as_py() else 0
            a, b, c = [], [], []
            for at in range(0, n, BLOCK):
                s = x[at : min(n, at + BLOCK)] @ x[start:].T
                i, j = np.nonzero(s >= LEAST_COSINE - MARGIN)
                c.append(s[i, j])
                i, j = i + at, j + start
                other = component[i] != component[j]
                other &= (start > 0) | (i < j)
                i, j, c[-1] = i[other], j[other], c[-1][other]
                # One sure pair of any two components will do.
                sure = np.flatnonzero(c[-1] >= LEAST_COSINE + MARGIN)
                _, first = np.unique(np.stack((component[i[sure]], component[j[sure]])), axis=1, return_index=True)
                chosen = np.concatenate((sure[first], np.flatnonzero(c[-1] < LEAST_COSINE + MARGIN)))
                a.append(i[chosen])
                b.append(j[chosen])
                c[-1] = c[-1][chosen]
            a, b, c = (np.concatenate(v) for v in (a, b, c))
            sure = np.flatnonzero(c >= LEAST_COSINE + MARGIN)
            sure = sure[_spanning(component[a[sure]], component[b[sure]])]
            chosen = np.concatenate((sure, np.flatnonzero(c < LEAST_COSINE + MARGIN)))
            if len(chosen):
                yield _edges([nodes[a[chosen]]], [nodes[b[chosen]]], [c[chosen]])

    sent = cells.select(*keys, "block", "node", "component", "small")
    return sent.repartition(*keys).sortWithinPartitions(*keys, "block").mapInArrow(run, _EDGE)


def count_links(members: DataFrame) -> DataFrame:
    """``node``, ``links``: the copies of all other classes of the component that each is linked with.

    members: ``component``, ``node``, ``copies``, ``unit``. Members near the component's pivot (its
    least class) form a core in which all are linked, so only the others are compared, each
    with all members, in blocks. No pair leaves a task, only sums by class.
    """
    pivots = members.filter("node = component").select("component", F.col("unit").alias("pivot"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core = (_matrix(batch.column("unit"), "<u1").view("<f8") * _matrix(batch.column("pivot"), "<u1").view("<f8")).sum(1) >= CORE_COSINE if batch.num_rows else np.empty(0, bool)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("component", "node", "copies", "unit")), pa.array(core)], names=["component", "node", "copies", "unit", "core"])

    marked = written(members.join(pivots, "component").select("component", "node", "copies", "unit", "pivot").mapInArrow(near, "component long, node long, copies long, unit binary, core boolean"), "vector-members")
    sizes = marked.groupBy("component").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.ceil(F.count(F.when(~F.col("core"), 1)) / BLOCK).cast("int").alias("shells"),
        F.coalesce(F.sum(F.when(F.col("core"), F.col("copies"))), F.lit(0)).alias("core_copies"),
    )
    placed = marked.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    inside = placed.select("node", F.when(F.col("core"), F.col("core_copies") - F.col("copies")).otherwise(F.lit(0)).alias("links"))
    columns = ["component", "i", "j", "side", "node", "copies", "core", "unit"]
    left = placed.filter("not core").withColumn("i", F.pmod(F.xxhash64("node", F.lit(1)), F.col("shells")).cast("int"))
    left = left.withColumn("j", F.explode(F.expr("sequence(0, blocks - 1)"))).withColumn("side", F.lit(0)).select(*columns)
    right = placed.filter("shells > 0").withColumn("i", F.explode(F.expr("sequence(0, shells - 1)"))).withColumn("j", F.col("block")).withColumn("side", F.lit(1)).select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _runs(batches, ["component", "i", "j"]):
            side = cell.column("side").to_numpy()
            n = int((side == 0).sum())  # sorted: the left block first
            if n in (0, len(side)):
                continue
            nodes, copies = cell.column("node").to_numpy(), cell.column("copies").to_numpy()
            core = cell.column("core").to_numpy()[n:]
            x = _matrix(cell.column("unit").combine_chunks(), "<f8")
            linked = (x[:n] @ x[n:].T >= LEAST_COSINE) & (nodes[:n, None] != nodes[None, n:])
            found = np.concatenate((linked @ copies[n:], np.where(core, copies[:n] @ linked, 0)))
            some = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(found[some].astype(np.int64))], names=["node", "links"])

    cells = left.unionByName(right).repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "side")
    return inside.unionByName(cells.mapInArrow(run, "node long, links long")).groupBy("node").agg(F.sum("links").alias("links"))


def audit(classes: DataFrame, links: DataFrame, seed: int) -> float:
    """Mean share of its linked copies that a class with links has found, by a full comparison of a sample.

    The sample (smallest hashes) grows fourfold from AUDITED until AUDITED_LINKED of its classes have
    links, or it is the whole table, or MOST_AUDITED. Each class counts alike, however many
    copies it or its links have. 1.0 if no class of the sample has links.
    """
    order = F.xxhash64("node", F.lit(seed))
    size = AUDITED
    while True:
        some = classes.orderBy(order).limit(size).select("node", "dim", "unit").toArrow()
        true = true_links(classes, some)
        linked, recall = true.filter(F.col("true") > 0).join(links, "node", "left").agg(F.count("*"), F.avg(F.least(F.lit(1.0), F.coalesce("links", F.lit(0)) / F.col("true")))).first()
        if linked >= AUDITED_LINKED or some.num_rows < size or size >= MOST_AUDITED:
            return 1.0 if recall is None else recall
        size *= 4


def true_links(classes: DataFrame, some: pa.Table) -> DataFrame:
    """``node``, ``true``: copies of all classes that each of some (``node``, ``dim``, ``unit``) is linked with."""
    queries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    dims = some.column("dim").to_numpy()
    for dim in np.unique(dims):
        chosen = some.filter(pa.array(dims == dim))
        queries[int(dim)] = chosen.column("node").to_numpy(), _matrix(chosen.column("unit").combine_chunks(), "<f8")
    sent = classes.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        total = {dim: np.zeros(len(nodes), np.int64) for dim, (nodes, _) in queries.items()}
        for batch in batches:
            all_dims = batch.column("dim").to_numpy()
            for dim, (nodes, x) in queries.items():
                chosen = np.flatnonzero(all_dims == dim)
                for at in range(0, len(chosen), BLOCK):
                    part = pa.array(chosen[at : at + BLOCK])
                    y, others, copies = _matrix(batch.column("unit").take(part), "<f8"), batch.column("node").take(part).to_numpy(), batch.column("copies").take(part).to_numpy()
                    i, j = np.nonzero(x @ y.T >= LEAST_COSINE)
                    apart = nodes[i] != others[j]
                    np.add.at(total[dim], i[apart], copies[j[apart]])
        for dim, (nodes, _) in queries.items():
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(total[dim])], names=["node", "links"])

    return classes.select("node", "dim", "unit", "copies").mapInArrow(run, "node long, links long").groupBy("node").agg(F.sum("links").alias("true"))


def vector_links(df: DataFrame, id_column: str, vector_column: str, seed: int = 3) -> DataFrame:
    """Links of all vectors by cosine >= LEAST_COSINE in double precision.

    Equal directions form one class with their number. Neighbour lists start from the leaves of
    random trees and are refined by neighbours-of-neighbours joins until few entries change. Entries
    above the threshold connect classes to components. A list all of whose entries are above it
    is saturated and may miss links to other components, so components are held against each
    other in leaves, without lists (see crossing_edges), and links are counted in the joined ones
    exactly, in blocks (see count_links). A sample's recall is audited against all
    vectors; if it falls short, more trees and rounds are added to the graph, and if it still
    does after RETRIES, the result is refused by a RuntimeError.

    Returns one row per input row: the id, ``n_links``, ``component_id`` (least id reachable) and ``kept``.
    NULL, empty and zero vectors and such with NULL or non-finite components link with nothing;
    vectors of other lengths do not link either; a row whose id is NULL takes part and is kept,
    but lends no name; repeated rows link with each other; an empty table gives an empty
    result; further columns are ignored.
    """
    rows = written(unit_vectors(pick(df, id=id_column, vector=vector_column)), "vector-rows")
    classes = rows.filter("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.max("dim").alias("dim"), F.max("unit").alias("unit"))
    classes = written(classes, "vector-classes")
    count = classes.count()
    graph = crossed = None
    nodes = classes.select("node")
    for attempt in range(RETRIES + 1):
        started = first_graph(classes, count, seed + attempt)
        graph = written(started if graph is None else nearest(graph.unionByName(started)), "vector-graph")
        for _ in range(ROUNDS):
            before = graph
            graph = written(nearest(graph.unionByName(refine(graph, classes))), "vector-graph")
            changed = graph.join(before, ["a", "b"], "left_anti").count()
            if changed <= SETTLED * max(1, graph.count()):
                break
        edges = written(exact_edges(graph, classes), "vector-edges")
        edges = edges if crossed is None else edges.unionByName(crossed)
        labels = written(components(nodes, edges, "vector"), "vector-components")
        found = written(exact_edges(crossing_edges(classes, labels, count, seed + attempt), classes), "vector-crossing")
        if not found.isEmpty():
            crossed = found if crossed is None else crossed.unionByName(found)
            labels = written(components(nodes, edges.unionByName(found), "vector"), "vector-components")
        sized = labels.groupBy("component").count().filter("count > 1").select("component")
        members = labels.join(sized, "component").join(classes.select("node", "copies", "unit"), "node")
        links = written(count_links(members), "vector-links")
        recall = audit(classes, links, seed)
        if recall >= LEAST_RECALL:
            break
    else:
        raise RuntimeError(f"links of audited vectors are found to {recall:.4f} only")
    per_class = classes.select("node", "copies").join(links, "node", "left").join(labels, "node").select("node", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    found = rows.select("id", "node").join(per_class, "node", "left")
    names = found.filter("component is not null").groupBy("component").agg(F.min("id").alias("name"))
    named = found.join(names, "component", "left")
    component_id = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("name"))
    return named.select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"),
        F.when(F.col("id").isNull(), F.lit(True)).otherwise(F.col("id").eqNullSafe(component_id)).alias("kept"),
    )


def exact_edges(graph: DataFrame, classes: DataFrame) -> DataFrame:
    """Entries of the graph that are links in double precision."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("unit").alias(f"unit_{x}"))
    near = graph.filter(F.col("cosine") >= LEAST_COSINE - MARGIN).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = ([np.frombuffer(u, "<f8") for u in batch.column(c).to_pylist()] for c in ("unit_a", "unit_b"))
            chosen = pa.array([k for k, (p, q) in enumerate(zip(x, y)) if len(p) == len(q) and p @ q >= LEAST_COSINE], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(chosen), batch.column("b").take(chosen)], names=["a", "b"])

    return near.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def op10_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


OP10_SQL = """
WITH RECURSIVE doubles AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
  SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM doubles
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), nonzero AS (SELECT vec_id, list_transform(v, lambda x: x / norm) AS u FROM usable WHERE norm > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM nonzero a JOIN nonzero b ON a.vec_id <> b.vec_id AND len(a.u) = len(b.u)
  WHERE list_inner_product(a.u, b.u) >= 0.9
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least_id AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT c.x AS vec_id, coalesce(d.n, 0) AS n_links, c.component_id, c.x = c.component_id AS kept
FROM least_id c LEFT JOIN degree d ON c.x = d.x
"""
