"""Near-duplicates by a multi-index Hamming join over minhash signatures, confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cairnlake.llm.common import components, pick, small_side, table, written
from cairnlake.llm.markov_model import word_hash
from cairnlake.llm.words import slices, split_words

SHINGLE = 5
#: Link from 100 * intersection >= PERCENT * union on.
PERCENT = 75
#: A signature is so many symbols of 16 bits; its distance is the number of different symbols.
SYMBOLS, CHUNKS = 80, 16
#: Pairs up to this distance share a chunk with at most one different symbol: CHUNKS chunks with
#: two each would make 2 * CHUNKS. A pair at the threshold is farther with probability 0.0015.
FARTHEST = 2 * CHUNKS - 1
#: Members of a bucket that are compared in one go.
BLOCK = 1024

_RNG = np.random.default_rng(20)
_A = _RNG.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 4096


def shingle_sets(texts: list[str | None] | pa.Array) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; a text of fewer words is one shingle."""
    words, codes, sizes = split_words(texts)
    hashes = np.array([word_hash(w) for w in words], np.int64).view(np.uint64)[codes] if words else np.empty(0, np.uint64)
    n = max(0, len(hashes) - SHINGLE + 1)
    total = np.full(n, SHINGLE, np.uint64)
    for k in range(SHINGLE):
        total = (total ^ hashes[k : k + n]) * _PRIME
        total ^= total >> np.uint64(31)
    out, at = [], 0
    for size in sizes.tolist():
        if size >= SHINGLE:
            out.append(np.unique(total[at : at + size - SHINGLE + 1]))
        elif size:
            h = np.uint64(size)
            with np.errstate(over="ignore"):
                for w in hashes[at : at + size]:
                    h = (h ^ w) * _PRIME
                    h ^= h >> np.uint64(31)
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        at += size
    return out


def set_key(shingles: np.ndarray) -> int:
    """64 bits that stand for the whole set."""
    return word_hash(shingles.tobytes())


def signature(shingles: np.ndarray) -> bytes:
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _SLICE):
        some = shingles[at : at + _SLICE]
        np.minimum(least, ((some ^ _B[:, None]) * _A[:, None]).min(1), out=least)
    return ((least * _PRIME) >> np.uint64(48)).astype("<u2").tobytes()


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of each signature: for every chunk and every symbol of it that may differ, the others."""
    keys = []
    for c, chunk in enumerate(np.array_split(np.arange(SYMBOLS), CHUNKS)):
        for left_out in chunk:
            h = np.full(len(signatures), c * 100 + int(left_out), np.uint64) * _PRIME
            for s in chunk:
                if s != left_out:
                    h = (h ^ signatures[:, s].astype(np.uint64)) * _PRIME
                    h ^= h >> np.uint64(31)
            keys.append(h)
    return np.stack(keys, axis=1).view(np.int64)


def describe(df: DataFrame) -> DataFrame:
    """df: ``id``, ``text``. Adds ``node`` (its set, NULL if empty), ``n_shingles``, ``sig``; text becomes ``text_key``."""
    kind = df.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            sets = shingle_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([signature(s) if len(s) else None for s in sets], pa.binary())],
                names=["id", "text_key", "node", "n_shingles", "sig"],
            )

    keyed = df.select("id", "text", F.xxhash64("text").alias("text_key"))
    return keyed.mapInArrow(run, f"id {kind}, text_key long, node long, n_shingles long, sig binary")


def bucket_keys(classes: DataFrame) -> DataFrame:
    """``key``, ``node`` for all keys of all classes, with ``component`` where the classes have it."""
    labels = [c for c in ("node", "component") if c in classes.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u2").reshape(batch.num_rows, SYMBOLS)
            keys = chunk_keys(sigs)
            repeated = [pa.array(np.repeat(batch.column(c).to_numpy(), keys.shape[1])) for c in labels]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *repeated], names=["key", *labels])

    return classes.select(*labels, "sig").mapInArrow(run, ", ".join(["key long", *(f"{c} long" for c in labels)]))


def distances(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``a``, ``b``, ``distance`` of the pairs that are near enough by signature and by size.

    Sizes whose ratio rules a link out need no look at the signatures.
    """
    side = lambda x: classes.select(F.col("node").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, SYMBOLS) for c in ("sig_a", "sig_b"))
            d = (a != b).sum(1)
            near = pa.array(np.flatnonzero(d <= FARTHEST))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(near), batch.column("b").take(near), pa.array(d.astype(np.int32)).take(near)], names=["a", "b", "distance"])

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, distance int")


_CELL = "key long, i int, j int, block int, node long, component long, n_shingles long, sig binary"


def _cells(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[list[tuple]]:
    """The rows of each cell; they come sorted by ``key``, ``i``, ``j``, which lead the columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if held and row[:3] != held[0][:3]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


_COLUMNS = ("key", "i", "j", "block", "node", "component", "n_shingles", "sig")


def near_in_cell(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the near pairs of different components between a cell's two blocks, nearest first.

    A pair may meet in many buckets; it counts only in that of the first key both have.
    """
    key, i, j = rows[0][:3]
    left = np.array([r[3] == i for r in rows])
    node, component, size = (np.array([r[k] for r in rows]) for k in (4, 5, 6))
    sigs = np.frombuffer(b"".join(r[7] for r in rows), "<u2").reshape(-1, SYMBOLS)
    keys = chunk_keys(sigs)
    a, b = np.flatnonzero(left), np.flatnonzero(left if i == j else ~left)
    found = []
    for at in range(0, len(a), 64):
        some = a[at : at + 64]
        may = component[some, None] != component[b]
        may &= 100 * np.minimum(size[some, None], size[b]) >= PERCENT * np.maximum(size[some, None], size[b])
        if i == j:
            may &= node[some, None] < node[b]
        x, y = np.nonzero(may)
        for lo in range(0, len(x), 50_000):
            xs, ys = some[x[lo : lo + 50_000]], b[y[lo : lo + 50_000]]
            d = (sigs[xs] != sigs[ys]).sum(1)
            near = d <= FARTHEST
            xs, ys, d = xs[near], ys[near], d[near]
            first = np.argmax(keys[xs] == keys[ys], axis=1)
            here = keys[xs, first] == key
            found.append(np.stack((xs[here], ys[here], d[here])))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    xs, ys, d = np.concatenate(found, axis=1)
    order = np.argsort(d, kind="stable")
    return xs[order], ys[order]


def cells_of(members: DataFrame) -> DataFrame:
    """Each member (``key``, ``node``, ``component``, ``size``, ``main``, ``n_main``, ...) once for every cell it is compared in.

    ``size`` members of a bucket, ``n_main`` of them in its largest component ``main``, are cut into
    blocks of about BLOCK; a cell (``i``, ``j``) with i <= j gets blocks i and j. If there are several
    blocks, the first ones are those of the main component, whose members are not compared with each
    other: they meet the blocks of the others only. So a member is copied once for every
    block of other components, not of its bucket.
    """
    placed = members.withColumns({
        "mains": F.when(F.col("size") <= BLOCK, 0).otherwise(F.ceil(F.col("n_main") / BLOCK)).cast("int"),
        "others": F.when(F.col("size") <= BLOCK, 1).otherwise(F.greatest(F.lit(1), F.ceil((F.col("size") - F.col("n_main")) / BLOCK))).cast("int"),
        "h": F.xxhash64("node"),
    })
    placed = placed.withColumn("in_main", F.expr("mains > 0 and component = main"))
    placed = placed.withColumn("block", F.expr("cast(if(in_main, pmod(h, mains), mains + pmod(h, others)) as int)"))
    cells = F.expr("transform(sequence(if(in_main, mains, 0), mains + others - 1), k -> struct(least(block, k) as i, greatest(block, k) as j))")
    return placed.withColumn("cell", F.explode(cells)).withColumns({"i": F.col("cell.i"), "j": F.col("cell.j")})


def attached(rows: DataFrame, side: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``side``, by ``node``.

    They are joined once a node, whose rows (one a bucket or cell) go through the join as a list.
    """
    listed = rows.groupBy("node").agg(F.collect_list(F.struct(*[c for c in rows.columns if c != "node"])).alias("listed"))
    joined = side.join(listed, "node").withColumn("row", F.explode("listed"))
    return joined.select(*side.columns, "row.*")


def crossing_links(members: DataFrame, df: DataFrame, classes: DataFrame) -> DataFrame:
    """``a``, ``b``: links that join different components of a bucket, as many as it takes.

    members: ``key``, ``node``, ``component``; of their buckets ``size``, ``main``, ``n_main``. A bucket is
    cut into blocks of members (see cells_of); a task compares two blocks, so no task ever holds a
    bucket. A first pass finds the
    members with a near partner, by signature; a second one, with their full sets, tests
    near pairs from the nearest on and leaves out those it has joined by then. So no list of
    pairs ever leaves a task: of a cell come at most as many links as it has components.
    """
    described = cells_of(attached(members, classes.select("node", "n_shingles", "sig"))).select(*_COLUMNS)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches, _COLUMNS):
            used = np.unique(np.concatenate(near_in_cell(rows)))
            if len(used):
                kept = list(zip(*(rows[k] for k in used)))
                types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(kept, types)], names=list(_COLUMNS))

    in_order = lambda x: x.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    used = written(in_order(described).mapInArrow(search, _CELL), "minhash-cells")
    wanted = written(classes.join(used.select("node").distinct(), "node", "left_semi").select("node", "id", "text_key"), "minhash-wanted")
    full = attached(used, sets_of(df, wanted))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches, (*_COLUMNS, "shingles")):
            sets = [np.frombuffer(r[8], np.uint64) for r in rows]
            up = {r[5]: r[5] for r in rows}

            def root(c: int) -> int:
                while up[c] != c:
                    up[c] = c = up[up[c]]
                return c

            links = []
            for x, y in zip(*(k.tolist() for k in near_in_cell(rows))):
                p, q = root(rows[x][5]), root(rows[y][5])
                if p != q and sets_link(sets[x], sets[y]):
                    up[max(p, q)] = min(p, q)
                    links.append((rows[x][4], rows[y][4]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])

    return in_order(full.select(*_COLUMNS, "shingles")).mapInArrow(test, "a long, b long")


def sets_link(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def sets_of(df: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node``, ``shingles`` of the wanted classes, from one row of each.

    df: ``id``, ``text``; wanted: ``node``, ``id``, ``text_key`` of the row that stands for the class.
    """
    texts = df.select("id", "text", F.xxhash64("text").alias("text_key"))
    wanted = wanted.select(F.col("id").alias("wanted_id"), F.col("text_key").alias("wanted_key"), "node")
    on = texts.id.eqNullSafe(F.col("wanted_id")) & (texts.text_key == F.col("wanted_key"))
    chosen = texts.join(small_side(wanted), on).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            sets = shingle_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"])

    return chosen.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, df: DataFrame, classes: DataFrame, label: str) -> DataFrame:
    """The pairs (written: ``a``, ``b``) whose full sets link."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = written(classes.join(ends, "node", "left_semi").select("node", "id", "text_key"), f"{label}-wanted")
    sets = written(sets_of(df, wanted), f"{label}-sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for k, (x, y) in enumerate(zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())):
                if sets_link(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)):
                    good.append(k)
            good = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(good), batch.column("b").take(good)], names=["a", "b"])

    side = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"))
    return written(pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long"), f"{label}-links")


def ranked(pairs: DataFrame) -> DataFrame:
    """Adds ``place``: 1 for the pair of least distance of each ``a``, which has as many pairs as keys at most."""
    return pairs.withColumn("place", F.row_number().over(Window.partitionBy("a").orderBy("distance", "b")))


def crossing(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` whose ends are in different components."""
    end = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"component_{x}"))
    return pairs.join(end("a"), "a").join(end("b"), "b").filter("component_a != component_b").select("a", "b")


def groups(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id``, ``text_key``, ``n_shingles`` and ``component``, the group's number (NULL: links with nothing), of every row.

    Groups of documents whose sets of 5-word shingles link, directly or by others.

    Equal sets form one class first, whatever their number. Every class has SYMBOLS minhash symbols in
    CHUNKS chunks; by the pigeonhole principle any two classes up to FARTHEST symbols apart share a
    chunk but for one symbol, so leaving out each symbol in turn makes all of them meet in a bucket.

    A bucket's members are first held against its least member, one pair each, which settles
    groups of copies without all their pairs: the nearest pair of each class, then the others
    that still cross components. So all pairs with a least member are settled. Only buckets whose other
    members are then in different components compare these, in blocks, on full sets (see
    crossing_links), so no near pair of different components stays untested and no list of all pairs is ever made.
    """
    df = pick(df, id=id_column, text=text_column)
    rows = written(describe(df), "minhash-rows")
    classes = rows.filter("node is not null").groupBy("node").agg(F.min(F.struct("id", "text_key", "n_shingles", "sig")).alias("row"))
    classes = written(classes.select("node", "row.*"), "minhash-classes")

    keys = bucket_keys(classes)
    buckets = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("hub")).filter("size > 1")
    members = written(keys.join(buckets, "key"), "minhash-members")
    # Near copies share most of their buckets, so there are far fewer of these pairs than members.
    pairs = written(members.filter("node != hub").select("node", "hub").distinct(), "minhash-pairs")
    stars = pairs.select(F.col("node").alias("a"), F.col("hub").alias("b"))
    stars = written(ranked(distances(stars, classes)), "minhash-stars")
    links = confirmed(stars.filter("place = 1"), df, classes, "minhash-stars")

    nodes = written(members.select("node").distinct(), "minhash-nodes")
    labels = written(components(nodes, links, "minhash"), "minhash-components")
    others = written(crossing(stars.filter("place > 1"), labels), "minhash-others")
    if not others.isEmpty():
        links = links.unionByName(confirmed(others, df, classes, "minhash-others"))
        labels = written(components(nodes, links, "minhash"), "minhash-components")
    # A bucket is open if its members but the hub are in different components. Classes take their component
    # along into their keys, so the buckets are judged by an aggregate, without a join of members.
    labelled = written(bucket_keys(classes.select("node", "sig").join(labels, "node")), "minhash-labelled")
    parts = labelled.groupBy("key", "component").agg(F.count("*").alias("n"), F.min("node").alias("first"))
    sizes = parts.groupBy("key").agg(
        (F.sum("n") - 1).alias("size"), F.count("*").alias("parts"), F.min(F.struct("first", "n")).alias("hub"), F.max(F.struct("n", "component")).alias("largest")
    ).filter("parts - if(hub.n = 1, 1, 0) > 1")
    open_buckets = sizes.select(F.col("key").alias("open_key"), "size", F.col("hub.first").alias("hub"), F.col("largest.component").alias("main"), F.col("largest.n").alias("n_main"))
    open_buckets = written(open_buckets, "minhash-open-buckets")
    still = labelled.join(open_buckets, F.col("key") == F.col("open_key")).filter("node != hub").select("key", "node", "component", "size", "main", "n_main")
    still = written(still, "minhash-open")
    if not still.isEmpty():
        links = links.unionByName(written(crossing_links(still, df, classes), "minhash-crossing"))
        labels = written(components(nodes, links, "minhash"), "minhash-components")

    grouped = rows.select("id", "text_key", "node", "n_shingles").join(labels, "node", "left")
    return grouped.select("id", "text_key", "n_shingles", F.coalesce("component", "node").alias("component"))


def near_duplicates(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Groups of near-duplicates (see groups) by the least id of each.

    Returns one row per input row: the id, ``text_key`` (hash of the text), ``n_shingles``, ``component_id``
    (the least id of the group) and ``kept``. A NULL, empty or blank text has an empty set and links with
    nothing; a row whose id is NULL takes part, but lends no name to its group and is kept; repeated
    rows are in one group and have equal results; an empty table gives an empty result; further
    columns are ignored.
    """
    grouped = groups(df, id_column, text_column)
    names = grouped.filter("component is not null").groupBy("component").agg(F.min("id").alias("name"))
    named = grouped.join(names, "component", "left").withColumn("component_id", F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("name")))
    return named.select(
        F.col("id").alias(id_column), "text_key", "n_shingles", "component_id",
        F.when(F.col("id").isNull(), F.lit(True)).otherwise(F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )


def one_of_each_group(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``df`` with one document of each group of near-duplicates; all its columns stay.

    A group's document is that of its least id, or if all are NULL or the id repeats, of these the
    one with the least text hash. Texts that are not linked stay, also under the same id.
    Repeated rows (equal id and text, also if NULL) are reduced to one of them.
    """
    found = written(groups(df, id_column, text_column), "minhash-found")
    order = F.struct(F.col("id").isNull().alias("nameless"), "id", "text_key")
    chosen = found.filter("component is not null").groupBy("component").agg(F.min(order).alias("chosen"))
    judged = found.join(chosen, "component", "left").withColumn("kept", F.col("component").isNull() | (F.col("id").eqNullSafe(F.col("chosen.id")) & (F.col("text_key") == F.col("chosen.text_key"))))
    judged = written(judged.select("id", "text_key", "kept"), "minhash-judged")
    named = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    at, text_at = (f"_c{df.columns.index(c)}" for c in (id_column, text_column))
    dropped = written(judged.filter("not kept").select(F.col("id").alias("gone"), F.col("text_key").alias("gone_key")).distinct(), "minhash-dropped")
    named = named.withColumn("text_key", F.xxhash64(text_at))
    out = named.join(small_side(dropped), named[at].eqNullSafe(F.col("gone")) & (F.col("text_key") == F.col("gone_key")), "left_anti")
    repeated = judged.filter("kept").groupBy("id", "text_key").count().filter("count > 1")
    if not repeated.isEmpty():
        out = out.dropDuplicates([at, "text_key"])
    return out.drop("text_key").toDF(*df.columns)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text").drop("text_key")


# Each text's shingles, all pairs with a common shingle, and the least id reachable.
OP4_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least_id AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN least_id c ON s.doc_id = c.x
"""
