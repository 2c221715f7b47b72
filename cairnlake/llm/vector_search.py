"""Exact top-k by inner product: columnar branch-and-bound over integer vectors.

Candidates lie in shards, dimension by dimension. A query adds up its scores one block of dimensions
at a time, its heaviest block first, and drops every candidate whose score so far plus the most
that the remaining blocks can give (product of the norms, block by block) stays below its k-th best.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cairnlake.llm.common import pick, table, written

K, SCALE = 10, 1024
#: Dimensions that are added up at a time; candidates that are searched at a time.
DIMENSIONS, SLICE = 8, 8192
#: A shard has at most so many candidates and bytes, and not fewer candidates than LEAST unless it is the only one.
SHARD, SHARD_BYTES, LEAST = 65_536, 32 << 20, 2048
#: Components beyond it would let a score leave a long.
LARGEST = 1 << 26

_NONE = np.iinfo(np.int64).max


def floors(column: pa.Array, scale: int) -> list[bytes | None]:
    """floor(scale * x) of each vector as little-endian 32-bit numbers; None for a vector that takes no part."""
    flat = column.flatten()
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, np.int64)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    if len(sizes) and (flat.null_count or not valid.all() or (sizes != sizes[0]).any()):
        return [_floor(v, scale) for v in column.to_pylist()]
    if not len(sizes):
        return []
    x = np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), -1) * scale)
    with np.errstate(invalid="ignore"):
        good = (np.abs(x) < LARGEST).all(axis=1)
    codes = np.where(good[:, None], x, 0).astype("<i4")
    return [row.tobytes() if g else None for row, g in zip(codes, good)]


def _floor(v: list | None, scale: int) -> bytes | None:
    if v is None or None in v:
        return None
    x = np.floor(np.array(v, np.float64) * scale)
    with np.errstate(invalid="ignore"):
        return x.astype("<i4").tobytes() if (np.abs(x) < LARGEST).all() else None


def integer_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """``id``, ``dim``, ``codes`` of the vectors that take part.

    Rows that repeat id and vector within a batch go on once, so a hot one is small before any shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = dict.fromkeys((i, c) for i, c in zip(batch.column("id").to_pylist(), floors(batch.column("vector"), scale)) if c is not None)
            ids, codes = [i for i, _ in kept], [c for _, c in kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(c) >> 2 for c in codes], pa.int32()), pa.array(codes, pa.binary())], names=["id", "dim", "codes"]
            )

    sized = rows.select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    return sized.mapInArrow(run, "id long, dim int, codes binary")


class Shard:
    """Candidates in vertical layout: one row a dimension, and each one's norm within every block."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray):
        # Smaller ids come first, so that of equal scores the first ones win; NULL ids are last.
        order = np.argsort(ids, kind="stable")
        self.ids, columns = ids[order], np.ascontiguousarray(codes[order].T)
        self.largest = int(np.abs(columns).max()) if columns.size else 0
        self.blocks = [slice(a, a + DIMENSIONS) for a in range(0, len(columns), DIMENSIONS)]
        self.norms = np.array([np.sqrt((columns[b].astype(np.float64) ** 2).sum(axis=0)) for b in self.blocks]).reshape(len(self.blocks), len(ids))
        # Sums within a block are whole numbers that single precision holds, unless components are large.
        exact = np.float32 if DIMENSIONS * self.largest**2 < 1 << 23 else np.float64 if DIMENSIONS * self.largest**2 < 1 << 52 else np.int64
        self.columns = columns.astype(exact)

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the query's k best here (all, if fewer), its own id left out."""
        norms = np.array([np.sqrt((query[b].astype(np.float64) ** 2).sum()) for b in self.blocks])
        order = np.argsort(-norms, kind="stable")
        largest = max(self.largest, int(np.abs(query).max()) if len(query) else 0)
        # The query may be larger than what the shard's own kind of number is exact for.
        kind = self.columns.dtype if DIMENSIONS * largest**2 < 1 << 23 else np.dtype(np.float64) if DIMENSIONS * largest**2 < 1 << 52 else np.dtype(np.int64)
        q = query.astype(kind)
        found_ids, found = np.empty(0, np.int64), np.empty(0, np.int64)
        least = None
        for a in range(0, len(self.ids), SLICE):
            ids, columns, rests = (x[..., a : a + SLICE] for x in (self.ids, self.columns, self.norms))
            alive = np.flatnonzero(ids != query_id)
            score = np.zeros(len(alive), np.int64)
            for step, b in enumerate(order):
                block = columns[self.blocks[b]]
                # Survivors are copied together as soon as one candidate is gone.
                block = block if len(alive) == len(ids) else block[:, alive]
                score += (q[self.blocks[b]] @ block.astype(kind, copy=False)).astype(np.int64)
                rest = order[step + 1 :]
                if least is not None and len(rest):
                    most = norms[rest] @ rests[rest][:, alive]
                    kept = score + most * (1 + 1e-12) + 1e-3 >= least
                    if not kept.all():
                        alive, score = alive[kept], score[kept]
            found_ids, found = np.concatenate((found_ids, ids[alive])), np.concatenate((found, score))
            first = np.argsort(-found, kind="stable")[:k]
            found_ids, found = found_ids[first], found[first]
            if len(found) == k:
                least = int(found[-1])
        return found_ids, found


def top_k(
    df: DataFrame, id_column: str, vector_column: str, queries: int = 100, k: int = K, scale: int = SCALE, shard: int = SHARD
) -> DataFrame:
    """The k candidates of highest integer inner product for each row whose id is divisible by ``queries``.

    A component x counts as floor(scale * x). Candidates are all rows of the query's dimension under
    another id. Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; of equal scores the smaller
    id comes first. A vector that is NULL or holds NULL, non-finite or out-sized components (2^26 and
    more after scaling: scores might not fit a long) takes no part. Rows that repeat id and vector count once;
    other vectors under one id are queries and candidates of their own, none of them for each other.
    A NULL id is no query, as a candidate it comes after all others. An empty table gives an empty result;
    further columns are ignored.

    Candidates move once, to a shard by the hash of id and vector, so no id or vector can fill one.
    Queries are copied to each shard and stream past it. A task holds one shard; every
    shard passes on k rows a query, and these meet once more.
    """
    vectors = written(integer_vectors(pick(df, id=id_column, vector=vector_column), scale), "search-vectors")
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")).first()
    n = size.n or 0
    most = max(1, min(shard, SHARD_BYTES // (4 * max(1, size.dim or 1))))
    wide = df.sparkSession.sparkContext.defaultParallelism
    shards = max(1, ceil(n / max(min(most, LEAST), min(most, ceil(n / wide)))))
    placed = vectors.select(
        F.pmod(F.xxhash64("id", "codes"), F.lit(shards)).cast("int").alias("shard"), "dim", F.lit(False).alias("asks"), "id", "codes"
    )
    asking = vectors.filter(F.col("id") % queries == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "dim", F.lit(True).alias("asks"), "id", "codes"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, index, last = None, [], None, None
        for batch in batches:
            numbers = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "dim", "asks")]
            change = np.zeros(batch.num_rows, bool)
            for c in numbers:
                change[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(change), batch.num_rows] if batch.num_rows else [0]
            out = []
            for a, b in zip(starts, starts[1:]):
                now = (int(numbers[0][a]), int(numbers[1][a]))
                if now != key:
                    key, held, index, last = now, [], None, None
                ids, codes = batch.column("id").slice(a, b - a), batch.column("codes").slice(a, b - a)
                if not numbers[2][a]:
                    held.append((ids, codes))
                    continue
                if index is None:
                    index = _shard(held, key[1])
                    held = []
                for i, c in zip(ids.to_pylist(), codes.to_pylist()):
                    if (i, c) != last:  # a query that repeats
                        last = i, c
                        out.append((i, c, *index.best(i, np.frombuffer(c, "<i4"), k)))
            yield _found(out)

    cells = placed.unionByName(asking).repartition(shards, "shard").sortWithinPartitions("shard", "dim", "asks", "id", "codes")
    found = cells.mapInArrow(run, "query_id long, codes binary, vec_id long, score long")
    best = Window.partitionBy("query_id", "codes").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _shard(held: list[tuple[pa.Array, pa.Array]], dim: int) -> Shard:
    """The shard of all held rows, repeats of id and vector once; they come sorted by both."""
    ids = np.concatenate([i.fill_null(_NONE).to_numpy(zero_copy_only=False) for i, _ in held]) if held else np.empty(0, np.int64)
    codes = np.frombuffer(b"".join(x for _, c in held for x in c.to_pylist()), "<i4").reshape(len(ids), dim)
    again = np.zeros(len(ids), bool)
    again[1:] = (ids[1:] == ids[:-1]) & (codes[1:] == codes[:-1]).all(axis=1)
    return Shard(ids[~again], codes[~again])


def _found(out: list[tuple]) -> pa.RecordBatch:
    counts = [len(ids) for _, _, ids, _ in out]
    ids = np.concatenate([x for _, _, x, _ in out]) if out else np.empty(0, np.int64)
    scores = np.concatenate([x for _, _, _, x in out]) if out else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.array([i for i, *_ in out], np.int64), counts)),
            pa.array([c for (_, c, *_), n in zip(out, counts) for _ in range(n)], pa.binary()),
            pa.array(ids, pa.int64(), mask=ids == _NONE),
            pa.array(scores, pa.int64()),
        ],
        names=["query_id", "codes", "vec_id", "score"],
    )


def op12_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


OP12_SQL = """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS codes
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.codes, c.codes) AS BIGINT) AS score
        FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id IS DISTINCT FROM c.vec_id)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored QUALIFY rank <= 10"""
