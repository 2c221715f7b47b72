"""Vector code compression: integer codebooks trained over Hilbert-sorted flat blocks.

The parts of all vectors are laid out along a Hilbert curve and cut into flat blocks that store a
box (least and greatest value of each component), sums and the values component by component. In every
round the distances of the boxes to the codebook's entries leave each block a shortlist. A block with one
entry left is assigned by its stored sums; the others go through a small exact integer kernel.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cairnlake.llm.common import pick, small_side, table, written
from cairnlake.llm.vector_search import floors

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Parts of vectors in a block, and at most so many bytes.
BLOCK, BLOCK_BYTES = 256, 16_384
#: Bits of a component on the curve, and of a whole curve position.
BITS, CURVE_BITS = 7, 62


def curve_position(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point on the Hilbert curve. cells: dimensions x points, whole numbers below 2^bits.

    Coordinates are first turned into the curve's own frame, from the coarsest bit to the finest; then
    their bits are Gray-decoded and interleaved.
    """
    x = cells.astype(np.int64)
    zero = np.int64(0)
    for bit in reversed(range(1, bits)):
        q, below = np.int64(1) << bit, (np.int64(1) << bit) - 1
        for axis in range(len(x)):
            flips = (x[axis] & q) != 0
            swap = np.where(flips, zero, (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(flips, below, swap)
            x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for bit in reversed(range(1, bits)):
        turn ^= np.where(x[-1] & (np.int64(1) << bit), (np.int64(1) << bit) - 1, zero)
    x ^= turn
    place = np.zeros(x.shape[1], np.int64)
    for bit in reversed(range(bits)):
        for axis in range(len(x)):
            place = (place << 1) | ((x[axis] >> bit) & 1)
    return place


def kept_rows(rows: DataFrame, scale: int) -> DataFrame:
    """``row`` (unique), ``id``, ``label``, ``dim``, ``codes``, ``low``, ``high`` of every usable vector, as a written table."""
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = floors(batch.column("vector"), scale)
            used = pa.array([c is not None and len(c) > 0 for c in codes])
            values = [np.frombuffer(c, "<i4") for c in codes if c]
            ends = [[f(v) for v in values] for f in (np.min, np.max)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").filter(used), batch.column("label").filter(used), pa.array([len(v) for v in values], pa.int32()),
                    pa.array([c for c in codes if c], pa.binary()), *(pa.array(e, pa.int32()) for e in ends),
                ],
                names=["id", "label", "dim", "codes", "low", "high"],
            )

    sized = rows.select(F.col("id").cast("long").alias("id"), "label", F.col("vector").cast("array<double>").alias("vector"))
    kept = sized.mapInArrow(run, f"id long, label {label}, dim int, codes binary, low int, high int")
    return written(kept.withColumn("row", F.monotonically_increasing_id()), "codes-rows")


def flat_blocks(kept: DataFrame, dim: int, parts: int, low: int, high: int) -> DataFrame:
    """The parts of all vectors of one dimension along the curve, in blocks, as a written table.

    ``row`` ends the sort key, so that equal parts can be dealt to several tasks.
    """
    size = dim // parts
    axes = min(size, CURVE_BITS)
    bits = max(1, min(BITS, CURVE_BITS // axes))
    per_block = max(16, min(BLOCK, BLOCK_BYTES // (4 * size + 8)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), "<i4").reshape(batch.num_rows, parts, size)
            cells = ((codes[:, :, :axes].astype(np.int64) - low) << bits) // max(1, high - low + 1)
            cells = np.clip(cells, 0, (1 << bits) - 1)
            for part in range(parts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(curve_position(cells[:, part].T, bits)), batch.column("row"),
                        pa.array([v.tobytes() for v in codes[:, part]], pa.binary()),
                    ],
                    names=["part", "place", "row", "value"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, rows = (batch.column(c).to_numpy() for c in ("part", "row"))
            values = np.frombuffer(b"".join(batch.column("value").to_pylist()), "<i4").reshape(batch.num_rows, size)
            borders = [0, *(np.flatnonzero(np.diff(owner)) + 1), batch.num_rows] if batch.num_rows else [0]
            out = []
            for a, b in zip(borders, borders[1:]):
                for at in range(a, b, per_block):
                    v = values[at : min(at + per_block, b)]
                    box = v.min(axis=0), v.max(axis=0), v.sum(axis=0, dtype="<i8")
                    out.append((int(owner[at]), len(v), rows[at : at + len(v)].astype("<i8").tobytes(), np.ascontiguousarray(v.T).tobytes(), *(x.tobytes() for x in box)))
            columns = list(zip(*out)) or [()] * 7
            kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "n", "rows", "columns", "low", "high", "sums"])

    placed = kept.filter(F.col("dim") == dim).select("row", "codes").mapInArrow(cut, "part int, place long, row long, value binary")
    order = ["part", "place", "row"]
    sorted_parts = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(sorted_parts.mapInArrow(pack, "part int, n int, rows binary, columns binary, low binary, high binary, sums binary"), "codes-blocks")


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """blocks x entries: whether an entry may be the nearest of some point in the block's box.

    An entry is out if another one is nearer even in the box's worst corner, or if the entry with the
    least such bound is nearer than it (or as near, with a lower index) all over the box.
    """
    below, above = low[:, None, :] - entries, entries - high[:, None, :]
    nearest = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
    farthest = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
    best = farthest.argmin(axis=1)
    able = nearest <= farthest.min(axis=1)[:, None]
    # distance to best less distance to another one is linear in the point, so it is greatest in a corner.
    squares = (entries**2).sum(axis=1)
    slope = 2 * (entries[None] - entries[best][:, None])
    gain = squares[best][:, None] - squares[None] + np.maximum(slope * low[:, None, :], slope * high[:, None, :]).sum(axis=2)
    index = np.arange(len(entries))
    return able & ~((gain < 0) | ((gain == 0) & (index[None] > best[:, None])))


def assignments(batch: pa.RecordBatch, books: np.ndarray) -> Iterator[tuple[int, int, np.ndarray | None, np.ndarray, dict]]:
    """For each block: part, the entry of all its points or -1, each point's entry otherwise, its values, its row."""
    parts, size = batch.column("part").to_numpy(), books.shape[2]
    boxes = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i4").reshape(batch.num_rows, size).astype(np.int64) for c in ("low", "high")]
    for part in np.unique(parts):
        mine, entries = np.flatnonzero(parts == part), books[part]
        squares = (entries**2).sum(axis=1)
        for at in range(0, len(mine), 1024):
            some = mine[at : at + 1024]
            for i, able in zip(some, shortlists(boxes[0][some], boxes[1][some], entries)):
                left = np.flatnonzero(able)
                values = np.frombuffer(batch.column("columns")[int(i)].as_py(), "<i4").reshape(size, -1)
                if len(left) == 1:
                    yield int(part), int(left[0]), None, values, i
                else:
                    nearest = (squares[left][:, None] - 2 * (entries[left] @ values.astype(np.int64))).argmin(axis=0)
                    yield int(part), -1, left[nearest], values, i


def train(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after so many rounds; each round reads the blocks once and returns sums and counts of entries only."""
    parts, count, size = books.shape
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            # The last column counts.
            totals = np.zeros((parts, count, size + 1), np.int64)
            for batch in batches:
                sums, n = batch.column("sums"), batch.column("n")
                for part, entry, each, values, i in assignments(batch, books):
                    if each is None:
                        totals[part, entry, :size] += np.frombuffer(sums[int(i)].as_py(), "<i8")
                        totals[part, entry, size] += n[int(i)].as_py()
                    else:
                        hits = (each[None] == np.arange(count)[:, None]).astype(np.int64)
                        totals[part, :, :size] += hits @ values.T.astype(np.int64)
                        totals[part, :, size] += hits.sum(axis=1)
            at = np.flatnonzero(totals.any(axis=2).ravel().repeat(size + 1))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(totals.ravel()[at])], names=["at", "total"])

        found = blocks.mapInArrow(run, "at long, total long").groupBy("at").agg(F.sum("total").alias("total")).collect()
        totals = np.zeros(parts * count * (size + 1), np.int64)
        for r in found:
            totals[r["at"]] = r["total"]
        totals = totals.reshape(parts, count, size + 1)
        used = totals[:, :, size] > 0
        means = totals[:, :, :size] // np.maximum(totals[:, :, size:], 1)
        books = np.where(used[:, :, None], means, books)
    return books


def coded_parts(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``row``, ``code`` (the entry's index at its part's byte), ``error`` of each part of each vector."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                batch = whole.slice(a, 500)
                rows, codes, errors = [], [], []
                for part, entry, each, values, i in assignments(batch, books):
                    index = np.full(values.shape[1], entry, np.int64) if each is None else each.astype(np.int64)
                    rows.append(np.frombuffer(batch.column("rows")[int(i)].as_py(), "<i8"))
                    codes.append(index << (8 * (parts - 1 - part)))
                    errors.append(((values.astype(np.int64) - books[part][index].T) ** 2).sum(axis=0))
                join = lambda x: pa.array(np.concatenate(x) if x else np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays([join(rows), join(codes), join(errors)], names=["row", "code", "error"])

    return blocks.mapInArrow(run, "row long, code long, error long")


def compress(
    df: DataFrame, id_column: str, vector_column: str, label_column: str,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """Codes of all vectors under codebooks that are trained on all of them, in whole numbers throughout.

    A component x counts as floor(scale * x). Vectors are cut into ``parts`` (at most 8) equal parts, each with
    a codebook of ``entries`` (at most 256), at first the parts of the vectors with the smallest ids. Each round
    assigns every part to the nearest entry (ties to the lower index) and moves used entries to the floored
    means of theirs; a last assignment gives the codes.

    Returns the id, ``code`` (two hex digits a part), ``error`` (squared distances), ``label_error`` (error summed
    over equal labels, NULLs together), ``codebooks_sha256``. Vectors that are NULL, empty, or hold NULL, non-finite or
    out-sized components (2^26 and more after scaling: squares might not fit a long) give no row. Repeated
    rows are kept, each with its code; of several vectors under one id, the first in byte order starts an entry.
    Fewer ids than entries make smaller codebooks. A vector of another length than the one with the smallest
    id, and every vector if no row has an id, gets a NULL code and error. A length that does not divide
    into ``parts`` is an error. An empty table gives an empty result; further columns are ignored.

    Parts move once, to their place on the curve; the rounds then read the written blocks without any
    shuffle but for the entries' sums. The driver holds the codebooks only.
    """
    kept = kept_rows(pick(df, id=id_column, vector=vector_column, label=label_column), scale)
    first_ids = kept.filter("id IS NOT NULL").select("id").distinct().orderBy("id").limit(entries)
    firsts = kept.join(F.broadcast(first_ids), "id").groupBy("id").agg(F.min(F.struct("codes", "dim")).alias("first")).orderBy("id").collect()
    if firsts:
        dim = firsts[0]["first"]["dim"]
        if dim % parts:
            raise ValueError(f"{dim} components do not divide into {parts} equal parts")
        starts = [np.frombuffer(bytes(r["first"]["codes"]), "<i4").reshape(parts, -1) for r in firsts if r["first"]["dim"] == dim]
        books = np.stack(starts, axis=1).astype(np.int64)
        # Only the curve's cells depend on these ends; values beyond them share the outermost cells.
        ends = kept.filter(F.col("dim") == dim).agg(F.percentile_approx("low", 0.05).alias("low"), F.percentile_approx("high", 0.95).alias("high")).first()
        blocks = flat_blocks(kept, dim, parts, ends["low"], ends["high"])
        books = train(blocks, books, rounds)
        by_row = coded_parts(blocks, books).groupBy("row").agg(F.sum("code").alias("code"), F.sum("error").alias("error"))
        coded = kept.select("row", "id", "label").join(by_row, "row", "left")
        coded = coded.withColumn("code", F.lower(F.lpad(F.hex("code"), 2 * parts, "0")))
    else:
        books = np.empty(0, np.int64)
        coded = kept.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = written(coded.select("id", "label", "code", "error"), "codes-coded")
    totals = written(coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "codes-labels")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    whole = coded.join(small_side(totals), F.col("label").eqNullSafe(F.col("of_label")), "left")
    return whole.select(F.col("id").alias(id_column), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


def _op13_sql() -> str:
    """All rounds written out: components as rows, a distance to each entry, the nearest one, floored means."""
    near = """n{k} AS MATERIALIZED (
        SELECT vec_id, part, arg_min(entry, (dist, entry)) AS entry, min(dist) AS dist
        FROM (SELECT v.vec_id, v.part, e.entry, sum((v.x - e.x) * (v.x - e.x)) AS dist
              FROM v JOIN b{k} e ON v.part = e.part AND v.pos = e.pos GROUP BY ALL) GROUP BY ALL)"""
    step = """b{m} AS MATERIALIZED (
        SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x
        FROM b{k} b LEFT JOIN (
            SELECT v.part, n.entry, v.pos, CAST(floor(sum(v.x) / count(*)) AS BIGINT) AS x
            FROM v JOIN n{k} n ON v.vec_id = n.vec_id AND v.part = n.part GROUP BY ALL) m
        ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)"""
    rounds = [x.format(k=k, m=k + 1) for k in range(ROUNDS) for x in (near, step)] + [near.format(k=ROUNDS)]
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT vec_id, label, embedding, len(embedding) // {PARTS} AS size FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    v AS MATERIALIZED (
        SELECT vec_id, (i - 1) // size AS part, (i - 1) % size AS pos, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
        FROM (SELECT vec_id, size, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
    b0 AS MATERIALIZED (
        SELECT v.part, f.entry, v.pos, v.x
        FROM v JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {ENTRIES}) f ON v.vec_id = f.vec_id),
    {", ".join(rounds)},
    coded AS (
        SELECT vec_id, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error
        FROM n{ROUNDS} GROUP BY vec_id),
    books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{ROUNDS})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id) CROSS JOIN books"""


OP13_SQL = _op13_sql()
