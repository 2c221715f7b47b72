"""Packing of documents into fixed windows by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from cairnlake.llm.common import pick, table
from cairnlake.llm.vocabulary import open_vocabulary, tokenizer_path
from cairnlake.llm.words import slices

WINDOW = 2048
END_ID = 1
#: Beyond this many partly filled windows a task lays them end to end, so its memory is bounded.
OPEN_WINDOWS = 4096
#: Sequences of one task are numbered from its partition's number times this.
SEQUENCES_PER_TASK = 1 << 40

FIELDS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Packer:
    """Places pieces online; ``rows`` gets (row, start, length, crc32, doc_tokens, sequence, offset)."""

    def __init__(self, window: int, first_sequence: int, open_windows: int):
        self.window, self.next, self.open_windows = window, first_sequence, open_windows
        self.levels = np.zeros(window + 1, np.int64)  # partly filled windows by fill; 0 and full stay 0
        self.at: list[list[list]] = [[] for _ in range(window)]  # the windows of each level
        self.rows: list[tuple] = []

    def add(self, key, ids: np.ndarray) -> None:
        """One document: whole windows on their own, the rest where squares grow least."""
        total, whole = len(ids), len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self._emit([(key, start, ids[start : start + self.window], total)])
        if whole < total:
            self._place((key, whole, ids[whole:].copy(), total))

    def _place(self, piece: tuple) -> None:
        size, levels, window = len(piece[2]), self.levels, self.window
        # Moving a window from fill h to h + size changes the sum of squares by
        # 2 * (levels[h + size] - levels[h]) + 2; a new or a completed window lacks one term.
        change = 2 * (levels[size : window + 1] - levels[: window + 1 - size]) + 2
        change[0] -= 1
        change[-1] -= 1
        usable = levels[: window + 1 - size] > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        # Of equal changes the fullest window wins.
        h = len(change) - 1 - int(np.argmin(change[::-1]))
        if h == 0:
            filled = [piece]
        else:
            filled = self.at[h].pop()
            levels[h] -= 1
            filled.append(piece)
        if h + size == window:
            self._emit(filled)
        else:
            self.at[h + size].append(filled)
            levels[h + size] += 1
        if h == 0 and levels.sum() > self.open_windows:
            self._relay(last=False)

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            self.rows.append((key, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def _relay(self, last: bool) -> None:
        """Partly filled windows end to end, cut at window ends; at last the tail in powers of two.

        A sequence whose length is a power of two needs no padding, so none is left.
        """
        left = [piece for level in reversed(self.at) for filled in level for piece in filled]
        self.levels[:] = 0
        self.at = [[] for _ in range(self.window)]
        room, held = self.window, []
        tail = sum(len(p[2]) for p in left) % self.window
        whole = (sum(len(p[2]) for p in left) - tail) // self.window
        sizes = [self.window] * whole
        if last:
            sizes += [1 << b for b in reversed(range(tail.bit_length())) if tail >> b & 1]
        elif tail:
            sizes.append(tail)
        sizes = iter(sizes)
        room = next(sizes, 0)
        full = room
        for key, start, ids, total in left:
            while len(ids):
                take = ids[:room]
                held.append((key, start, take, total))
                start, ids, room = start + len(take), ids[len(take):], room - len(take)
                if room == 0:
                    if full == self.window or last:
                        self._emit(held)
                    else:
                        self.at[full].append(held)
                        self.levels[full] += 1
                    held = []
                    room = full = next(sizes, 0)

    def finish(self) -> None:
        self._relay(last=True)

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(
    df: DataFrame, id_column: str, text_column: str, path: str,
    window: int = WINDOW, end_id: int = END_ID, open_windows: int = OPEN_WINDOWS,
) -> DataFrame:
    """Documents as ids plus ``end_id``, packed into sequences of at most ``window`` ids.

    Each task packs the rows it reads: there is no shuffle, and a hot key means nothing. A
    document fills whole windows of its own first; its rest goes, uncut, to the fill level that
    minimises the sum of the squared numbers of partly filled windows. What is still partly
    filled when a task ends is laid end to end and cut at window ends; the very last tail becomes
    sequences whose lengths are powers of two. So all ids but at most log2(window) sequences
    of a task are in full windows and nothing is padded.

    Returns one row per piece: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``. A NULL or empty text is ``end_id`` alone; a NULL id stays
    NULL; repeated rows are packed once each; an empty table gives an empty result; further
    columns are ignored. A task holds one batch of texts and at most ``open_windows`` windows.
    """
    rows = pick(df, id=id_column, text=text_column)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{f} long" for f in FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = open_vocabulary(path)
        packer = Packer(window, TaskContext.get().partitionId() * SEQUENCES_PER_TASK, open_windows)
        id_type = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*packer.taken())) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["id", *FIELDS])

        for batch in slices(batches, 1500):
            id_type = batch.schema.field("id").type
            keys = batch.column("id").to_pylist()
            ids, offsets = vocabulary.encode_all(batch.column("text"))
            end = np.array([end_id], "<u4")
            for key, a, b in zip(keys, offsets[:-1], offsets[1:]):
                packer.add(key, np.concatenate((ids[a:b], end)))
            yield out()
        if id_type is not None:
            packer.finish()
            yield out()

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path("word_bpe_49k.json"))
