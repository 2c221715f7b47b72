"""Token counts; huge texts by overlap resynchronisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from cairnlake.llm.common import pick, table
from cairnlake.llm.vocabulary import Vocabulary, open_vocabulary, tokenizer_path
from cairnlake.llm.words import slices

#: Texts of more characters than this are encoded in chunks.
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
LIMIT = 512

SCHEMA = "id {id}, n_bytes long, n_tokens long, over_limit boolean, n_chunks long, n_widened long"


def spliced_count(vocabulary: Vocabulary, text: str, chunk: int, overlap: int) -> tuple[int, int, int]:
    """Tokens of ``text`` from overlapping chunks: (tokens, chunks, widened overlaps).

    The left chunk is exact from its start. A place counts as a proven boundary if both chunks
    start a pre-token there and it lies a guard before the left chunk's end: the guard is
    longer than any special token and than the split pattern's look-ahead, so cutting the
    text could not have moved it; and splitting reads from left to right, so from that place
    on the right chunk sees what the whole text would show. Behind it both chunks must agree
    on every boundary and count up to the guard. Where no such place lies in the overlap, the
    overlap is doubled and both sides are encoded anew, up to the text's start if need be.
    """
    guard = vocabulary.guard
    chunk = max(chunk, 4 * guard)
    # The left side always starts at a proven boundary, so it is exact.
    left_at, done, chunks, widened = 0, 0, 1, 0
    left_end = min(len(text), chunk)
    starts, counts = vocabulary.boundaries(text[:left_end])
    while left_end < len(text):
        width = min(max(overlap, 2 * guard), left_end - left_at)
        while True:
            right_at = max(left_at, left_end - width)
            right_end = min(len(text), left_end + chunk)
            r_starts, r_counts = vocabulary.boundaries(text[right_at:right_end])
            safe = left_end - guard
            common, i, j = np.intersect1d(starts + left_at, r_starts + right_at, return_indices=True)
            # The edge of the right chunk is a start by cutting only, unless it is the left one's too.
            usable = (common <= safe) & (common > right_at) if right_at > left_at else common <= safe
            at = np.flatnonzero(usable)
            if len(at) and _agree(starts + left_at, counts, r_starts + right_at, r_counts, common[at[0]], safe):
                k = at[0]
                # The left chunk counts up to the boundary, the right one goes on from it.
                done += int(counts[i[k]])
                left_at = int(common[k])
                starts = r_starts[j[k]:] - (left_at - right_at)
                counts = r_counts[j[k]:] - r_counts[j[k]]
                left_end, chunks = right_end, chunks + 1
                break
            widened += 1
            if right_at > left_at:
                width *= 2
            else:  # the whole left chunk is one overlap already: take more text into it
                left_end = min(len(text), left_end + width)
                width *= 2
                starts, counts = vocabulary.boundaries(text[left_at:left_end])
                if left_end == len(text):
                    break
    return done + int(counts[-1]), chunks, widened


def _agree(a_starts, a_counts, b_starts, b_counts, first: int, last: int) -> bool:
    """Whether both chunks show the same boundaries and counts from ``first`` to ``last``."""
    a, b = (a_starts >= first) & (a_starts <= last), (b_starts >= first) & (b_starts <= last)
    same = np.array_equal(a_starts[a], b_starts[b])
    return same and np.array_equal(np.diff(a_counts[a]), np.diff(b_counts[b]))


def count_tokens(
    df: DataFrame, id_column: str, text_column: str, path: str,
    limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """Tokens of every whole text by the tokenizer at ``path`` (a library .json, on every executor).

    Returns one row per input row: the id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``,
    ``n_chunks`` and ``n_widened`` (overlaps that had to grow). A NULL or empty text has 0 of
    each; a NULL id stays NULL; repeated rows are counted once each; an empty table gives an
    empty result; further columns are ignored. A task holds one text and its chunk's
    boundaries, so memory follows the longest text.
    """
    rows = pick(df, id=id_column, text=text_column)
    schema = SCHEMA.format(id=rows.schema["id"].dataType.simpleString())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = open_vocabulary(path)
        for batch in slices(batches):
            texts = pc.fill_null(batch.column("text"), "")
            n_bytes = pc.binary_length(texts).cast(pa.int64())
            huge = pc.greater(pc.utf8_length(texts), chunk_chars)
            n_tokens = np.diff(vocabulary.encode_all(pc.if_else(huge, "", texts))[1])
            n_chunks = (n_bytes.to_numpy() > 0).astype(np.int64)
            n_widened = np.zeros(len(texts), np.int64)
            for i in np.flatnonzero(huge.to_numpy(zero_copy_only=False)):
                n_tokens[i], n_chunks[i], n_widened[i] = spliced_count(vocabulary, texts[int(i)].as_py(), chunk_chars, overlap_chars)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), n_bytes, pa.array(n_tokens, pa.int64()), pa.array(n_tokens > limit), pa.array(n_chunks), pa.array(n_widened)],
                names=["id", "n_bytes", "n_tokens", "over_limit", "n_chunks", "n_widened"],
            )

    return rows.mapInArrow(count, schema).withColumnRenamed("id", id_column)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text", tokenizer_path("byte_bpe_50k.json"))
