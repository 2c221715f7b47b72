"""Words of many texts at once, as numbers of distinct words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batches: Iterator[pa.RecordBatch], rows: int = 2500, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, and not many more bytes than ``size``, so that what a task holds besides them stays small."""
    for batch in batches:
        rows_now = max(1, min(rows, size * batch.num_rows // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows_now):
            yield batch.slice(at, rows_now)
        del batch
        pa.default_memory_pool().release_unused()


def split_words(texts: list[str | None] | pa.Array, lower: bool = True) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words (runs without ASCII blanks), the word numbers of all texts end to end, and words per text.

    lower: A-Z are lower-cased first. A NULL text has no words. Splitting and numbering happen
    outside Python, so Python sees each distinct word of the batch once.
    """
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
    column = pc.fill_null(column, "")
    # Before the cast: a slice that was cast keeps offsets that ascii_lower misreads.
    column = pc.ascii_lower(column) if lower else column
    parts = pc.ascii_split_whitespace(column.cast(pa.large_string()))
    flat, sizes = parts.flatten(), pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    lengths = pc.binary_length(flat).to_numpy(zero_copy_only=False)
    if len(lengths) and not lengths.all():  # blanks at a text's ends leave empty parts
        real = lengths > 0
        owner = np.repeat(np.arange(len(column)), sizes)
        flat, sizes = flat.filter(pa.array(real)), np.bincount(owner[real], minlength=len(column))
    coded = flat.dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    return words, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), sizes.astype(np.int64)
