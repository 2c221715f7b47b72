"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cairnlake.llm.common import fold, pick, table

#: n-grams of these lengths are hashed into this many slots.
ORDERS = (2, 3, 4)
SLOTS = 1 << 13
#: At most so many training rows of a language, those with the smallest hash of their id.
ROWS_PER_LANGUAGE = 600
#: A result is ambiguous if the best language's share is below this.
SURE = 0.6
UNDETERMINED = "und"
_BLOCK_BYTES = 1 << 18


@dataclass
class Codes:
    languages: list[str]
    words: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # slots x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit's loss


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """A code of at least 15 bits; of random ones that with the largest least distance."""
    bits = max(15, 6 * max(1, int(np.ceil(np.log2(max(languages, 2))))))
    rng = np.random.default_rng(seed)
    best, best_distance = None, -1
    for _ in range(300):
        code = rng.choice((-1, 1), (languages, bits))
        for b in range(bits):  # a bit that is alike for all languages tells nothing
            if languages > 1 and abs(code[:, b].sum()) == languages:
                code[rng.integers(languages), b] *= -1
        distance = min((int((code[i] != code[j]).sum()) for i in range(languages) for j in range(i)), default=bits)
        if distance > best_distance:
            best, best_distance = code, distance
    return best


def padded(text: str) -> bytes:
    """Two blanks on both sides keep the n-grams of neighbours in one buffer apart."""
    return b"  " + text.lower().encode() + b"  "


def slots(buffer: np.ndarray, order: int) -> np.ndarray:
    """The slot of the n-gram that starts at each byte; short of the buffer's end by the order."""
    n = len(buffer) - order + 1
    h = np.full(max(n, 0), order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        h = (h ^ buffer[k : k + n]) * np.uint32(0x01000193)
    return (h ^ (h >> np.uint32(15))) & np.uint32(SLOTS - 1)


def frequencies(texts: list[str]) -> np.ndarray:
    """Relative n-gram frequencies, scaled; one row per text."""
    out = np.zeros((len(texts), SLOTS), np.float32)
    for i, text in enumerate(texts):
        buffer = np.frombuffer(padded(text), np.uint8).astype(np.uint32)
        total = 0
        for order in ORDERS:
            found = slots(buffer, order)
            out[i] += np.bincount(found, minlength=SLOTS)
            total += len(found)
        out[i] *= 64 / total
    return out


def train(texts: list[str], labels: list[str], seed: int = 7, rounds: int = 60) -> Codes | None:
    """One logistic n-gram classifier per bit, all at once, by Adam.

    Each text gives itself and one snippet of a few words, as short texts must be told apart too.
    """
    languages = sorted(set(labels))
    if not languages:
        return None
    code = codewords(len(languages), seed)
    rng = np.random.default_rng(seed)
    snippets = []
    for text in texts:
        words = text.split()
        size = int(rng.integers(2, 30))
        at = int(rng.integers(0, max(1, len(words) - size)))
        snippets.append(" ".join(words[at : at + size]))
    x = frequencies(texts + snippets)
    target = np.array([languages.index(v) for v in labels] * 2)
    y = code[target].astype(np.float32)
    order = rng.permutation(len(x))
    held, kept = order[: len(x) // 10], order[len(x) // 10 :]
    w, b = np.zeros((SLOTS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    step = 0
    for _ in range(max(1, rounds // max(1, -(-len(kept) // 512)))):
        rng.shuffle(kept)
        for at in range(0, len(kept), 512):
            some = kept[at : at + 512]
            xs, ys = x[some], y[some]
            pull = -ys / (1 + np.exp(np.clip(ys * (xs @ w + b), -30, 30))) / len(some)
            g = xs.T @ pull + 1e-5 * w
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.98 * v + 0.02 * g * g
            w -= 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-6)
            b -= 0.5 * pull.sum(0)
    right = ((x[held] @ w + b) * y[held] > 0).mean(0) if len(held) else np.ones(code.shape[1])
    trust = np.clip(right, 0.5, 0.999)
    trust = np.log(trust / (1 - trust)) + 1e-3
    return Codes(languages, code, w, b, trust / trust.mean())


def bit_margins(model: Codes, texts: list[str]) -> np.ndarray:
    """What each bit's classifier says of each text; texts go through in blocks of bytes."""
    out = np.zeros((len(texts), len(model.bias)), np.float64)
    totals = np.zeros(len(texts))
    pieces = [padded(t) for t in texts]
    at = 0
    while at < len(pieces):
        end, size = at, 0
        while end < len(pieces) and (end == at or size + len(pieces[end]) <= _BLOCK_BYTES):
            size += len(pieces[end])
            end += 1
        lengths = np.array([len(p) for p in pieces[at:end]])
        joined = b"".join(pieces[at:end])
        # A text longer than a block is read in slices, so that no more than a block's rows are held.
        for order in ORDERS:
            if end - at == 1:
                for lo in range(0, len(joined) - order + 1, _BLOCK_BYTES):
                    buffer = np.frombuffer(joined[lo : lo + _BLOCK_BYTES + order - 1], np.uint8).astype(np.uint32)
                    out[at] += model.weights[slots(buffer, order)].sum(0, dtype=np.float64)
                totals[at] += len(joined) - order + 1
                continue
            # The last texts' n-grams end in blanks, so a few more blanks complete the last ones.
            buffer = np.frombuffer(joined + b" " * (order - 1), np.uint8).astype(np.uint32)
            starts = np.cumsum(lengths) - lengths
            counts = lengths - order + 1
            rows = model.weights[slots(buffer, order)]
            # n-grams that reach into the next text do not count.
            ends = starts + lengths
            for k in range(1, order):
                rows[ends - k] = 0
            out[at:end] += np.add.reduceat(rows, starts, axis=0)
            totals[at:end] += counts
        at = end
    return out * (64 / totals)[:, None] + model.bias


def decode(model: Codes, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and share of the language whose codeword has the least weighted logistic loss."""
    loss = np.stack([(np.logaddexp(0, -margins * word) * model.trust).sum(1) for word in model.words], axis=1)
    share = np.exp(-(loss - loss.min(1, keepdims=True)) / 2)
    share /= share.sum(1, keepdims=True)
    best = np.argmin(np.round(loss, 9), axis=1)
    return best, share[np.arange(len(best)), best]


def training_rows(df: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """``text``, ``lang`` of the rows with the smallest hashes of each language.

    df: ``id``, ``text``, ``lang``. The rank limit is applied before the shuffle, so a hot language
    sends few rows.
    """
    by = Window.partitionBy("lang").orderBy(F.xxhash64("id"), F.xxhash64("text"))
    return (
        df.filter("text is not null and lang is not null")
        .withColumn("place", F.row_number().over(by))
        .filter(F.col("place") <= rows_per_language)
        .select("text", "lang")
    )


def identify_languages(df: DataFrame, id_column: str, text_column: str, model: Codes | None) -> DataFrame:
    """The language of every whole text.

    Returns one row per input row: the id, ``lang_pred``, ``score`` (the best language's share of the
    decoding, 0 to 1) and ``ambiguous`` (share below SURE).
    A text that is NULL or has no letter is ``und`` with score 0 and ambiguous, and so is every text
    without a model; a NULL id stays NULL; repeated rows get equal results; of tied languages
    the first by name wins; an empty table gives an empty result; further columns are ignored.
    """
    rows = pick(df, id=id_column, text=text_column)
    rows = rows.select("id", F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double, ambiguous boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            lettered = [i for i, t in enumerate(texts) if t is not None]
            if lettered and model is not None:
                best, share = decode(model, bit_margins(model, [texts[i] for i in lettered]))
                for i, k, s in zip(lettered, best, share):
                    names[i], scores[i] = model.languages[k], float(s)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array([s < SURE for s in scores], pa.bool_())],
                names=["id", "lang_pred", "score", "ambiguous"],
            )

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    known = pick(documents, id="doc_id", text="text", lang="lang").filter(fold("id", 5) != 0)
    sample = training_rows(known).toPandas()
    model = train(sample["text"].tolist(), sample["lang"].tolist())
    found = identify_languages(documents, "doc_id", "text", model)
    return found.select("doc_id", (F.coalesce(fold("doc_id", 5), F.lit(1)) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")
