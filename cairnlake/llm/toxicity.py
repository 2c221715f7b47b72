"""Toxicity by a bidirectional gated recurrent network with attention over overlapping windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cairnlake.llm.common import fold, pick, table
from cairnlake.llm.words import slices, split_words

#: Words of a window, and by how much the next one starts later.
WINDOW, STRIDE = 32, 16
#: Hash slots of words and of character trigrams, and the width of either input.
SLOTS, WIDTH, HIDDEN = 1 << 14, 8, 8
#: At most so many training rows of a label, those with the smallest hash of their id.
ROWS_PER_LABEL = 1200
#: Rounds over the training documents with windows drawn at random, then with the highest ones;
#: a small sample gets as many more rounds as these numbers of steps need.
EPOCHS_ANY, EPOCHS_BEST = 4, 10
LEAST_STEPS_ANY, LEAST_STEPS_BEST = 60, 30
#: Windows a training document may contribute to a random round (scoring takes all).
DRAWN = 5
_BATCH = 256
PREDICT_FROM = 0.3
#: A filter rejects from here on.
REJECT_FROM = 0.5
#: Texts that are scored at a time, and windows that go through the network at once.
SCORED, _BLOCK = 500, 1024


def word_inputs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word its slot, and the slots of its character trigrams end to end with their starts."""
    joined = b"".join(b"\x02" + w + b"\x03" for w in words)
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    buffer = np.frombuffer(joined + b"\x03\x03", np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    n = len(joined)
    grams = np.full(n, 0x811C9DC5, np.uint32)
    for k in range(3):
        grams = (grams ^ buffer[k : k + n]) * np.uint32(0x01000193)
    # The last two trigrams of a word reach over its end; the word's own end marks replace them.
    ends = starts + lengths
    last = np.uint32(0x9E3779B1)
    for k in (1, 2):
        grams[ends - k] = (buffer[ends - 1 - k] * np.uint32(31) + np.uint32(k)) * last
    grams = (grams ^ (grams >> np.uint32(13))) * np.uint32(0x85EBCA6B)
    whole = np.bitwise_xor.reduceat(grams * (np.arange(n, dtype=np.uint32) - np.repeat(starts, lengths).astype(np.uint32) + np.uint32(1)), starts)
    return ((whole ^ (whole >> np.uint32(15))) & np.uint32(SLOTS - 1)).astype(np.int64), ((grams ^ (grams >> np.uint32(16))) & np.uint32(SLOTS - 1)).astype(np.int64), starts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """Parameters: embeddings, per direction input and recurrent gates, attention, output."""

    p: dict[str, np.ndarray]
    shift: float = 0.0  # log odds from the balanced sample to all labelled rows
    moments: dict = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int) -> "Network":
        rng = np.random.default_rng(seed)
        g = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        p = {"word": g(SLOTS, WIDTH, scale=0.1), "gram": g(SLOTS, WIDTH, scale=0.1)}
        for d in "fb":
            p[f"W{d}"] = g(2 * WIDTH, 3 * HIDDEN, scale=0.3)
            p[f"U{d}"] = g(HIDDEN, 3 * HIDDEN, scale=0.3)
            p[f"c{d}"] = np.zeros(3 * HIDDEN, np.float32)
        p["A"], p["v"] = g(2 * HIDDEN, HIDDEN, scale=0.4), g(HIDDEN, scale=0.4)
        p["o"], p["k"] = g(2 * HIDDEN, scale=0.3), np.zeros(1, np.float32)
        return Network(p)

    def embed(self, words: list[bytes]) -> np.ndarray:
        """Word and mean character-trigram inputs side by side."""
        slot, grams, starts = word_inputs(words)
        if not words:
            return np.zeros((0, 2 * WIDTH), np.float32)
        counts = np.diff(np.append(starts, len(grams)))[:, None].astype(np.float32)
        return np.concatenate((self.p["word"][slot], np.add.reduceat(self.p["gram"][grams], starts, axis=0) / counts), axis=1)

    def run(self, gates: dict[str, np.ndarray], index: np.ndarray, mask: np.ndarray | None, keep: bool = False):
        """Logits of windows. gates: each word's input gates by direction; index: windows x words.

        mask: windows x words, 0 behind a short text's end (None: all full). keep: also what
        the gradient needs.
        """
        p, (n, size) = self.p, index.shape
        states = np.empty((size, n, 2 * HIDDEN), np.float32)
        trace = {}
        for d, order in (("f", range(size)), ("b", range(size - 1, -1, -1))):
            h = np.zeros((n, HIDDEN), np.float32)
            part = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)
            for t in order:
                x = gates[d][index[:, t]]
                u = h @ p[f"U{d}"]
                zr = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
                new = c + z * (h - c)
                if mask is not None:
                    new = h + mask[:, t, None] * (new - h)
                if keep:
                    trace[d, t] = h, z, r, c, u[:, 2 * HIDDEN :]
                h = new
                states[t, :, part] = h
        tanh = np.tanh(states @ p["A"])
        weight = tanh @ p["v"]
        if mask is not None:
            weight = np.where(mask.T > 0, weight, -1e9)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logit = pooled @ p["o"] + p["k"][0]
        return (logit, (trace, states, tanh, weight, pooled)) if keep else logit

    def gates(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        return {d: inputs @ self.p[f"W{d}"] + self.p[f"c{d}"] for d in "fb"}

    def learn(self, words: list[bytes], index: np.ndarray, mask: np.ndarray, y: np.ndarray, rate: float) -> float:
        """One Adam step on windows with labels; returns the mean loss."""
        p, (n, size) = self.p, index.shape
        inputs = self.embed(words)
        logit, (trace, states, tanh, weight, pooled) = self.run(self.gates(inputs), index, mask, keep=True)
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "gram")}
        pull = ((_sigmoid(logit) - y) / n).astype(np.float32)
        g["o"], g["k"] = pooled.T @ pull, np.array([pull.sum()], np.float32)
        to_pooled = pull[:, None] * p["o"]
        to_states = weight[:, :, None] * to_pooled
        to_weight = np.einsum("tnh,nh->tn", states, to_pooled)
        to_weight = weight * (to_weight - (weight * to_weight).sum(0))
        g["v"] = np.einsum("tn,tnh->h", to_weight, tanh)
        to_tanh = to_weight[:, :, None] * p["v"] * (1 - tanh * tanh)
        g["A"] = np.einsum("tni,tnj->ij", states, to_tanh)
        to_states += to_tanh @ p["A"].T
        to_inputs = np.zeros_like(inputs)
        for d, order in (("f", range(size - 1, -1, -1)), ("b", range(size))):
            part = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)
            carry = np.zeros((n, HIDDEN), np.float32)
            for t in order:
                h, z, r, c, uc = trace[d, t]
                m = mask[:, t, None]
                total = carry + to_states[t, :, part]
                back, total = total * (1 - m), total * m
                to_c = total * (1 - z) * (1 - c * c)
                to_z = total * (h - c) * z * (1 - z)
                to_r = to_c * uc * r * (1 - r)
                to_x = np.concatenate((to_z, to_r, to_c), axis=1)
                to_u = np.concatenate((to_z, to_r, to_c * r), axis=1)
                g[f"U{d}"] += h.T @ to_u
                carry = back + total * z + to_u @ p[f"U{d}"].T
                g[f"c{d}"] += to_x.sum(0)
                x = inputs[index[:, t]]
                g[f"W{d}"] += x.T @ to_x
                np.add.at(to_inputs, index[:, t], to_x @ p[f"W{d}"].T)
        slot, grams, starts = word_inputs(words)
        counts = np.diff(np.append(starts, len(grams)))
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(g["word"], slot, to_inputs[:, :WIDTH])
        np.add.at(g["gram"], grams, np.repeat(to_inputs[:, WIDTH:] / counts[:, None], counts, axis=0))
        self._step(g, rate)
        return float(np.mean(np.logaddexp(0, logit) - y * logit))

    def _step(self, g: dict[str, np.ndarray], rate: float) -> None:
        t = self.moments["t"] = self.moments.get("t", 0) + 1
        for k, grad in g.items():
            m, v = self.moments.get(k, (np.zeros_like(grad), np.zeros_like(grad)))
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            self.moments[k] = m, v
            self.p[k] = self.p[k] - np.float32(rate) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-7)


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (in the words of all texts), length and text of every window.

    Windows overlap by WINDOW - STRIDE words and the last one ends with its text; a shorter
    text is one window. A text without words has none.
    """
    count = np.where(sizes == 0, 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE)))
    text = np.repeat(np.arange(len(sizes)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = np.cumsum(sizes) - sizes
    start = np.minimum(place * STRIDE, np.maximum(sizes[text] - WINDOW, 0))
    return first[text] + start, np.minimum(sizes[text], WINDOW), text


def window_index(codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps = np.arange(WINDOW)
    mask = (steps < length[:, None]).astype(np.float32)
    return codes[start[:, None] + np.minimum(steps, length[:, None] - 1)], mask


def logits(net: Network, words: list[bytes], codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Logit of every window; all windows of all texts are scored."""
    gates = net.gates(net.embed(words))
    out = np.empty(len(start), np.float32)
    # Full windows need no mask, so short ones go through on their own.
    for full in (True, False):
        chosen = np.flatnonzero((length == WINDOW) == full)
        for at in range(0, len(chosen), _BLOCK):
            some = chosen[at : at + _BLOCK]
            index, mask = window_index(codes, start[some], length[some])
            out[some] = net.run(gates, index, None if full else mask)
    return out


def train(texts: list[str], labels: list[int], share: float, seed: int = 11) -> Network | None:
    """Learns from documents' labels, though windows score: first each window bears its document's
    label, then only the highest windows of each document do, as one toxic window suffices.

    share: the share of toxic rows among all labelled ones, to which scores are adjusted, as the
    sample is balanced. None without both labels.
    """
    y = np.array(labels)
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    net = Network.fresh(seed)
    words, codes, sizes = split_words(texts)
    start, length, text = windows(sizes)
    docs = np.flatnonzero(np.bincount(text, minlength=len(texts)))
    first = np.searchsorted(text, docs)
    counts = np.diff(np.append(first, len(text)))

    def epoch(chosen: np.ndarray, rate: float) -> None:
        rng.shuffle(chosen)
        for at in range(0, len(chosen), _BATCH):
            some = chosen[at : at + _BATCH]
            index, mask = window_index(codes, start[some], length[some])
            used, index = np.unique(index, return_inverse=True)
            net.learn([words[u] for u in used], index.reshape(mask.shape), mask, y[text[some]].astype(np.float32), rate)

    steps = -(-int(np.minimum(counts, DRAWN).sum()) // _BATCH)
    for _ in range(max(EPOCHS_ANY, -(-LEAST_STEPS_ANY // steps))):
        some = [first[i] + rng.choice(counts[i], min(DRAWN, counts[i]), replace=False) for i in range(len(docs))]
        epoch(np.concatenate(some), 0.01)
    rounds = max(EPOCHS_BEST, -(-LEAST_STEPS_BEST // max(1, len(docs) // _BATCH)))
    for k in range(rounds):
        z = logits(net, words, codes, start, length)
        best = [first[i] + np.argsort(-z[first[i] : first[i] + counts[i]], kind="stable")[: 2 if y[text[first[i]]] == 0 else 1] for i in range(len(docs))]
        epoch(np.concatenate(best), 0.01 / (1 + 3 * k / rounds))
    sampled = float(np.mean(y))
    net.shift = float(np.log(share / (1 - share)) - np.log(sampled / (1 - sampled)))
    net.moments = {}
    return net


def sample_labelled(docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL) -> tuple[DataFrame, DataFrame]:
    """A bounded training sample (``text``, ``toxic``) and the counts of all labelled rows by label.

    docs: ``id``, ``text``; labels: ``id``, ``toxic``. The labelled ids with the smallest hashes are
    picked before any text is touched; a text travels only if it is picked. Of an id that repeats
    the row with the least text hash is taken.
    """
    labels = labels.filter("id is not null and toxic in (0, 1)").dropDuplicates(["id"])
    counts = labels.groupBy("toxic").count()
    picked = None
    for value in (0, 1):
        some = labels.filter(F.col("toxic") == value).orderBy(F.xxhash64("id"), "id").limit(rows_per_label)
        picked = some if picked is None else picked.unionByName(some)
    # rows_per_label bounds this side, and by one row an id the sample.
    keyed = docs.select("id", "text", F.xxhash64("text").alias("k"))
    once = keyed.join(F.broadcast(picked), "id").groupBy("id", "toxic").agg(F.min("k").alias("k"))
    return keyed.join(F.broadcast(once), ["id", "k"]).dropDuplicates(["id", "k"]).select("id", "text", "toxic"), counts


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Train on the driver from the bounded sample; the counts are two rows."""
    rows, counts = sample_labelled(docs, labels)
    sample = rows.orderBy("id", "text").toPandas()
    totals = {r.toxic: r["count"] for r in counts.collect()}
    if set(totals) != {0, 1}:
        return None
    return train(sample["text"].fillna("").tolist(), sample["toxic"].astype(int).tolist(), totals[1] / (totals[0] + totals[1]))


def text_scores(net: Network | None, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Score and number of windows of each text."""
    scores, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    if net is not None:
        words, codes, sizes = split_words(texts)
        start, length, text = windows(sizes)
        count = np.bincount(text, minlength=len(texts))
        some = np.flatnonzero(count)
        if len(some):
            best = np.maximum.reduceat(logits(net, words, codes, start, length), np.searchsorted(text, some))
            scores[some] = np.round(_sigmoid(best.astype(np.float64) + net.shift), 5)
    return scores, count


def score_toxicity(df: DataFrame, id_column: str, text_column: str, net: Network | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The toxicity of every whole text: its highest window's.

    Returns one row per input row: the id, the columns in ``keep``, ``score`` (0 to 1), ``predicted``
    (1 from PREDICT_FROM on) and ``n_windows``. A text that is NULL or has no word, and any text
    without a network, has the score 0 and no window; a NULL id stays NULL; repeated rows get
    equal results; an empty table gives an empty result; further columns are ignored.
    """
    rows = pick(df, id=id_column, text=text_column, **{f"kept_{k}": k for k in keep})
    kept = "".join(f", kept_{k} {rows.schema[f'kept_{k}'].dataType.simpleString()}" for k in keep)
    schema = f"id {rows.schema['id'].dataType.simpleString()}{kept}, score double, predicted int, n_windows long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SCORED):
            scores, count = text_scores(net, batch.column("text"))
            columns = {"id": batch.column("id")} | {f"kept_{k}": batch.column(f"kept_{k}") for k in keep}
            columns |= {"score": pa.array(scores), "predicted": pa.array((scores >= PREDICT_FROM).astype(np.int32)), "n_windows": pa.array(count)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    out = rows.mapInArrow(run, schema)
    return out.withColumnsRenamed({"id": id_column} | {f"kept_{k}": k for k in keep})


def without_toxic(df: DataFrame, text_column: str, net: Network | None, least: float = REJECT_FROM) -> DataFrame:
    """``df`` without the rows whose text scores ``least`` or more; all its columns stay, no row is shuffled."""
    at = df.columns.index(text_column)
    named = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SCORED):
            scores, _ = text_scores(net, batch.column(at))
            yield batch.filter(pa.array(scores < least))

    return named.mapInArrow(run, named.schema).toDF(*df.columns)


def fit_on_tables(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Network | None:
    """Learns from the labels of rows outside the held-out fold."""
    docs = pick(docs, id="doc_id", text="text").filter(fold("id", 4) != 2)
    labels = pick(table(spark, sf_dir, "labels"), id="doc_id", toxic="toxic").filter(fold("id", 4) != 2)
    return fit(docs, labels)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = score_toxicity(documents, "doc_id", "text", fit_on_tables(spark, documents, sf_dir))
    return found.select("doc_id", (F.coalesce(fold("doc_id", 4), F.lit(0)) == 2).alias("held_out"), "score", "predicted", "n_windows")
