"""Hidden Markov language model: Baum-Welch over partitions, exact likelihood of whole texts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cairnlake.llm.common import fold, pick, table, written
from cairnlake.llm.words import slices, split_words

STATES = 6
#: A word is a symbol of its own from one in so many tokens on; so there are at most so many.
OWN_SYMBOL = 1 << 16
#: Counts of words from one in so many tokens on travel with the code; at most so many.
KNOWN_COUNT = 1 << 20
#: All other words share a symbol with those of the same ending.
CLASSES = 256
#: Rounds, each over all training rows: until log10 of a token's probability gains less than SETTLED, so many at most.
ROUNDS, SETTLED = 14, 0.0005
#: Training cuts longer texts into pieces of so many tokens; scoring never cuts.
TRAINING_PIECE = 8192
#: Weight, in tokens, of the overall symbol frequencies in each state's.
PRIOR = 200.0
#: Text positions whose forward values are held at once.
_HELD = 200_000


def word_hash(word: bytes) -> int:
    """64 bits, signed as Spark's long."""
    import xxhash

    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


@dataclass
class Counts:
    """What the training tokens say: totals, the counts of frequent words, class totals."""

    tokens: int
    types: int
    texts: int
    known: dict[int, int]  # hash -> count, the frequent ones
    symbols: dict[int, int]  # hash -> symbol
    class_tokens: np.ndarray
    class_types: np.ndarray

    @property
    def end(self) -> int:
        return len(self.symbols)

    @property
    def n_symbols(self) -> int:
        return len(self.symbols) + 1 + CLASSES

    @property
    def base_total(self) -> float:
        return np.log10(self.tokens + 0.5 * (self.types + 1))

    def class_total(self) -> np.ndarray:
        """log10 of each class's tokens with half a token for each type and for the unknown one."""
        return np.log10(self.class_tokens + 0.5 * (self.class_types + 1))

    def frequencies(self) -> np.ndarray:
        out = np.full(self.n_symbols, 0.5)
        for h, s in self.symbols.items():
            out[s] += self.known[h]
        out[self.end] += self.texts
        out[self.end + 1 :] += self.class_tokens
        return out / out.sum()


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols x states

    @staticmethod
    def first(frequencies: np.ndarray, seed: int) -> "Model":
        """States that tend to stay, with the overall frequencies shaken."""
        rng = np.random.default_rng(seed)
        emit = frequencies[:, None] * rng.uniform(0.3, 1.7, (len(frequencies), STATES))
        move = np.full((STATES, STATES), 0.1 / max(1, STATES - 1))
        np.fill_diagonal(move, 0.9)
        return Model(np.full(STATES, 1 / STATES), move, emit / emit.sum(0))


class Sums:
    """Expected counts of one E step, and log10 of the texts' probability."""

    def __init__(self, n_symbols: int):
        self.likelihood = 0.0
        self.start, self.move = np.zeros(STATES), np.zeros((STATES, STATES))
        self.emit = np.zeros((n_symbols, STATES))

    def model(self, frequencies: np.ndarray) -> Model:
        emit = self.emit + PRIOR * frequencies[:, None]
        move = self.move + 0.1
        start = self.start + 0.1
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _groups(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Texts from long to short, in groups that hold at most _HELD positions (or one text)."""
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        n = max(1, _HELD // max(1, int(lengths[order[at]])))
        yield order[at : at + n]
        at += n


def _columns(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Symbols at each position of the texts that reach it; texts come from long to short."""
    active = len(lengths)
    for t in range(int(lengths[0]) if len(lengths) else 0):
        while lengths[active - 1] <= t:
            active -= 1
        yield symbols[starts[:active] + t]


def expect(model: Model, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, sums: Sums) -> None:
    """Adds the expected counts of texts by scaled forward and backward recursion."""
    for group in _groups(lengths):
        columns = list(_columns(symbols, starts[group], lengths[group]))
        if not columns:
            continue
        forward, scales, emits = [], [], []
        for t, column in enumerate(columns):
            e = model.emit[column]
            a = (model.start if t == 0 else forward[-1][: len(column)] @ model.move) * e
            c = a.sum(1, keepdims=True)
            forward.append(a / c)
            scales.append(c)
            emits.append(e)
        after = np.ones((len(columns[-1]), STATES))
        shares = [None] * len(columns)
        for t in range(len(columns) - 1, -1, -1):
            n = len(columns[t])
            if len(after) < n:
                after = np.concatenate((after, np.ones((n - len(after), STATES))))
            shares[t] = forward[t] * after
            if t:
                back = emits[t] * after / scales[t]
                sums.move += model.move * (forward[t - 1][:n].T @ back)
                after = back @ model.move.T
        sums.likelihood += float(np.log10(np.concatenate(scales)).sum())
        sums.start += shares[0].sum(0)
        flat, weight = np.concatenate(columns), np.concatenate(shares)
        for k in range(STATES):
            sums.emit[:, k] += np.bincount(flat, weights=weight[:, k], minlength=len(sums.emit))


def log_likelihood(model: Model, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 of each text's probability by the scaled forward recursion; nothing is cut or kept."""
    out = np.zeros(len(lengths))
    for group in _groups(lengths):
        a = None
        total = np.zeros(len(group))
        for column in _columns(symbols, starts[group], lengths[group]):
            n = len(column)
            a = (model.start if a is None else a[:n] @ model.move) * model.emit[column]
            c = a.sum(1)
            a /= c[:, None]
            total[:n] += np.log10(c)
        out[group] = total
    return out


class Encoder:
    """Texts of a batch as symbols, each text with its end."""

    def __init__(self, counts: Counts):
        self.counts = counts

    def __call__(self, texts: list[str | None] | pa.Array):
        words, codes, sizes = split_words(texts)
        hashes = [word_hash(w) for w in words]
        counts = self.counts
        first_class = counts.end + 1
        symbol = np.array([counts.symbols.get(h, -1) for h in hashes], np.int64)
        kinds = np.array([word_class(w) for w in words], np.int64)
        symbol = np.where(symbol < 0, first_class + kinds, symbol) if len(words) else symbol
        lengths = sizes + 1
        starts = np.cumsum(lengths) - lengths
        flat = np.full(int(lengths.sum()), counts.end, np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        if len(codes):
            flat[np.arange(len(codes)) + owner] = symbol[codes]
        return hashes, symbol, codes, owner, flat, starts, lengths


def count_words(texts: DataFrame) -> DataFrame:
    """``hash``, ``class``, ``count`` of all words of ``text``; batches are counted before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5000):
            words, codes, _ = split_words(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([word_hash(w) for w in words], pa.int64()), pa.array([word_class(w) for w in words], pa.int32()), pa.array(np.bincount(codes, minlength=len(words)), pa.int64())],
                names=["hash", "class", "n"],
            )

    return texts.select("text").mapInArrow(run, "hash long, class int, n long").groupBy("hash", "class").agg(F.sum("n").alias("count"))


def gather_counts(vocabulary: DataFrame, texts: int) -> Counts:
    """Totals of a written vocabulary. What is fetched is bounded by OWN_SYMBOL, KNOWN_COUNT and CLASSES."""
    total, types = vocabulary.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    tokens = total + texts  # every text has an end
    frequent = vocabulary.filter(F.col("count") * KNOWN_COUNT >= tokens).select("hash", "count").orderBy(F.desc("count"), "hash").toArrow()
    known = dict(zip(frequent.column("hash").to_pylist(), frequent.column("count").to_pylist()))
    own = [h for h, c in known.items() if c * OWN_SYMBOL >= tokens]
    rest = vocabulary.filter(F.col("count") * OWN_SYMBOL < tokens).groupBy("class").agg(F.sum("count").alias("n"), F.count("*").alias("types"))
    class_tokens, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in rest.collect():
        class_tokens[row["class"]], class_types[row["class"]] = row.n, row.types
    return Counts(tokens, types + (texts > 0), texts, known, {h: s for s, h in enumerate(own)}, class_tokens, class_types)


def pieces(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of pieces of at most TRAINING_PIECE tokens."""
    count = -(-lengths // TRAINING_PIECE)
    place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    left = np.repeat(lengths, count) - place * TRAINING_PIECE
    return np.repeat(starts, count) + place * TRAINING_PIECE, np.minimum(left, TRAINING_PIECE)


def _sequences(column: pa.Array, n_symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of written texts end to end, with starts and lengths."""
    cells = column.to_pylist()
    kind = _symbol_type(n_symbols)
    flat = np.frombuffer(b"".join(cells), kind).astype(np.int64)
    lengths = np.fromiter(map(len, cells), np.int64, len(cells)) // np.dtype(kind).itemsize
    return flat, np.cumsum(lengths) - lengths, lengths


def _symbol_type(n_symbols: int) -> str:
    return "<u2" if n_symbols <= 1 << 16 else "<u4"


def corpus_sums(sequences: DataFrame, model: Model) -> Sums:
    """The E step over all rows: each task sums expected counts, Spark adds them by symbol.

    sequences: ``symbols``. At most ``n_symbols`` + STATES + 2 rows of STATES numbers come back, whatever
    the corpus.
    """
    sent = sequences.sparkSession.sparkContext.broadcast(model)
    names = [f"s{k}" for k in range(STATES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        sums = Sums(len(model.emit))
        for batch in slices(batches):
            flat, starts, lengths = _sequences(batch.column("symbols"), len(model.emit))
            expect(model, flat, *pieces(starts, lengths), sums)
        rows = np.concatenate((sums.emit, sums.move, sums.start[None], np.full((1, STATES), sums.likelihood)))
        used = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(rows[used, k]) for k in range(STATES))], names=["row", *names])

    schema = "row long, " + ", ".join(f"{n} double" for n in names)
    found = sequences.select("symbols").mapInArrow(run, schema).groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    rows = np.zeros((len(model.emit) + STATES + 2, STATES))
    if found.num_rows:
        rows[found.column("row").to_numpy()] = np.stack([found.column(n).to_numpy() for n in names], axis=1)
    sums = Sums(len(model.emit))
    sums.emit, sums.move, sums.start, sums.likelihood = rows[: len(model.emit)], rows[len(model.emit) : -2], rows[-2], float(rows[-1, 0])
    return sums


def corpus_step(sequences: DataFrame, model: Model, frequencies: np.ndarray) -> Model:
    """One Baum-Welch round over all rows of ``sequences``."""
    return corpus_sums(sequences, model).model(frequencies)


def train(sequences: DataFrame, counts: Counts, seed: int = 5) -> Model:
    """sequences: ``symbols`` of all training rows, which every round reads; the start knows their symbols' counts only."""
    frequencies = counts.frequencies()
    model, before = Model.first(frequencies, seed), -np.inf
    for _ in range(ROUNDS):
        sums = corpus_sums(sequences, model)
        model = sums.model(frequencies)
        if sums.likelihood - before <= SETTLED * counts.tokens:
            break
        before = sums.likelihood
    return model


_ENCODED = "key long, learns boolean, symbols binary, word long, n long, first int, n_tokens long, n_known long, base double, extra double"
_NAMES = ["id", *(f.split()[0] for f in _ENCODED.split(", "))]


def encode_texts(rows: DataFrame, encoder: Encoder) -> DataFrame:
    """Two kinds of rows: each text's symbols with its sums over frequent words, and its rare words with counts.

    rows: ``id``, ``text``, ``key``, ``learns``.
    """
    sent = rows.sparkSession.sparkContext.broadcast(encoder)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = sent.value
        counts = encoder.counts
        class_total, symbol_type = counts.class_total(), _symbol_type(counts.n_symbols)
        for batch in slices(batches):
            keys, n = batch.column("key"), batch.num_rows
            hashes, symbol, codes, owner, flat, starts, lengths = encoder(batch.column("text"))
            known = np.array([counts.known.get(h, 0) for h in hashes], np.float64)
            # log10(c + 0.5) of a frequent word; the others' comes from the join.
            own = np.where(known > 0, np.log10(known + 0.5), 0.0)
            in_class = symbol > counts.end
            extra = np.where(in_class, own - class_total[np.maximum(symbol - counts.end - 1, 0)], 0.0) if len(hashes) else own
            n_known = np.bincount(owner, weights=known[codes] > 0, minlength=n) + (counts.texts > 0)
            base = np.bincount(owner, weights=own[codes], minlength=n) + np.log10(counts.texts + 0.5) - lengths * counts.base_total
            written_symbols = flat.astype(symbol_type)
            cells = [written_symbols[a : a + m].tobytes() for a, m in zip(starts, lengths)]
            none = pa.nulls
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), keys, batch.column("learns"), pa.array(cells, pa.binary()), none(n, pa.int64()), none(n, pa.int64()), none(n, pa.int32()), pa.array(lengths), pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(np.bincount(owner, weights=extra[codes], minlength=n).astype(np.float64))],
                names=_NAMES,
            )
            rare = np.flatnonzero((known == 0)[codes]) if len(codes) else codes
            if len(rare):
                pairs, times = np.unique(owner[rare] * len(hashes) + codes[rare], return_counts=True)
                text, word = np.divmod(pairs, len(hashes))
                first = np.append(True, text[1:] != text[:-1]).astype(np.int32)
                m = len(pairs)
                yield pa.RecordBatch.from_arrays(
                    [none(m, batch.schema.field("id").type), keys.take(pa.array(text)), none(m, pa.bool_()), none(m, pa.binary()), pa.array(np.array(hashes, np.int64)[word]), pa.array(times.astype(np.int64)), pa.array(first), none(m, pa.int64()), none(m, pa.int64()), none(m, pa.float64()), none(m, pa.float64())],
                    names=_NAMES,
                )

    return rows.mapInArrow(run, f"id {kind}, {_ENCODED}")


def score_texts(df: DataFrame, id_column: str, text_column: str, learns: Column) -> DataFrame:
    """log10 probability of every whole text under the model trained on the rows where ``learns``, an
    expression over the id under the name ``id``, is true.

    Tokens are runs of non-blanks with A-Z lower-cased, then one end. Frequent words and the end
    are symbols; each other word shares one with the words of its ending, and a word of a symbol
    has (c + 0.5) / (N + 0.5 * (V + 1)) of it, with c its training count and N, V the symbol's
    tokens and types; unknown words are one more type of their symbol. So the model is a proper one
    over the known words and one unknown word for each ending.

    Counts of frequent words travel with the code (their number is bounded by the definition of
    frequent); the others are joined by hash, summed once for each text. None of these can be a
    hot key, as each is rarer than one in KNOWN_COUNT tokens.

    Returns one row per input row: the id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    (each token by its count alone) and ``score``. A NULL or empty text is the end alone; a NULL id
    stays NULL; repeated rows get equal results; without training rows every word is unknown;
    an empty table gives an empty result; further columns are ignored.
    """
    rows = pick(df, id=id_column, text=text_column).select("id", "text", F.xxhash64("id", "text").alias("key"), F.coalesce(learns, F.lit(False)).alias("learns"))
    training = rows.filter("learns")
    vocabulary = written(count_words(training), "vocabulary")
    counts = gather_counts(vocabulary, training.select("id").count())
    # Texts are split once more only: rounds of training and scores read their symbols.
    encoded = written(encode_texts(rows, Encoder(counts)), "encoded-texts")
    sequences = encoded.filter("word is null")
    model = train(sequences.filter("learns").select("symbols"), counts)
    sent = df.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = log_likelihood(sent.value, *_sequences(batch.column("symbols"), len(sent.value.emit)))
            columns = [batch.column(c) for c in ("id", "key", "n_tokens", "n_known", "base")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score + batch.column("extra").to_numpy())], names=["id", "key", "n_tokens", "n_known", "base", "score"])

    scored = sequences.select("id", "key", "n_tokens", "n_known", "base", "extra", "symbols").mapInArrow(run, f"id {kind}, key long, n_tokens long, n_known long, base double, score double")
    seldom = vocabulary.filter(F.col("count") * KNOWN_COUNT < counts.tokens).select(F.col("hash").alias("word"), "count")
    words = encoded.filter("word is not null").select("key", "word", "n", "first").join(seldom, "word", "left")
    c = F.coalesce("count", F.lit(0))
    # Repeated rows bring their words again, so sums are shared among them.
    sums = words.groupBy("key").agg(F.sum(F.col("n") * F.log10(c + 0.5)).alias("rare"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rare_known"), F.sum("first").alias("copies"))
    rare = F.coalesce(F.col("rare") / F.col("copies"), F.lit(0.0))
    return (
        scored.join(sums, "key", "left").select(
            F.col("id").alias(id_column), "n_tokens",
            (F.col("n_known") + F.coalesce(F.expr("rare_known div copies"), F.lit(0))).alias("n_known"),
            F.lit(counts.tokens).cast("long").alias("train_tokens"),
            (F.col("base") + rare).alias("base_score"), (F.col("score") + rare).alias("score"),
        )
    )


def op2_markov_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held = F.coalesce(fold("doc_id", 5), F.lit(0)) == 1
    found = score_texts(documents, "doc_id", "text", F.coalesce(fold("id", 5), F.lit(0)) != 1)
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
