"""Markov model, toxicity network and language codes."""

import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cairnlake.llm import language_id, markov_model as mm, toxicity as tox
from cairnlake.llm.words import slices, split_words
from tests.llm.conftest import ODD


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def test_base_scores_and_counts(spark, odd, clashing, empty):
    training = [r for r in ODD if r[0] is None or r[0] % 2]
    learns = F.expr("id is null or id % 2 = 1")
    counts = Counter(w for _, t in training for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 4)) for i, t in ODD)
    for df in (odd, clashing):
        got = mm.score_texts(df, "doc_id", "text", learns).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
        assert all(np.isfinite(r.score) and r.score < 0 for r in got)
        assert len({(r.doc_id, round(r.score, 6)) for r in got if r.doc_id == 4}) == 1
    assert mm.score_texts(empty, "doc_id", "text", learns).count() == 0
    unknown = mm.score_texts(odd, "doc_id", "text", F.lit(False)).collect()
    assert len(unknown) == len(ODD) and all(r.n_known == 0 and abs(r.base_score) < 1e-6 for r in unknown)


def test_rare_words_come_through_the_join(spark, odd, monkeypatch):
    """With a low bound all counts but the most frequent are joined; nothing changes."""
    learns = F.lit(True)
    full = {(str(r.doc_id), r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in mm.score_texts(odd, "doc_id", "text", learns).collect()}
    monkeypatch.setattr(mm, "KNOWN_COUNT", 20)
    monkeypatch.setattr(mm, "OWN_SYMBOL", 10)
    joined = {(str(r.doc_id), r.n_tokens): (r.n_known, round(r.base_score, 6)) for r in mm.score_texts(odd, "doc_id", "text", learns).collect()}
    assert joined == full


def random_model(symbols, seed):
    rng = np.random.default_rng(seed)
    k = mm.STATES
    return mm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(symbols), k).T)


def test_forward_recursion_is_exact_and_proper():
    model = random_model(3, 1)
    every = list(product(range(3), repeat=4))
    flat = np.array(every).ravel()
    starts, lengths = np.arange(len(every)) * 4, np.full(len(every), 4)
    got = mm.log_likelihood(model, flat, starts, lengths)
    for text, value in zip(every[:20], got):
        total = 0.0
        for path in product(range(mm.STATES), repeat=4):
            p = model.start[path[0]] * model.emit[text[0], path[0]]
            for t in range(1, 4):
                p *= model.move[path[t - 1], path[t]] * model.emit[text[t], path[t]]
            total += p
        assert abs(10**value - total) < 1e-12
    assert abs((10**got).sum() - 1) < 1e-9


def test_expected_counts_raise_the_likelihood():
    rng = np.random.default_rng(2)
    flat, lengths = rng.integers(0, 5, 400), np.array([150, 1, 249])
    starts = np.cumsum(lengths) - lengths
    model, before = random_model(5, 3), -np.inf
    for _ in range(5):
        sums = mm.Sums(5)
        mm.expect(model, flat, starts, lengths, sums)
        assert abs(sums.emit.sum() - 400) < 1e-6 and abs(sums.start.sum() - 3) < 1e-9 and abs(sums.move.sum() - 397) < 1e-6
        now = mm.log_likelihood(model, flat, starts, lengths).sum()
        assert now > before
        before = now
        model = mm.Model(sums.start / sums.start.sum(), sums.move / sums.move.sum(1, keepdims=True), sums.emit / sums.emit.sum(0))


def test_partitions_add_up(spark, odd):
    rows = odd.toDF("id", "text").selectExpr("id", "text", "xxhash64(id, text) as key", "true as learns")
    counts = mm.gather_counts(mm.count_words(rows), rows.count())
    sequences, frequencies = mm.encode_texts(rows, mm.Encoder(counts)).filter("word is null"), counts.frequencies()
    model = mm.Model.first(frequencies, 1)
    one = mm.corpus_step(sequences.coalesce(1), model, frequencies)
    many = mm.corpus_step(sequences.repartition(7), model, frequencies)
    assert np.allclose(one.emit, many.emit) and np.allclose(one.move, many.move) and np.allclose(one.start, many.start)


def test_every_round_learns_from_all_rows(spark):
    """The model is that of plain rounds over all texts, also with more of them than any sample held."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"{'ab'[i % 2]}{k}" for k in rng.integers(0, 9, 1 + i % 5)) for i in range(1700)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").selectExpr("id", "text", "xxhash64(id, text) as key", "true as learns")
    counts = mm.gather_counts(mm.count_words(rows), rows.count())
    sequences, frequencies = mm.encode_texts(rows, mm.Encoder(counts)).filter("word is null").persist(), counts.frequencies()
    got = mm.train(sequences.select("key", "symbols"), counts)
    _, _, _, _, flat, starts, lengths = mm.Encoder(counts)(texts)
    model, before, rounds = mm.Model.first(frequencies, 5), -np.inf, 0
    while rounds < mm.ROUNDS:
        now = mm.log_likelihood(model, flat, starts, lengths).sum()
        sums = mm.Sums(counts.n_symbols)
        mm.expect(model, flat, starts, lengths, sums)
        assert abs(sums.likelihood - now) < 1e-6 * abs(now)
        model, rounds = sums.model(frequencies), rounds + 1
        if now - before <= mm.SETTLED * counts.tokens:
            break
        before = now
    sequences.unpersist()
    assert rounds > 1 and all(np.allclose(getattr(got, k), getattr(model, k)) for k in ("emit", "move", "start"))


def test_network_gradient():
    rng = np.random.default_rng(0)
    net = tox.Network.fresh(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words = [b"abc", b"x", b"hello", b"worthless"]
    index, mask = rng.integers(0, 4, (6, 5)), np.ones((6, 5))
    mask[0, 3:] = 0
    y = rng.integers(0, 2, 6).astype(float)

    def loss():
        z = net.run(net.gates(net.embed(words)), index, mask)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    found = {}
    net._step = lambda g, rate: found.update(g)
    net.learn(words, index, mask, y, 0.1)
    slot, grams, _ = tox.word_inputs(words)
    for name, place in [("Wf", (3, 5)), ("Ub", (2, 20)), ("cf", (7,)), ("A", (9, 1)), ("v", (2,)), ("o", (11,)), ("k", (0,)), ("word", (slot[2], 1)), ("gram", (grams[4], 3))]:
        old = net.p[name][place]
        net.p[name][place] = old + 1e-3
        up = loss()
        net.p[name][place] = old - 1e-3
        down = loss()
        net.p[name][place] = old
        assert abs((up - down) / 2e-3 - found[name][place]) < 1e-4, name


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 48, 49, 500])
def test_windows_cover_every_word(n):
    start, length, text = tox.windows(np.array([3, n, 2]))
    covered = np.zeros(n + 5, int)
    for s, size in zip(start, length):
        covered[s : s + size] += 1
    assert (covered > 0).all() and (length <= tox.WINDOW).all() and (text == np.sort(text)).all()
    own = start[text == 1] - 3
    assert n == 0 or (np.diff(own) <= tox.STRIDE).all()


def test_toxicity_held_out_and_odd_rows(spark, odd, clashing, empty):
    data = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{data}/documents.parquet").selectExpr("doc_id as id", "text")
    labels = spark.read.parquet(f"{data}/labels.parquet").selectExpr("doc_id as id", "toxic")
    fold = tox.fold("id", 4)
    net = tox.fit(docs.filter(fold != 2), labels.filter(fold != 2))
    held = tox.score_toxicity(docs.filter(fold == 2), "id", "text", net).join(labels, "id").toPandas()
    right = (held.predicted == held.toxic).mean()
    caught = held.predicted[held.toxic == 1].mean()
    assert right > 0.95 and caught > 0.85, (right, caught)
    for df in (odd, clashing):
        got = tox.score_toxicity(df, "doc_id", "text", net).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
        assert all(r.score == 0 and r.n_windows == 0 for r in got if r.doc_id in (1, 2, 3))
    assert tox.score_toxicity(empty, "doc_id", "text", net).count() == 0
    assert {r.score for r in tox.score_toxicity(odd, "doc_id", "text", None).collect()} == {0.0}
    kept = tox.without_toxic(clashing, "text", net)
    assert kept.columns == clashing.columns and kept.count() >= len(ODD) - 2
    assert tox.fit(docs, labels.filter("toxic = 0")) is None


def test_languages_held_out_and_odd_rows(spark, odd, clashing, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id as id", "text", "lang")
    known = docs.filter(language_id.fold("id", 5) != 0)
    sample = language_id.training_rows(known).toPandas()
    model = language_id.train(sample.text.tolist(), sample.lang.tolist())
    held = language_id.identify_languages(docs.filter(language_id.fold("id", 5) == 0), "id", "text", model).join(docs, "id").toPandas()
    assert (held.lang_pred == held.lang).mean() > 0.97
    for df in (odd, clashing):
        got = language_id.identify_languages(df, "doc_id", "text", model).collect()
        assert len(got) == len(ODD)
        assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 11)} == {"und"}
        assert all(0 <= r.score <= 1 and (r.score < language_id.SURE) == r.ambiguous for r in got)
        assert all(r.lang_pred in model.languages for r in got if r.doc_id in (4, 6, 9))
    assert language_id.identify_languages(empty, "doc_id", "text", model).count() == 0
    assert language_id.train([], []) is None
    assert {r.lang_pred for r in language_id.identify_languages(odd, "doc_id", "text", None).collect()} == {"und"}


def test_neighbours_in_a_block_do_not_matter():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abc é"), 50)) for _ in range(40)]
    model = language_id.train(texts[:20], ["a", "b"] * 10)
    alone = np.concatenate([language_id.bit_margins(model, [t]) for t in texts])
    assert np.allclose(alone, language_id.bit_margins(model, texts), atol=1e-4)


def test_codewords_are_apart():
    for n in (2, 4, 9, 20):
        code = language_id.codewords(n)
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 5


def test_split_words_like_python():
    texts = ["A b\tC\n\n d\x0be\x0cf \r", None, "", "  ", "É x y"]
    words, codes, sizes = split_words(texts)
    at = 0
    for text, n in zip(texts, sizes):
        assert [words[c] for c in codes[at : at + n]] == (text or "").encode().lower().split()
        at += n
    assert zlib.crc32(b"1") % 5 == tox_fold("1")


def tox_fold(text):
    return zlib.crc32(text.encode()) % 5


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_split_words_of_slices(kind):
    """Whatever part of a batch a slice is, its words are those of its texts."""
    texts = [f"Word{i} É{i}x\t{'Z' * i} " for i in range(12)] + [None, "", " one  more\n"]
    for some in (texts, texts[:12]):
        column = pa.array(some, kind)
        for at, n in ((0, 5), (1, 5), (5, 7), (10, 5)):
            words, codes, sizes = split_words(column.slice(at, n))
            assert [words[c] for c in codes] == [w for t in some[at : at + n] for w in (t or "").encode().lower().split()]
            assert len(sizes) == len(some[at : at + n])


def test_results_do_not_depend_on_slices(spark, monkeypatch):
    """Base scores of a batch that is read in many slices."""
    texts = [f"Ab{i % 7} cd{i} EF the The {'x' * (i % 5)}" for i in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    small = lambda batches, *_: slices(batches, 40)
    monkeypatch.setattr(mm, "slices", small)
    got = mm.score_texts(rows, "doc_id", "text", F.expr("id % 3 != 1")).collect()
    counts = Counter(w for i, t in enumerate(texts) if i % 3 != 1 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = [(i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6)) for i, t in enumerate(texts)]
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want


def test_toxicity_scores_do_not_depend_on_slices(spark, monkeypatch):
    """Rows of one batch have the scores of their texts alone, and the filter rejects by these."""
    monkeypatch.setattr(tox, "SCORED", 7)
    net = tox.Network.fresh(3)
    net.p["o"] *= 20
    texts = [f"Ab{i} THE cd{i * i} " * (i % 30 + 1) for i in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    want = [float(tox.text_scores(net, [t])[0][0]) for t in texts]
    got = {r.doc_id: r.score for r in tox.score_toxicity(rows, "doc_id", "text", net).collect()}
    assert np.allclose([got[i] for i in range(60)], want, atol=1e-4) and np.ptp(want) > 0.02
    middle = (sorted(want)[29] + sorted(want)[30]) / 2
    assert {r.doc_id for r in tox.without_toxic(rows, "text", net, middle).collect()} == {i for i, x in enumerate(want) if x < middle}


def test_toxicity_sample_has_one_row_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {k % 7}") for k in range(300)] + [(2, "other"), (3, None), (3, None)], "id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "id long, toxic int")
    rows, _ = tox.sample_labelled(docs, labels, 2)
    got = rows.collect()
    assert sorted((r.id, r.toxic) for r in got) == [(1, 1), (2, 0), (3, 0)]
    assert {r.text for r in got if r.id == 1} == {min((f"text {k}" for k in range(7)), key=lambda t: spark.sql(f"select xxhash64('{t}')").first()[0])}
