"""Conversation trie, exact search and vector codes against plain computations."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest

from cairnlake.llm import conversation_trie as ct, vector_codes as vc, vector_search as vs

TURNS = "conv_id long, turn long, role string, text string"


def turn_order(turn, role, text):
    told = f"{len((role or '').encode())}:{role or ''}{text or ''}"
    return turn is not None, turn or 0, hashlib.sha256(told.encode()).digest()[:16]


def plain_trie(rows, rebuild):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn_order(turn, role, text), (role or "", text or "")))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        head = own.get(c - int(math.fmod(c, 100)), [])[:h] if rebuild else []
        full[c] = tuple(head + own[c][h:])
    members, children, leaves, saved = {}, {}, {}, {}
    for c, s in full.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
            saved[p[:d]] = saved.get(p[:d], 0) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(c for c in m if len(full[c]) == len(p)))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def trie_rows(spark, rows, rebuild):
    df = spark.createDataFrame(rows, TURNS)
    return sorted(map(tuple, ct.conversation_trie(df, "conv_id", "turn", "role", "text", rebuild).collect()))


def conversations(seed, n, long=0):
    """Conversations over few turns, so that they share prefixes, end inside others and repeat."""
    rng, rows = random.Random(seed), []
    for c in range(n):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8, 13])):
            rows.append((c * rng.choice([1, 7]) if turn == 0 else rows[-1][0], turn, rng.choice(["user", "bot"]), rng.choice(["a", "bb", "é🙂"])))
    for c in (5000, 5001, 5002):
        rows += [(c, t, "user", f"turn {t}") for t in range(long - c % 3)]
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
def test_trie_against_plain_prefixes(spark, rebuild):
    rows = conversations(1, 250, long=300)
    assert trie_rows(spark, rows, rebuild) == plain_trie(rows, rebuild)


def test_trie_with_groups_beyond_the_limit(spark, monkeypatch):
    monkeypatch.setattr(ct, "FIRST", 2)
    monkeypatch.setattr(ct, "MORE", 3)
    monkeypatch.setattr(ct, "GROUP", 4)
    monkeypatch.setattr(ct, "TURNS", 2)
    rows = conversations(2, 200, long=40)
    assert trie_rows(spark, rows, False) == plain_trie(rows, False)


def test_trie_of_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (2, 3, None, None), (2, 3, "user", "x"), (None, 0, "user", "x"),
        (-5, 0, "a", "b"), (-100, 0, "a", "b"), (3, 0, "user", "long " * 20_000), (100, 1, "u", "same"), (101, 1, "u", "same"), (102, None, "u", "same"),
    ]
    for rebuild in (False, True):
        assert trie_rows(spark, rows, rebuild) == plain_trie(rows, rebuild)
    assert trie_rows(spark, [], True) == []
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS key", "2 AS depth", "3 AS at", "4 AS group", "5 AS Turn_", "6 AS conv", "'x' AS TEXT")
    got = ct.conversation_trie(df, "conv_id", "turn", "role", "text").collect()
    assert sorted(map(tuple, got)) == plain_trie(rows, False)


def test_one_conversation_with_a_third_of_all_rows(spark):
    rows = [(c, t, "user", f"{t % 7}") for c in range(400) for t in range(5)] + [(1000, t, "user", f"{t % 7}") for t in range(1000)]
    assert trie_rows(spark, rows, True) == plain_trie(rows, True)


def test_fat_binary_search_finds_the_exit():
    rng = random.Random(3)
    trie, known = ct.ZFastTrie(), set()

    def path(letters):
        last, out = ct.ROOT, b""
        for x in letters:
            last = hashlib.blake2b(last + bytes([x]), digest_size=ct.HASH).digest()
            out += last
        return out

    for _ in range(2000):
        s = tuple(rng.choice([0, 0, 0, 1]) for _ in range(rng.randint(0, 60)))
        expected = max(d for d in range(len(s) + 1) if d == 0 or s[:d] in known)
        node, depth = trie.locate(path(s), len(s))
        assert depth == expected and node.top < max(depth, 0) + (depth == 0) and depth <= node.depth
        trie.insert(path(s), len(s), None)
        known |= {s[:d] for d in range(1, len(s) + 1)}
    # Compacted: one handle a node.
    stack, nodes = [trie.root], 0
    while stack:
        node = stack.pop()
        nodes += 1
        stack += node.children.values()
    assert len(trie.handles) == nodes - 1 < len(known)


def test_two_fattest_numbers():
    for low, high in itertools.combinations(range(130), 2):
        best = max(range(low + 1, high + 1), key=lambda x: x & -x)
        assert ct.fattest(low, high) == best


# --- search ---------------------------------------------------------------------------------


def usable(v, scale):
    return v is not None and all(x is not None and np.isfinite(x) and abs(np.floor(scale * x)) < vs.LARGEST for x in v)


def plain_search(rows, every, k):
    kept = {(i, tuple(int(np.floor(1024 * x)) for x in v)) for i, v in rows if usable(v, 1024)}
    out = []
    for i, q in kept:
        if i is not None and i % every == 0:
            found = [(-sum(a * b for a, b in zip(q, c)), j is None, j) for j, c in kept if j != i and len(c) == len(q)]
            found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
            out += [(i, n + 1, j, -s) for n, (s, _, j) in enumerate(found[:k])]
    return sorted(out, key=str)


def searched(spark, rows, every, k=10, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(map(tuple, vs.top_k(df, "vec_id", "embedding", every, k, **more).collect()), key=str)


ODD_VECTORS = [
    (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 1.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, [1.0]),
    (6, [-1.0, -0.0001]), (7, [float("inf"), 0.0]), (8, []), (10, []), (9, [1e300, 1.0]), (20, [5.0]), (30, [0.0, 0.0]), (40, [1.0, 1.0]), (41, [1.0, 1.0]),
]


def test_search_of_odd_rows(spark):
    assert searched(spark, ODD_VECTORS, 10) == plain_search(ODD_VECTORS, 10, 10)
    assert searched(spark, [], 10) == []
    clashing = spark.createDataFrame([(*r, 1, 2, 3) for r in ODD_VECTORS], "vec_id long, embedding array<double>, shard int, rank int, VEC_ID int")
    assert sorted(map(tuple, vs.top_k(clashing, "vec_id", "embedding", 10).collect()), key=str) == plain_search(ODD_VECTORS, 10, 10)


@pytest.mark.parametrize("spread", [1.0, 3000.0])
def test_search_against_plain_sums(spark, monkeypatch, spread):
    """Ties, a vector that a third of all rows repeat, uneven components; large ones leave single precision."""
    rng = np.random.default_rng(4)
    vectors = np.round(rng.normal(size=(900, 19)) * rng.exponential(size=19), 2) * spread
    rows = [(i, vectors[i % 600 if i < 600 else 0].tolist()) for i in range(900)]
    monkeypatch.setattr(vs, "LEAST", 50)
    assert searched(spark, rows, 50, shard=200) == plain_search(rows, 50, 10)


def test_bounds_drop_candidates_and_lose_none():
    rng = np.random.default_rng(5)
    codes = (rng.normal(size=(20_000, 64)) * np.r_[np.full(8, 200), np.full(56, 5)]).astype("<i4")
    shard, read = vs.Shard(np.arange(len(codes)), codes), []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            got = super().__getitem__(at)
            if isinstance(at, tuple) and isinstance(at[1], np.ndarray):
                read.append(got.shape[-1])
            return got

    shard.columns = shard.columns.view(Counted)
    ids, scores = shard.best(7, codes[7], 10)
    want = codes.astype(np.int64) @ codes[7].astype(np.int64)
    want[7] = -(1 << 62)
    assert list(ids) == list(np.argsort(-want, kind="stable")[:10]) and list(scores) == list(want[ids])
    # After the heaviest block few are left in the later slices.
    assert min(read) < 500


# --- codes ----------------------------------------------------------------------------------


def plain_codes(rows, entries=16, rounds=6):
    kept = [(i, np.floor(4096 * np.array(v, np.float64)).astype(np.int64), label) for i, v, label in rows if v and usable(v, 4096)]
    dim = len(min((r for r in kept if r[0] is not None), key=lambda r: r[0])[1])
    firsts = {}
    for i, v, _ in sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1].astype("<i4").tobytes())):
        firsts.setdefault(i, v)
    books = [list(part) for part in zip(*(v.reshape(8, -1) for i, v in sorted(firsts.items())[:entries] if len(v) == dim))]
    same = [r for r in kept if len(r[1]) == dim]

    def nearest(part, v):
        distances = [int(((v - e) ** 2).sum()) for e in books[part]]
        return distances.index(min(distances)), min(distances)

    for _ in range(rounds):
        for part in range(8):
            groups = {}
            for _, v, _ in same:
                groups.setdefault(nearest(part, v.reshape(8, -1)[part])[0], []).append(v.reshape(8, -1)[part])
            for e, vs_ in groups.items():
                books[part][e] = np.sum(vs_, axis=0) // len(vs_)
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    coded = []
    for i, v, label in kept:
        found = [nearest(p, x) for p, x in enumerate(v.reshape(8, -1))] if len(v) == dim else None
        coded.append((i, label, "".join(f"{e:02x}" for e, _ in found) if found else None, sum(d for _, d in found) if found else None))
    totals = {}
    for _, label, _, error in coded:
        if error is not None:
            totals[label] = totals.get(label, 0) + error
    return sorted(((i, code, error, totals.get(label), digest) for i, label, code, error in coded), key=str)


def compressed(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return sorted(map(tuple, vc.compress(df, "vec_id", "embedding", "label", **more).collect()), key=str)


def test_codes_of_odd_rows(spark):
    rows = [
        (0, [1.0] * 8, 1), (0, [1.0] * 8, 1), (0, [2.0] * 8, None), (1, [1.0, 1.0], 2), (2, None, 3), (3, [float("nan")] * 8, 3), (4, [None] * 8, 2),
        (None, [0.5] * 8, None), (100, [], 2), (200, [1e300] * 8, 1), (6, [-1.0, -0.0001] * 4, 1),
    ]
    assert compressed(spark, rows) == plain_codes(rows)
    assert compressed(spark, []) == []
    assert [r[1:4] for r in compressed(spark, [(None, [1.0] * 8, 1)])] == [(None, None, None)]
    with pytest.raises(ValueError, match="equal parts"):
        compressed(spark, [(1, [1.0] * 9, 1)])
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, row int, CODE int")
    assert sorted(map(tuple, vc.compress(df, "vec_id", "embedding", "label").collect()), key=str) == plain_codes(rows)


def test_codes_against_plain_rounds(spark):
    """Ties (whole numbers on a grid), entries that start equal, a vector that a third of all rows repeat."""
    rng = np.random.default_rng(6)
    vectors = rng.integers(-3, 4, size=(600, 24)) / 8
    vectors[5] = vectors[3]
    rows = [(i, vectors[i if i < 400 else 0].tolist(), int(i % 3) if i % 5 else None) for i in range(600)]
    assert compressed(spark, rows) == plain_codes(rows)


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_each_cell_once_and_moves_one_step(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims))).T
    places = vc.curve_position(cells, bits)
    assert sorted(places) == list(range(cells.shape[1]))
    assert set(np.abs(np.diff(cells[:, np.argsort(places)], axis=1)).sum(axis=0)) == {1}


def test_shortlists_hold_each_nearest_entry_and_leave_some_blocks_one():
    rng = np.random.default_rng(7)
    entries = rng.integers(-500, 500, size=(16, 4))
    points = rng.integers(-600, 600, size=(4000, 4))
    blocks = points[np.argsort(vc.curve_position((points + 600).T >> 3, 8))].reshape(-1, 4, 4)
    able = vc.shortlists(blocks.min(axis=1), blocks.max(axis=1), entries)
    nearest = ((blocks[:, :, None, :] - entries) ** 2).sum(axis=3).argmin(axis=2)
    assert np.take_along_axis(able, nearest, axis=1).all()
    assert (able.sum(axis=1) == 1).mean() > 0.2 and able.mean() < 0.3
