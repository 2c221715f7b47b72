"""Near-duplicates, vectors and decontamination against brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from cairnlake.llm import decontamination as dec, minhash as mh, vector_links as vl
from cairnlake.llm.common import components
from cairnlake.llm.words import slices
from tests.llm.conftest import ODD, TEXT_SCHEMA


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def groups(ids, links):
    """Least id reachable of each position."""
    label = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    out = []
    for i in range(len(ids)):
        members = [ids[j] for j in range(len(ids)) if label[j] == label[i] and ids[j] is not None]
        out.append(min(members) if members else None)
    return out


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    names = groups([i for i, _ in rows], links)
    names = [n if s else i for (i, _), s, n in zip(rows, sets, names)]
    return sorted((str(i), len(s), str(n), i is None or i == n) for (i, _), s, n in zip(rows, sets, names))


def copies(seed, n):
    """Bases with chains of edits, so that links and near misses lie on both sides of the threshold."""
    rng = random.Random(seed)
    rows = []
    passage = [f"p{k}" for k in range(60)]
    for base in range(n):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(3, 150))] + passage * (base % 2)
        for _ in range(rng.randint(1, 12)):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
    return rows


def found(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in mh.near_duplicates(df, "doc_id", "text").collect())


def test_near_duplicates_of_odd_rows(odd, clashing, empty):
    assert found(odd) == brute(ODD)
    assert found(clashing) == brute(ODD)
    assert found(empty) == []


def test_near_duplicates_against_brute_force(spark):
    rows = copies(1, 60)
    assert found(spark.createDataFrame(rows, TEXT_SCHEMA)) == brute(rows)


def test_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(mh, "BLOCK", 3)
    rows = copies(2, 25)
    assert found(spark.createDataFrame(rows, TEXT_SCHEMA)) == brute(rows)


def near_copies(seed, n):
    """One text with one to three words exchanged: some pairs link, more do not, nearly all meet in buckets."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{k}" for k in range(100)]
        for k in rng.sample(range(100), rng.randint(1, 3)):
            words[k] = f"e{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("block", [1024, 8])
def test_joins_by_node_make_a_row_a_class(spark, monkeypatch, block):
    """However many buckets and cells the near copies of a group share."""
    monkeypatch.setattr(mh, "BLOCK", block)
    rows = near_copies(4, 120)
    df, joined = spark.createDataFrame(rows, TEXT_SCHEMA), []
    join = type(df).join

    def noted(self, other, on=None, how=None):
        out = join(self, other, on, how)
        if isinstance(on, str) and on == "node" and how is None:
            joined.append(out)
        return out

    with monkeypatch.context() as patched:
        patched.setattr(type(df), "join", noted)
        got = found(df)
    assert got == brute(rows) and len({g[2] for g in got}) > 10
    assert len(joined) >= 2 and max(j.count() for j in joined) <= len(rows)


def test_buckets_of_two_are_settled_by_their_hub(spark, monkeypatch):
    """Pairs that meet but do not link leave no bucket open."""
    rows = []
    for base in range(20):
        words = [f"b{base}w{k}" for k in range(100)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(f"x{k}" if k in (20, 40, 60, 80) else w for k, w in enumerate(words)))]
    opened = []
    crossing_links = mh.crossing_links

    def noted(members, df, classes):
        opened.append(members.count())
        return crossing_links(members, df, classes)

    monkeypatch.setattr(mh, "crossing_links", noted)
    assert found(spark.createDataFrame(rows, TEXT_SCHEMA)) == brute(rows) and not opened


def test_cells_hold_each_crossing_pair_once(spark, monkeypatch):
    """A bucket's largest component is not copied once for every block of itself."""
    monkeypatch.setattr(mh, "BLOCK", 4)
    shapes = {1: [200, 2, 1], 2: [3, 1], 3: [6] * 5, 4: [9, 9, 9, 1, 1, 1, 1, 1, 1], 5: [1, 4]}
    members = []
    for key, sizes in shapes.items():
        nodes = iter(range(10_000))
        members += [(key, next(nodes) * 7919 + key, c, sum(sizes), sizes.index(max(sizes)), max(sizes)) for c, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame(members, "key long, node long, component long, size long, main long, n_main long")
    cells = {}
    for r in mh.cells_of(df).collect():
        assert r.block in (r.i, r.j)
        cells.setdefault((r.key, r.i, r.j), []).append(r)
    met = Counter()
    for (key, i, j), rows in cells.items():
        for a, b in combinations(rows, 2):
            if a.component != b.component and (i == j or a.block != b.block):
                met[key, *sorted((a.node, b.node))] += 1
    want = {(a[0], *sorted((a[1], b[1]))) for a, b in combinations(members, 2) if a[0] == b[0] and a[2] != b[2]}
    assert set(met) == want and set(met.values()) == {1}
    assert sum(len(rows) for (key, _, _), rows in cells.items() if key == 1) <= 200 + 3 * (50 + 1)


def test_slices_change_nothing(spark, monkeypatch):
    """Documents of one batch that is read in many slices."""
    monkeypatch.setattr(mh, "slices", lambda batches, *_: slices(batches, 30))
    rows = copies(3, 25)
    df = spark.createDataFrame(rows, TEXT_SCHEMA).coalesce(1)
    assert found(df) == brute(rows)
    assert sorted(r.doc_id for r in mh.one_of_each_group(df, "doc_id", "text").collect()) == sorted(int(i) for i, _, _, kept in brute(rows) if kept)


def test_pigeonhole_lets_no_near_pair_slip():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, (300, mh.SYMBOLS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(mh.SYMBOLS, mh.FARTHEST, replace=False)] ^= 1
    keys_a, keys_b = mh.chunk_keys(a), mh.chunk_keys(b)
    assert (keys_a == keys_b).any(1).all()


def test_one_of_each_group_stays(clashing):
    kept = mh.one_of_each_group(clashing, "doc_id", "text")
    assert kept.columns == clashing.columns
    ids = sorted(str(r[0]) for r in kept.collect())
    assert ids == sorted(["1", "2", "3", "4", "6", "None", "None", "8", "9", "10", "11"])


def test_one_of_each_group_whatever_the_ids(spark):
    """Unlinked texts under one id all stay; of a group with NULL or equal ids one document does."""
    one, other, third = (" ".join(f"{w}{k}" for k in range(60)) for w in "abc")
    rows = [(1, one), (1, other), (1, one), (None, third), (None, third + " end"), (None, third), (None, None), (None, None), (2, ""), (2, "")]
    rows += [(7, "x " + one.replace("a", "d")), (7, one.replace("a", "d"))]
    kept = [tuple(r) for r in mh.one_of_each_group(spark.createDataFrame(rows, TEXT_SCHEMA), "doc_id", "text").collect()]
    assert sorted((str(i), str(t)[:1]) for i, t in kept if i != 7) == [("1", "a"), ("1", "b"), ("2", ""), ("None", "N"), ("None", "c")]
    assert sum(i == 7 for i, _ in kept) == 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 199), (1, 0)]
    nodes = sorted({x for e in edges for x in e} | {500})
    got = components(spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "a long, b long"), "test")
    want = dict(zip(nodes, groups(nodes, [(nodes.index(a), nodes.index(b)) for a, b in edges])))
    assert {r.node: r.component for r in got.collect()} == want


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(60):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((base + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.35])).tolist())
    hot = rng.normal(size=16)
    rows += [(hot + rng.normal(size=16) * s).tolist() for s in [0.05] * 60 + [0.4] * 40]
    rows += [hot.tolist()] * 5 + [(hot * 1e200).tolist(), (hot * 1e-200).tolist()]
    odd = [None, [], [0.0] * 16, [1.0, None] + [0.0] * 14, [float("nan")] * 16, [float("inf")] + [0.0] * 15, hot[:8].tolist(), hot[:8].tolist()]
    return [(i, v) for i, v in enumerate([*rows, *odd])] + [(None, hot.tolist()), (0, rows[0])]


def brute_links(rows):
    units = []
    for _, v in rows:
        ok = v and None not in v and np.isfinite(v).all() and np.any(v)
        x = np.array(v) / np.abs(v).max() if ok else None
        units.append(x / np.sqrt(x @ x) if ok else None)
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.9]
    degree = [0] * len(rows)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    names = groups([i for i, _ in rows], links)
    return sorted((str(i), d, str(n), i is None or i == n) for (i, _), d, n in zip(rows, degree, names))


@pytest.mark.parametrize("leaf,block", [(256, 1024), (32, 16)])
def test_vector_links(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(vl, "LEAF", leaf)
    monkeypatch.setattr(vl, "BLOCK", block)
    rows = vectors(4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as node", "2 as id", "3 as unit")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in vl.vector_links(df, "vec_id", "embedding").collect())
    assert got == brute_links(rows)


@pytest.mark.parametrize("leaf,block", [(256, 1024), (8, 16)])
def test_tight_groups_that_link_crosswise(spark, monkeypatch, leaf, block):
    """Neighbour lists are full of the own group, yet all pairs of both groups are links."""
    monkeypatch.setattr(vl, "LEAF", leaf)
    monkeypatch.setattr(vl, "BLOCK", block)
    rng = np.random.default_rng(5)
    a, b = np.linalg.qr(rng.normal(size=(64, 2)))[0].T
    centres = a, 0.93 * a + np.sqrt(1 - 0.93**2) * b
    rows = [(50 * g + i, (c + rng.normal(size=64) * 0.001).tolist()) for g, c in enumerate(centres) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in vl.vector_links(df, "vec_id", "embedding").collect())
    assert got == brute_links(rows) and {g[1] for g in got} == {99}


def test_trees_grow_with_the_table():
    """Of pairs at the threshold at least 99 % share a leaf, whatever the number of leaves."""
    rng = np.random.default_rng(6)
    for bits in (0, 3, 8):
        x, y = rng.normal(size=(2, 1000, 32))
        x /= np.linalg.norm(x, axis=1)[:, None]
        y -= (x * y).sum(1)[:, None] * x
        y = 0.9 * x + np.sqrt(1 - 0.9**2) * y / np.linalg.norm(y, axis=1)[:, None]
        met = np.zeros(1000, bool)
        for _ in range(vl.trees_for(bits)):
            planes = rng.normal(size=(32, bits))
            met |= ((x @ planes > 0) == (y @ planes > 0)).all(1)
        assert met.mean() >= 0.985


def test_audit_counts_each_class_alike(spark):
    """A hot pair's links do not hide that those of nine small pairs are missing."""
    rows = []
    for pair in range(10):
        for k in range(2):
            unit = np.zeros(32)
            unit[2 * pair], unit[2 * pair + 1] = 1.0, 0.1 * k
            unit /= np.linalg.norm(unit)
            rows.append((2 * pair + k, 32, bytearray(unit.astype("<f8").tobytes()), 1_000_000 if pair == 0 else 1))
    classes = spark.createDataFrame(rows, "node long, dim int, unit binary, copies long")
    links = spark.createDataFrame([(0, 1_000_000), (1, 1_000_000)], "node long, links long")
    assert vl.audit(classes, links, 3) == pytest.approx(0.1)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vl.vector_links(df, "vec_id", "embedding").count() == 0


ITEMS = [
    (1, "In March Anna bought 12 kg of apples and Anna sold 5 kg of them to Boris at the old market near the river."),
    (2, "A plain question without any slot that asks about seven things in a row and then some more of them."),
    (3, None), (4, ""), (5, "Too short"), (6, "1 2 3 4 5 6 7 8 9 10"), (7, "Four words in here"), (2, "A plain question without any slot that asks about seven things in a row and then some more of them."),
]
HOLDERS = [
    (10, "Some words. In March Clara bought 99 lb of apples and Clara sold 1 lb of them to Dora at the old market near the river. More."),
    # The buyer and the seller differ: slots face two values.
    (11, "In March Clara bought 99 lb of apples and Emil sold 1 lb of them to Dora at the old market near the river."),
    (12, "before it a plain question, without any slot that asks about seven things in a row and then some more of them"),
    (13, "four words in here"), (14, "nothing of the kind is in this text although the old market is near the river"), (15, None), (16, ""), (None, ITEMS[1][1]), (17, "11 12 13 14 15 16 17 18 19 20"),
]


def test_templates(spark):
    docs = spark.createDataFrame(HOLDERS, TEXT_SCHEMA).selectExpr("*", "1 as hash", "2 as key", "3 as item_id")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.share for r in dec.find_items(docs, "doc_id", "text", items, "item_id", "text").collect()}
    assert set(got) == {(10, 1), (12, 2), (13, 7), (None, 2)}
    assert got[10, 1] == got[12, 2] == 1.0
    kept = dec.without_items(docs, "doc_id", "text", items, "item_id", "text")
    assert kept.columns == docs.columns and sorted(str(r[0]) for r in kept.collect()) == ["11", "14", "15", "16", "17"]


LOST = [
    (1, "In March Anna bought 12 kg of apples and later on Anna sold them all at the old market near the river."),
    (2, "She had 5 apples and 5 pears in total"), (3, "What is 12 + 5 * 3 - 7?"), (4, "Name it"), (5, "1 2 3 4 5 6 7 8 9 10"),
    (6, "At first Anna met nobody else and Anna left; " + " ".join(f"then came word{i}" for i in range(30))),
]
COPIES = [
    (1, 1, LOST[0][1].replace("on Anna", "on Clara")), (2, 1, LOST[0][1].replace("March Anna", "March Clara")),
    (3, 2, "so she had 7 apples and 9 pears in total"), (4, 3, "before. What is 12 + 5 * 3 - 7? After"), (5, 4, "please name it now, name it"),
    (6, 5, "count 1 2 3 4 5 6 7 8 9 10 now"), (7, 6, LOST[5][1].replace("first Anna", "first Clara").replace("and Anna", "and Dora")),
    (8, None, "What is 13 + 5 * 3 - 7?"), (9, None, "name that it is"),
]


def test_copies_with_conflicts_and_of_slot_heavy_items(spark):
    docs = spark.createDataFrame([(i, t) for i, _, t in COPIES], TEXT_SCHEMA)
    items = spark.createDataFrame(LOST, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dec.find_items(docs, "doc_id", "text", items, "item_id", "text").collect()}
    assert got == {(i, k) for i, k, _ in COPIES if k}


def test_templates_of_odd_rows(odd, clashing, empty):
    items = odd.selectExpr("doc_id as item_id", "text").filter("item_id = 9 or item_id = 5 or item_id is null")
    for df in (odd, clashing):
        got = {(r.doc_id, r.item_id) for r in dec.find_items(df, "doc_id", "text", items, "item_id", "text").collect()}
        assert got == {(4, 5), (5, 5), (9, 9), (None, None)}
    assert dec.find_items(empty, "doc_id", "text", items, "item_id", "text").count() == 0
    assert dec.without_items(odd, "doc_id", "text", empty.toDF("item_id", "text"), "item_id", "text").count() == len(ODD)


def test_whole_items_against_plain_search():
    """On the small tables, items found are those whose words stand in the document."""
    import pyarrow.parquet as pq

    words = lambda t: [re.sub(r"^\W+|\W+$", "", w).lower() for w in t.split()]
    folder = "/root/testdata/sf0.001"
    items = [" ".join(w for w in words(t) if w) for t in pq.read_table(f"{folder}/benchmark.parquet").column("text").to_pylist()]
    docs = pq.read_table(f"{folder}/documents.parquet").column("text").to_pylist()
    windows = {}
    for i, t in enumerate(dec.Templates([t])for t in items):
        for length in range(dec.SHORTEST, dec.WINDOW + 1):
            for _, _, h in zip(*t.windows(length, only_whole=length < dec.WINDOW)):
                windows.setdefault(int(h), set()).add(i)
    hold = {k for k, t in enumerate(docs) if any(f" {i} " in f" {' '.join(w for w in words(t) if w)} " for i in items)}
    assert hold
    for k in hold:
        t = dec.Templates([docs[k]])
        assert any(int(h) in windows for _, _, h in zip(*t.windows(dec.WINDOW, only_whole=False)))
