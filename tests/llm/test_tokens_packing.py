"""Token counts and packing against the library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from cairnlake.llm.packing import Packer, pack
from cairnlake.llm.token_counts import count_tokens, spliced_count
from cairnlake.llm.vocabulary import Vocabulary, tokenizer_path
from tests.llm.conftest import ODD

BITS = ["the", "of", "<|endoftext|>", "<|endo", " ", "  ", "\n", "\t", " ", "é", "日本", "123", "...", "'s", "don't", "\x1c", "a" * 300, "🙂", "x̂", "Σ", "\x85", "  \n "]
FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")


def texts(seed, n, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(1, longest))) for _ in range(n)]


@pytest.mark.parametrize("name", FILES)
def test_memo_gives_the_librarys_ids(name):
    vocabulary = Vocabulary(tokenizer_path(name))
    library = Tokenizer.from_file(tokenizer_path(name))
    some = [*texts(1, 300, 80), "", None, "plain words, and  more."]
    ids, offsets = vocabulary.encode_all(some)
    for text, a, b in zip(some, offsets, offsets[1:]):
        assert ids[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (100, 30), (300, 64)])
def test_spliced_chunks_equal_the_whole(chunk, overlap):
    vocabulary = Vocabulary(tokenizer_path(FILES[0]))
    widened = 0
    for text in texts(chunk, 200, 300):
        n, _, w = spliced_count(vocabulary, text, chunk, overlap)
        widened += w
        assert n == len(vocabulary.library.encode(text, add_special_tokens=False).ids)
    assert widened  # runs of 300 letters have no boundary in the overlap


def test_counts_of_odd_rows(odd, clashing, empty):
    library = Tokenizer.from_file(tokenizer_path(FILES[0]))
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ODD)
    for df in (odd, clashing):
        got = count_tokens(df, "doc_id", "text", tokenizer_path(FILES[0]), chunk_chars=5000)
        assert got.columns[:4] == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert sorted((str(r[0]), r[1], r[2]) for r in got.collect()) == want
    assert count_tokens(empty, "doc_id", "text", tokenizer_path(FILES[0])).count() == 0


def check_packing(rows, want, window):
    """Each id in one piece, sequences gapless, padding none."""
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.sequence_id].append(r)
    for some in pieces.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window and (at == window or at & (at - 1) == 0)
    parts = defaultdict(list)
    for r in rows:
        parts[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    expected = defaultdict(int)
    for key, ids in want:
        expected[key, len(ids)] += 1
    assert set(parts) == set(expected)
    for (key, n), some in parts.items():
        covered = np.zeros(n, int)
        for start, length, crc in some:
            covered[start : start + length] += 1
            assert crc in {zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()) for k, ids in want if k == key and len(ids) == n}
        assert (covered == expected[key, n]).all()


def test_packing_of_odd_rows(spark, odd, clashing, empty):
    library = Tokenizer.from_file(tokenizer_path(FILES[1]))
    want = [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in ODD]
    for df in (odd, clashing.coalesce(1)):
        for open_windows in (4096, 2):
            check_packing(pack(df, "doc_id", "text", tokenizer_path(FILES[1]), open_windows=open_windows).collect(), want, 2048)
    assert pack(empty, "doc_id", "text", tokenizer_path(FILES[1])).count() == 0


def test_piece_goes_where_squares_grow_least():
    rng = np.random.default_rng(0)
    packer = Packer(16, 0, 1000)
    for k in range(300):
        before = packer.levels.copy()
        size = int(rng.integers(1, 16))
        options = {}
        for h in range(0, 17 - size):
            if h and not before[h]:
                continue
            after = before.copy()
            after[h] -= h > 0
            after[h + size] += h + size < 16
            options[h] = int((after**2).sum())
        packer.add(k, np.arange(size, dtype="<u4"))
        assert int((packer.levels**2).sum()) == min(options.values())
        assert [len(level) for level in packer.at] == packer.levels[:16].tolist()
