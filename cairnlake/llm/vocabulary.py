"""Public tokenizers as per-process objects, with bounded memos of encoded words.

A pre-token of both vocabularies never runs from a non-blank into a following blank, nor from a
letter into a following ASCII non-letter: their split patterns take blanks only at the front and
end a run of letters at anything else. So a text may be cut at such places, the parts encode on
their own and the results concatenate. Parts repeat, so most of them come from a memo; new
ones go through the library, many of them in one text with a special token between any two.

ASCII blanks are the only cuts between words. Texts with any other white space, or with a special
token's string, are left to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cairnlake.llm.memo import held

_BLANK = r" \t\n\r\x0b\x0c"
#: Letters in front of an ASCII non-letter, or a run of non-blanks, or the blanks that end a text;
#: each with the blanks in front of it.
PART = re.compile(rf"[{_BLANK}]*[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[\x00-@\[-`{{-\x7f]|\Z)|[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+")
#: A space that does not follow a non-blank: splitting at spaces would part what belongs together.
LOOSE_SPACE = re.compile(rf"(?:\A|[{_BLANK}]) ")
#: White space in Unicode's or Python's sense that is not an ASCII blank.
ODD_BLANK = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
#: Arrow's regular expressions know no look-ahead: what follows a word's first letters is taken along.
HEAD = r"(?s)^(?P<head>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[\x00-@\[-`{-\x7f].*)?$"
#: Parts in each half of the memo, at about 200 bytes each; longer parts are encoded but not kept.
MEMO_ENTRIES, MEMO_CHARS = 150_000, 64
#: New parts that go through the library as one text.
JOINED = 512


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def open_vocabulary(path: str) -> "Vocabulary":
    """One per worker process and file; workers are reused, so the memo lives on."""
    return held(("vocabulary", path), lambda: Vocabulary(path))


class Vocabulary:
    """ids as the library gives them, without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.guard = max([16, *(2 * len(s) for s in self.specials)])
        # A special token's string is always cut out of a text, so it can stand between parts.
        plain = [t for t in self.library.get_added_tokens_decoder().items() if not (t[1].lstrip or t[1].rstrip or t[1].single_word or t[1].normalized)]
        self.border, self.border_id = (plain[0][1].content, plain[0][0]) if plain else ("", -1)
        self.forget()

    def forget(self) -> None:
        """Drop the memo: parts seen lately, and those seen before them."""
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def plain(self, text: str) -> bool:
        """Whether cutting in front of blanks is proven for this text."""
        return not any(s in text for s in self.specials) and ODD_BLANK.search(text) is None

    def _library_ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of each part, many of them at a time as one text with borders."""
        if not self.border:
            return [np.array(c.ids, "<u4").tobytes() for c in self.library.encode_batch_fast(parts, add_special_tokens=False)]
        out: list[bytes] = []
        joined = [self.border.join(parts[at : at + JOINED]) for at in range(0, len(parts), JOINED)]
        for at in range(0, len(joined), 16):
            for code in self.library.encode_batch_fast(joined[at : at + 16], add_special_tokens=False):
                ids = np.array(code.ids, "<u4")
                borders = np.flatnonzero(ids == self.border_id)
                raw, ends = ids.tobytes(), [*(4 * borders).tolist(), 4 * len(ids)]
                out += [raw[a:b] for a, b in zip([0, *(4 * borders + 4).tolist()], ends)]
        return out

    def learn(self, parts: list[str]) -> list[bytes]:
        """Ids of each part. The memo's young half becomes the old one when full, so frequent parts stay."""
        young, old = self.young, self.old
        out = list(map(young.get, parts))
        missing = [i for i, ids in enumerate(out) if ids is None]
        if not missing:
            return out
        new: dict[str, bytes | None] = {}
        for i in missing:
            part = parts[i]
            if part not in new:
                new[part] = old.get(part)
        unknown = [p for p, ids in new.items() if ids is None]
        new.update(zip(unknown, self._encode_parts(unknown)))
        if len(young) + len(new) > MEMO_ENTRIES:
            self.old, self.young = young, {}
        room = MEMO_ENTRIES - len(self.young)
        kept = new if len(new) <= room else {p: new[p] for p in list(new)[:room]}
        self.young.update((p, ids) for p, ids in kept.items() if len(p) <= MEMO_CHARS)
        for i in missing:
            out[i] = new[parts[i]]
        return out

    def encode(self, text: str) -> bytes:
        """All ids of one text as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if not self.plain(text):
            return self._library_ids(text)
        return b"".join(self.learn(PART.findall(text)))

    def encode_all(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and where each text's begin (one entry more than texts).

        Texts are split at spaces, and their words into first letters and the rest, outside
        Python, so that Python sees each distinct one of the batch once.
        """
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        column = pc.fill_null(column.cast(pa.large_string()), "")
        hard = pc.or_(pc.match_substring_regex(column, LOOSE_SPACE.pattern), pc.match_substring_regex(column, ODD_BLANK.pattern))
        for special in self.specials:
            hard = pc.or_(hard, pc.match_substring(column, special))
        full = pc.greater(pc.binary_length(column), 0)
        easy = np.flatnonzero(pc.and_not(full, hard).to_numpy(zero_copy_only=False))
        rest = {int(i): np.frombuffer(self.encode(column[int(i)].as_py()), "<u4") for i in np.flatnonzero(pc.and_(full, hard).to_numpy(zero_copy_only=False))}
        sizes = np.zeros(len(column), np.int64)
        for i, ids in rest.items():
            sizes[i] = len(ids)
        ids = np.empty(0, "<u4")
        if len(easy):
            split = pc.split_pattern(column.take(pa.array(easy)), " ")
            first = split.offsets.to_numpy()[:-1]
            coded = split.values.dictionary_encode()
            words, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            # Every word but a text's first has a space in front.
            starters = [PART.findall(w) for w in _strings(words.take(pa.array(codes[first])))]
            codes[first] = len(words) + np.arange(len(starters))
            pool, lengths = self._words(words)
            alone = self.learn([p for parts in starters for p in parts])
            counts = np.fromiter(map(len, alone), np.int64, len(alone)) >> 2
            owner = np.repeat(np.arange(len(starters)), [len(parts) for parts in starters])
            lengths = np.concatenate((lengths, np.bincount(owner, counts, len(starters)).astype(np.int64)))
            pool = np.concatenate((pool, np.frombuffer(b"".join(alone), "<u4")))
            ids, ends = _gather(pool, lengths, codes)
            sizes[easy] = np.diff(np.concatenate(([0], ends[np.append(first[1:], len(codes)) - 1])))
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        if not rest:
            return ids, offsets
        out, used = [], 0
        for i, n in enumerate(sizes):
            if i in rest:
                out.append(rest[i])
            else:
                out.append(ids[used : used + n])
                used += n
        return np.concatenate(out) if out else ids, offsets

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each with a space in front, end to end, and how many each has.

        A word of letters, or letters and an ASCII non-letter with what follows it, is two parts;
        any other word is cut by PART.
        """
        cut = pc.extract_regex(words, HEAD)
        heads = pc.fill_null(cut.field(0).filter(cut.is_valid()) if cut.null_count else cut.field(0), "").dictionary_encode()
        tails = pc.fill_null(cut.field(1).filter(cut.is_valid()) if cut.null_count else cut.field(1), "").dictionary_encode()
        whole = words.filter(cut.is_null())
        pieces = self.learn([" " + h for h in _strings(heads.dictionary)])
        behind = [PART.findall(t) for t in _strings(tails.dictionary)] + [PART.findall(" " + w) for w in _strings(whole)]
        found = iter(self.learn([p for parts in behind for p in parts]))
        pieces += [b"".join([next(found) for _ in parts]) for parts in behind]
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) >> 2
        pool = np.frombuffer(b"".join(pieces), "<u4")
        # Two pieces for each word: its head and its tail, or the whole word and nothing.
        at = np.full((len(words), 2), len(pieces), np.int64)
        cuts = cut.is_valid().to_numpy(zero_copy_only=False)
        at[cuts, 0] = heads.indices.to_numpy(zero_copy_only=False)
        at[cuts, 1] = len(heads.dictionary) + tails.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        at[~cuts, 0] = len(heads.dictionary) + len(tails.dictionary) + np.arange(len(whole))
        lengths = np.append(lengths, 0)
        return _gather(pool, lengths, at.ravel())[0], lengths[at].sum(axis=1)

    def boundaries(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of pre-token starts in ``text`` (not necessarily all) and the ids before each.

        The last entry is the text's end with the number of all its ids.
        """
        if self.plain(text):
            parts = PART.findall(text)
            starts = np.cumsum([0, *map(len, parts)])
            counts = np.cumsum([0, *(len(ids) >> 2 for ids in self.learn(parts))])
            return starts, counts
        code = self.library.encode(text, add_special_tokens=False)
        words, offsets = code.word_ids, code.offsets
        first = [i for i in range(len(offsets)) if i == 0 or words[i] is None or words[i] != words[i - 1] or offsets[i][0] < offsets[i - 1][0]]
        # A start that equals its forerunner's (one character in several ids) is no new boundary.
        kept = [i for j, i in enumerate(first) if j == 0 or offsets[i][0] > offsets[first[j - 1]][0]]
        return np.array([*(offsets[i][0] for i in kept), len(text)]), np.array([*kept, len(offsets)])


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _gather(pool: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``pool`` that ``codes`` names, end to end, and where each of them ends."""
    starts = np.cumsum(lengths) - lengths
    long = lengths[codes]
    ends = np.cumsum(long)
    at = np.repeat(starts[codes] - (ends - long), long)
    at += np.arange(len(at))
    return pool[at], ends
