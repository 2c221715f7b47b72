"""Benchmark decontamination by typed templates with consistent slots."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cairnlake.llm.common import pick, small_side, table, written
from cairnlake.llm.memo import held
from cairnlake.llm.words import slices, split_words

#: Tokens of a template window; an item of at least SHORTEST tokens but fewer than this is one window.
WINDOW, SHORTEST = 8, 4
#: A document holds an item if it has at least this share of the item's windows.
LEAST_SHARE = 0.3
#: An alignment in which names change their parts needs so many of the item's windows without these names.
PARTED_SHARE = 0.5
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs oz ounce ounces pound pounds"
    " ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days"
    " week weeks month months year years cent cents dollar dollars euro euros usd eur gbp percent % degree degrees"
    " mph kmh km/h w kw kwh v".split()
)
NUMBER = re.compile(r"[+-]?(?:\d[\d.,]*|\.\d+)(?:e[+-]?\d+)?%?|\d+/\d+")
#: Bits of either half of the filter; its size is fixed whatever the benchmark's.
FILTER_BITS = 22
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MEMO_ENTRIES = 150_000
# What a word is on its own; sentence ends and neighbours decide the rest.
_DROPPED, _ENDS, _NUMBER, _CAPITAL, _UNIT = 1, 2, 4, 8, 16


def _hash(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")


_SLOT_HASH = {k: np.uint64(_hash(b"\x00" + k)) for k in (b"number", b"unit", b"name")}


def core(word: bytes) -> str:
    """The word without the signs around it."""
    text = word.decode()
    a, b = 0, len(text)
    while a < b and not text[a].isalnum():
        a += 1
    while b > a and not (text[b - 1].isalnum() or text[b - 1] == "%"):
        b -= 1
    return text[a:b]


def _kind(word: bytes) -> tuple[int, int]:
    text = core(word)
    flags = _ENDS if word.rstrip(b"\"')]}*")[-1:] in (b".", b"!", b"?", b":") else 0
    if not text:
        return 0, flags | _DROPPED
    low = text.lower()
    if NUMBER.fullmatch(low):
        flags |= _NUMBER
    elif low in UNITS:
        flags |= _UNIT
    if text[0].isupper():
        flags |= _CAPITAL
    return _hash(low.encode()), flags


class Templates:
    """Canonical tokens of many texts: ``hashes``, whether a ``slot``, the word's number, and text sizes."""

    def __init__(self, texts: list[str | None] | pa.Array):
        self.words, codes, sizes = split_words(texts, lower=False)
        memo: dict[bytes, tuple[int, int]] = held("templates", dict)
        if len(memo) > _MEMO_ENTRIES:
            memo.clear()
        for w in self.words:
            if w not in memo:
                memo[w] = _kind(w)
        literal = np.array([memo[w][0] for w in self.words], np.uint64)
        flags = np.array([memo[w][1] for w in self.words], np.int64)[codes]
        owner = np.repeat(np.arange(len(texts)), sizes)
        first = np.ones(len(codes), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (flags[:-1] & _ENDS > 0)
        kept = flags & _DROPPED == 0
        self.codes, owner, flags, first = codes[kept], owner[kept], flags[kept], first[kept]
        self.sizes = np.bincount(owner, minlength=len(texts))
        self.first = np.cumsum(self.sizes) - self.sizes
        number = flags & _NUMBER > 0
        after_number = np.zeros(len(owner), bool)
        after_number[1:] = number[:-1] & (owner[1:] == owner[:-1])
        unit = (flags & _UNIT > 0) & after_number
        name = (flags & _CAPITAL > 0) & ~first & ~number & ~unit
        self.slot = number | unit | name
        self.literals = literal[self.codes] if len(self.codes) else np.empty(0, np.uint64)
        self.hashes = self.literals
        for where, kind in ((number, b"number"), (unit, b"unit"), (name, b"name")):
            self.hashes = np.where(where, _SLOT_HASH[kind], self.hashes)

    def windows(self, length: int, only_whole: bool, literal: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place in the text and hash of each window at least half of which is literal.

        only_whole: just texts of exactly this length. literal: any window, by its words as they are.
        """
        n = len(self.hashes) - length + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        hashes = self.literals if literal else self.hashes
        total = np.full(n, (length + 64 * literal) * int(_PRIME) & (1 << 64) - 1, np.uint64)
        for k in range(length):
            total = (total ^ hashes[k : k + n]) * _PRIME
            total ^= total >> np.uint64(29)
        usable = owner[:n] == owner[length - 1 :]
        if not literal:
            slots = np.concatenate(([0], np.cumsum(self.slot)))
            usable &= (slots[length:] - slots[:-length])[:n] * 2 <= length
        if only_whole:
            usable &= self.sizes[owner[:n]] == length
        at = np.flatnonzero(usable)
        return owner[at], at - self.first[owner[at]], total[at]

    def slot_values(self, text: int, place: int, length: int) -> list[str]:
        at = int(self.first[text]) + place
        return [core(self.words[self.codes[i]]).lower() for i in range(at, at + length) if self.slot[i]]

_WINDOW_SCHEMA = "item_id {item}, n_windows long, length int, literal boolean, item_place int, hash long, item_slots array<string>"


def item_windows(benchmark: DataFrame, item_column: str, text_column: str, window: int) -> DataFrame:
    """Template windows of every benchmark item; literal ones of items that have none of these."""
    rows = pick(benchmark, item_id=item_column, text=text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = Templates(batch.column("text").to_pylist())
            ids = batch.column("item_id").to_pylist()
            columns: list[list] = [[] for _ in range(7)]
            covered = np.zeros(len(ids), bool)
            for literal in (False, True):
                for length in range(1 if literal else SHORTEST, window + 1):
                    text, place, hashes = t.windows(length, length < window, literal)
                    if literal:
                        new = ~covered[text]
                        text, place, hashes = text[new], place[new], hashes[new]
                    count = np.bincount(text, minlength=len(ids))
                    for i, p, h in zip(text, place, hashes):
                        slots = [] if literal else t.slot_values(i, int(p), length)
                        for c, v in zip(columns, (ids[i], int(count[i]), length, literal, int(p), int(h.astype(np.int64)), slots)):
                            c.append(v)
                    if not literal:
                        covered |= count > 0
            types = (batch.schema.field("item_id").type, pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=["item_id", "n_windows", "length", "literal", "item_place", "hash", "item_slots"])

    return rows.mapInArrow(run, _WINDOW_SCHEMA.format(item=rows.schema["item_id"].dataType.simpleString())).distinct()


def _bitmap(windows: DataFrame, shift: int) -> np.ndarray:
    """Which values FILTER_BITS bits of the hashes take: at most 2 ** FILTER_BITS rows are fetched."""
    mask = (1 << FILTER_BITS) - 1
    found = windows.select(F.shiftrightunsigned("hash", shift).bitwiseAND(mask).cast("int").alias("v")).distinct().toArrow()
    out = np.zeros(1 << FILTER_BITS, bool)
    out[found.column("v").to_numpy()] = True
    return out


def document_key(id_column: str, text_column: str):
    """Rows with equal id and text share a key."""
    return F.xxhash64(F.col(id_column), F.col(text_column))


def find_items(
    df: DataFrame, id_column: str, text_column: str, benchmark: DataFrame, item_column: str, item_text_column: str,
    window: int = WINDOW, least_share: float = LEAST_SHARE,
) -> DataFrame:
    """Documents and the benchmark items they hold, also with other numbers, names and units.

    Words become lower-cased tokens without the signs around them; numbers, units behind numbers,
    and capitalised words inside a sentence become typed placeholders. Windows of ``window``
    tokens, at least half of them literal, are joined by hash. Equal numbers and units of the item
    may face different values. A name of the item that faces several names of the document, none
    of them itself, has changed its part: then windows with it do not count, and the others only
    if they are PARTED_SHARE of the item's. The document holds the item if ``least_share`` of the
    item's windows count. An item without such windows, short or mostly of placeholders, is
    looked for by its words as they are, in windows of the same length.

    A filter of fixed size lets only windows of the documents through that may be the benchmark's,
    so those alone are shuffled. The matches are summed by position before the last count.

    Returns ``key`` (see document_key), the id, ``item_id``, ``n_windows`` (found) and ``share``, one row
    for each pair. NULL or empty texts and items match nothing; NULL ids are kept as such; repeated rows of documents give one
    pair, repeated items count once; empty tables give no pair; further columns are ignored.
    """
    windows = written(item_windows(benchmark, item_column, item_text_column, window), "item-windows")
    lengths = sorted((r.length, r.literal) for r in windows.select("length", "literal").distinct().collect())
    rows = pick(df, id=id_column, text=text_column)
    high, low = _bitmap(windows, 64 - FILTER_BITS), _bitmap(windows, 64 - 2 * FILTER_BITS)
    sent = df.sparkSession.sparkContext.broadcast((np.packbits(high), np.packbits(low)))
    id_type = rows.schema["id"].dataType.simpleString()
    rows = rows.select("id", "text", document_key("id", "text").alias("key"))
    mask = np.uint64((1 << FILTER_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = (np.unpackbits(x).view(bool) for x in sent.value)
        for batch in slices(batches, 1000):
            t = Templates(batch.column("text"))
            for length, literal in lengths:
                text, place, hashes = t.windows(length, False, literal)
                hit = high[hashes >> np.uint64(64 - FILTER_BITS)]
                text, place, hashes = text[hit], place[hit], hashes[hit]
                hit = low[(hashes >> np.uint64(64 - 2 * FILTER_BITS)) & mask]
                text, place, hashes = text[hit], place[hit], hashes[hit]
                if literal and len(text):
                    # One of equal windows of a text will do, as they have no slots to compare.
                    once = np.unique(np.stack((text.astype(np.uint64), hashes)), axis=1, return_index=True)[1]
                    text, place, hashes = text[once], place[once], hashes[once]
                for at in range(0, len(text), 10_000):
                    some = slice(at, at + 10_000)
                    chosen = pa.array(text[some])
                    slots = [[] if literal else t.slot_values(i, int(p), length) for i, p in zip(text[some], place[some])]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(chosen), batch.column("key").take(chosen), pa.array(place[some].astype(np.int32)), pa.array(hashes[some].view(np.int64)), pa.array(slots, pa.list_(pa.string()))],
                        names=["id", "key", "place", "hash", "slots"],
                    )

    hits = rows.mapInArrow(run, f"id {id_type}, key long, place int, hash long, slots array<string>")
    pairs = hits.join(windows, "hash").withColumn("pairs", F.expr("transform(item_slots, (x, i) -> struct(x as item, slots[i] as document))"))
    aligned = pairs.groupBy("key", "id", "item_id", "n_windows", (F.col("place") - F.col("item_place")).alias("shift")).agg(
        F.collect_set(F.struct("item_place", "item_slots")).alias("windows"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
    )
    units = F.array(*[F.lit(u) for u in sorted(UNITS)])
    aligned = aligned.withColumn("names", F.filter("pairs", lambda p: ~p["item"].rlike("^\\p{Nd}") & ~F.array_contains(units, p["item"])))
    aligned = aligned.withColumn("parted", F.expr("filter(array_distinct(names.item), v -> size(filter(names, p -> p.item = v)) > 1 and not exists(names, p -> p.item = v and p.document = v))"))
    aligned = aligned.withColumn("places", F.expr("transform(filter(windows, w -> not arrays_overlap(w.item_slots, parted)), w -> w.item_place)"))
    counted = aligned.filter((F.size("parted") == 0) | (F.size("places") >= PARTED_SHARE * F.col("n_windows")))
    found = counted.select("key", "id", "item_id", "n_windows", F.explode("places").alias("place")).distinct()
    return (
        found.groupBy("key", "id", "item_id", F.col("n_windows").alias("all_windows"))
        .agg(F.count("*").alias("n_windows"))
        .withColumn("share", F.col("n_windows") / F.col("all_windows"))
        .filter(F.col("share") >= least_share)
        .select("key", F.col("id").alias(id_column), "item_id", "n_windows", "share")
    )


def without_items(df: DataFrame, id_column: str, text_column: str, benchmark: DataFrame, item_column: str, item_text_column: str) -> DataFrame:
    """``df`` without the documents that hold an item; all its columns stay."""
    held = written(find_items(df, id_column, text_column, benchmark, item_column, item_text_column).select("key").distinct(), "contaminated")
    named = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    key = document_key(f"_c{df.columns.index(id_column)}", f"_c{df.columns.index(text_column)}")
    return named.join(small_side(held), key == held.key, "left_anti").toDF(*df.columns)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items it holds."""
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    held = find_items(documents, "doc_id", "text", benchmark, "item_id", "text")
    held = written(held.groupBy("key").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"), F.max("share").alias("share")), "held")
    rows = documents.select("doc_id", document_key("doc_id", "text").alias("key"))
    return rows.join(small_side(held), "key", "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"), F.greatest(F.coalesce(F.size("item_ids"), F.lit(0)), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), F.coalesce("share", F.lit(0.0)).alias("best_share"),
    )
