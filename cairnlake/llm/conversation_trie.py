"""Prefix trie of conversations, built as a z-fast trie: compacted nodes hashed at two-fattest depths.

A conversation is known by the hashes of its prefixes, one for each number of turns. A compacted node
covers depths (top, depth] of one conversation; its handle is the depth in that interval that the highest
power of two divides. Fat binary search finds where a conversation leaves the trie with a number of look-ups
that grows with the logarithm of its turns.

A first batch of conversations makes an upper trie. All others locate their exit in it, within the tasks that
hold them; those that leave at the same place with the same next turn are inserted, as the second
batch, into a trie of their own. Upper and lower tries are rolled up and their edges expanded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cairnlake.llm.common import fold, pick, table, written

#: Bytes of a hash, of a turn's characters, and the hash of no turns.
HASH, CHARS, ROOT = 16, 4, b"\0" * 16
#: Conversations of the first batch and of later ones; turns of them kept beyond where their group leaves the
#: upper trie; bytes of a batch.
FIRST, MORE, TURNS, BATCH_BYTES = 1000, 5000, 256, 32 << 20
#: Different conversations that one lower trie may hold; beyond it, further ones go into the upper trie first.
GROUP = 20_000

_NODES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
_NODE_SCHEMA = ", ".join(f"{c} long" for c in _NODES) + ", ends_sha256 string"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def key_at(path: bytes, depth: int) -> bytes:
    """The hash of a path's first ``depth`` turns."""
    return path[HASH * (depth - 1) : HASH * depth] if depth else ROOT


def fattest(low: int, high: int) -> int:
    """The number in (low, high] that the highest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Node:
    """Depths (top, depth] of ``path``."""

    __slots__ = ("top", "depth", "path", "chars", "parent", "children", "levels")

    def __init__(self, top: int, depth: int, path: bytes, chars: memoryview | None, parent: "Node | None"):
        self.top, self.depth, self.path, self.chars, self.parent = top, depth, path, chars, parent
        self.children: dict[bytes, Node] = {}
        self.levels: list[tuple] = []


class ZFastTrie:
    """Conversations below the node ``key`` at ``depth``; the root node itself belongs to it only if depth is 0."""

    def __init__(self, depth: int = 0, key: bytes = ROOT):
        self.key = key
        self.root = Node(-1 if depth == 0 else depth, depth, b"", None, None)
        self.handles: dict[bytes, Node] = {}
        #: What was inserted, in order: tasks build the upper trie anew from it.
        self.batch: list[tuple[bytes, int]] = []

    def locate(self, path: bytes, turns: int) -> tuple[Node, int]:
        """The exit node and how many turns of the path the trie holds."""
        node = self.root
        low, high = node.depth, turns
        while low < high:
            middle = fattest(low, high)
            found = self.handles.get(key_at(path, middle))
            if found is None:
                high = middle - 1
            elif found.depth <= turns and key_at(path, found.depth) == key_at(found.path, found.depth):
                node, low = found, found.depth
            else:
                return found, self._common(path, turns, found)
        if node.depth < turns:
            # The handle of the next node may lie deeper than the path goes along its edge.
            child = node.children.get(key_at(path, node.depth + 1))
            if child is not None:
                return child, self._common(path, turns, child)
        return node, node.depth

    @staticmethod
    def _common(path: bytes, turns: int, node: Node) -> int:
        low, high = node.top + 1, min(node.depth, turns)
        while low < high:
            middle = (low + high + 1) // 2
            if key_at(path, middle) == key_at(node.path, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def _hash(self, node: Node) -> None:
        self.handles[key_at(node.path, fattest(node.top, node.depth))] = node

    def insert(self, path: bytes, turns: int, chars: memoryview | None) -> None:
        self.batch.append((path, turns))
        node, depth = self.locate(path, turns)
        if depth < node.depth:
            # The upper half of the edge becomes a node of its own.
            upper = Node(node.top, depth, node.path, node.chars, node.parent)
            node.parent.children[key_at(node.path, node.top + 1)] = upper
            upper.children[key_at(node.path, depth + 1)] = node
            del self.handles[key_at(node.path, fattest(node.top, node.depth))]
            node.top, node.parent = depth, upper
            self._hash(upper)
            self._hash(node)
            node = upper
        if depth < turns:
            leaf = Node(depth, turns, path, chars, node)
            node.children[key_at(path, depth + 1)] = leaf
            self._hash(leaf)

    def expand(self, ends: dict[bytes, tuple[int, int, str]], below: dict[bytes, tuple] | None = None) -> Iterator[tuple]:
        """Every node of the edges: _NODES, the digest of its ends, its hash; top nodes first.

        ends: by hash, how many conversations end there, the smallest of them, the digest; below: by hash, how many
        further tries hang there, and their conversations, smallest conversation, leaves and savings.
        """
        below = below or {}
        order = [self.root]
        for node in order:
            order.extend(node.children.values())
        for node in reversed(order):
            n = leaves = saved = 0
            first, children, levels = None, len(node.children), []
            for child in node.children.values():
                _, low, m, _, more, less, _, _ = child.levels[-1]
                n, leaves, saved, first = n + m, leaves + more, saved + less, low if first is None else min(first, low)
            for depth in range(node.depth, node.top, -1):
                key, digest = key_at(node.path, depth), NO_ENDS
                if (end := ends.get(key)) is not None:
                    n, first, digest = n + end[0], end[1] if first is None else min(first, end[1]), end[2]
                if (hung := below.get(key)) is not None:
                    tries, m, low, more, less = hung
                    children, n, leaves, saved = children + tries, n + m, leaves + more, saved + less
                    first = low if first is None else min(first, low)
                if not children:
                    leaves = 1
                saved += (n - 1) * node.chars[depth - 1] if depth else 0
                levels.append((depth, first, n, children, leaves, saved, digest, key))
                children = 1
            node.levels = levels
        for node in order:
            parent = node.parent.levels[0][1] if node.parent is not None and node.parent.levels else None
            for depth, first, n, children, leaves, saved, digest, key in reversed(node.levels):
                yield first, depth, parent, n, children, leaves, saved, digest, key
                parent = first


def turn_rows(df: DataFrame) -> DataFrame:
    """``conv``, ``own`` (true), ``place``, ``turn_hash``, ``chars``, ``skip`` (0) of each turn; from here on no text is moved."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return df.filter("conv IS NOT NULL").select(
        F.col("conv").cast("long").alias("conv"), F.lit(True).alias("own"), F.col("turn").cast("long").alias("place"),
        F.substring(F.unhex(F.sha2(told, 256)), 1, HASH).alias("turn_hash"), F.length(text).alias("chars"), F.lit(0).alias("skip"),
    )


def rebuilt(turns: DataFrame, width: int = 100, most: int = 5) -> DataFrame:
    """Turn rows with the first turns of each conversation taken from the first one of its hundred.

    Of these at most ``most`` turns are wanted, so a window limit leaves as many of a long one before the shuffle.
    """
    in_order = Window.partitionBy("conv").orderBy(F.col("place").asc_nulls_first(), "turn_hash")
    heads = turns.filter(F.col("conv") % width == 0).withColumn("n", F.row_number().over(in_order)).filter(F.col("n") <= most)
    heads = heads.select(F.col("conv").alias("head"), "n", "turn_hash", "chars")
    ids = turns.select("conv").distinct().withColumn("skip", fold("conv", most + 1).cast("int"))
    asking = ids.filter("skip > 0").withColumn("head", F.col("conv") - F.col("conv") % width)
    taken = asking.join(heads, "head").filter(F.col("n") <= F.col("skip")).select("conv", F.lit(False).alias("own"), F.col("n").cast("long").alias("place"), "turn_hash", "chars", "skip")
    return turns.withColumn("skip", fold("conv", most + 1).cast("int")).unionByName(taken)


def packed(turns: DataFrame) -> DataFrame:
    """``conv``, ``turns``, ``key`` (hash of all turns), ``path`` (hashes of all prefixes), ``chars`` of each conversation.

    The rows of a conversation stream past in order; of each turn 20 bytes are kept. Own turns with a place up to
    ``skip`` are left out; the others follow the taken ones.
    """
    placed = turns.repartition("conv").sortWithinPartitions("conv", "own", F.col("place").asc_nulls_first(), "turn_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        conv, path, chars, seen, last = None, bytearray(), bytearray(), 0, ROOT

        def row() -> tuple:
            return conv, len(path) // HASH, last, bytes(path), bytes(chars)

        for batch in batches:
            for c, own, turn_hash, n, skip in zip(*(batch.column(x).to_pylist() for x in ("conv", "own", "turn_hash", "chars", "skip"))):
                if c != conv:
                    if conv is not None:
                        out.append(row())
                        size += len(path)
                    conv, path, chars, seen, last = c, bytearray(), bytearray(), 0, ROOT
                    if len(out) >= 2000 or size > 8 << 20:
                        yield _packed(out)
                        out, size = [], 0
                seen += own
                if not own or seen > skip:
                    last = hashlib.blake2b(last + turn_hash, digest_size=HASH).digest()
                    path += last
                    chars += n.to_bytes(CHARS, "little")
        if conv is not None:
            out.append(row())
        yield _packed(out)

    return written(placed.mapInArrow(run, "conv long, turns int, key binary, path binary, chars binary"), "trie-packed")


def _packed(out: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()
    columns = list(zip(*out)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv", "turns", "key", "path", "chars"])


def endings(paths: DataFrame) -> DataFrame:
    """``key``, ``n_ends``, ``conv`` (the smallest), ``digest`` of the conversations with the same turns.

    Their ids stream past in order, so a sequence that very many share needs no more memory than another.
    """
    ids = paths.select("key", "conv").repartition("key").sortWithinPartitions("key", "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, first, digest = None, 0, None, None
        for batch in batches:
            out = []
            for k, conv in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist()):
                if k != key:
                    if key is not None:
                        out.append((key, n, first, digest.hexdigest()))
                    key, n, first, digest = k, 1, conv, hashlib.sha256(str(conv).encode())
                else:
                    n += 1
                    digest.update(f",{conv}".encode())
            yield _ended(out)
        if key is not None:
            yield _ended([(key, n, first, digest.hexdigest())])

    return ids.mapInArrow(run, "key binary, n_ends long, conv long, digest string")


def _ended(out: list[tuple]) -> pa.RecordBatch:
    kinds = pa.binary(), pa.int64(), pa.int64(), pa.string()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 4, kinds)], names=["key", "n_ends", "conv", "digest"])


def exits(paths: DataFrame, upper: ZFastTrie) -> DataFrame:
    """``conv``, ``key``, ``depth`` and ``at`` (where it leaves the upper trie), ``group`` (hash with the next turn; NULL if it ends there)."""
    shared = paths.sparkSession.sparkContext.broadcast(upper.batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ZFastTrie()
        for path, turns in shared.value:
            trie.insert(path, turns, None)
        for batch in batches:
            turns, paths = batch.column("turns").to_pylist(), batch.column("path").to_pylist()
            depths = [trie.locate(p, n)[1] for n, p in zip(turns, paths)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv"), batch.column("key"), pa.array(depths, pa.int32()),
                    pa.array([key_at(p, d) for p, d in zip(paths, depths)], pa.binary()),
                    pa.array([key_at(p, d + 1) if d < n else None for p, d, n in zip(paths, depths, turns)], pa.binary()),
                ],
                names=["conv", "key", "depth", "at", "group"],
            )

    return paths.select("conv", "key", "turns", "path").mapInArrow(run, "conv long, key binary, depth int, at binary, group binary")


def _insert_batch(upper: ZFastTrie, paths: DataFrame, count: int, turns: int) -> None:
    """The given conversations' first ``turns`` turns into the upper trie; at most ``count`` of them, by hash."""
    some = paths.orderBy(F.xxhash64("key"), "key").limit(count)
    for r in some.select(F.least("turns", F.lit(turns)).alias("turns"), F.substring("path", 1, HASH * turns).alias("path"), F.substring("chars", 1, CHARS * turns).alias("chars")).collect():
        upper.insert(bytes(r["path"]), r["turns"], memoryview(bytes(r["chars"])).cast("i"))


def lower_tries(rows: DataFrame) -> DataFrame:
    """The nodes of each group's trie; a group's first one has the hash of its parent as ``at``.

    rows: conversations with their exits, sorted by group within their partition.
    """

    def finished(trie: ZFastTrie, ends: dict, out: list[tuple]) -> None:
        for i, (*node, _) in enumerate(trie.expand(ends)):
            out.append((*node, trie.key if i == 0 else None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, trie, ends, out = None, None, {}, []
        for batch in batches:
            names = ("group", "depth", "at", "turns", "key", "path", "chars", "n_ends", "conv", "digest")
            for g, depth, at, turns, key, path, chars, n, conv, digest in zip(*(batch.column(c).to_pylist() for c in names)):
                if g != group:
                    if trie is not None:
                        finished(trie, ends, out)
                    group, trie, ends = g, ZFastTrie(depth, at), {}
                    # The root of a lower trie is a node of the upper one.
                    trie.root.top = depth
                    if len(out) >= 10_000:
                        yield _nodes(out)
                        out = []
                trie.insert(path, turns, memoryview(chars).cast("i"))
                ends[key] = n, conv, digest
        if trie is not None:
            finished(trie, ends, out)
        yield _nodes(out)

    return written(rows.mapInArrow(run, f"{_NODE_SCHEMA}, at binary"), "trie-lower")


def _nodes(out: list[tuple]) -> pa.RecordBatch:
    kinds = *[pa.int64()] * len(_NODES), pa.string(), pa.binary()
    columns = list(zip(*out)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_NODES, "ends_sha256", "at"])


def trie_nodes(turns: DataFrame) -> DataFrame:
    """All nodes of the trie of the given turn rows."""
    spark = turns.sparkSession
    paths = packed(turns)
    ends = endings(paths)
    # One conversation stands for all with the same turns.
    whole = written(paths.join(ends.drop("key"), "conv"), "trie-paths")
    if whole.isEmpty():
        return spark.createDataFrame([], _NODE_SCHEMA)
    upper = ZFastTrie()
    _insert_batch(upper, whole, FIRST, TURNS)
    while True:
        placed = written(exits(whole, upper), "trie-exits")
        large = written(placed.filter("group IS NOT NULL").groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("depth")).filter(F.col("n") > GROUP), "trie-large")
        deepest = large.agg(F.max("depth")).first()[0]
        if deepest is None:
            break
        # Groups beyond the limit are few: at most one in GROUP conversations.
        inside = whole.join(placed.join(large.select("group"), "group").select("conv"), "conv", "left_semi")
        turns_kept = deepest + TURNS
        _insert_batch(upper, inside, max(16, min(MORE, BATCH_BYTES // ((HASH + CHARS) * turns_kept))), turns_kept)
    members = whole.join(placed.select("conv", "depth", "at", "group"), "conv")
    lower = lower_tries(members.filter("group IS NOT NULL").repartition("group").sortWithinPartitions("group"))

    # Both are no more than the upper trie has nodes, whose batches are bounded.
    ended = members.filter("group IS NULL").select("at", "n_ends", "conv", "digest").collect()
    hung = lower.filter("at IS NOT NULL").groupBy("at").agg(
        F.count(F.lit(1)).alias("tries"), F.sum("n_convs").alias("n"), F.min("conv_id").alias("first"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    rows = upper.expand(
        {bytes(r["at"]): (r["n_ends"], r["conv"], r["digest"]) for r in ended},
        {bytes(r["at"]): (r["tries"], r["n"], r["first"], r["leaves"], r["saved"]) for r in hung.collect()},
    )
    schema = f"{_NODE_SCHEMA}, hash binary"
    top = written(spark.createDataFrame(pa.Table.from_batches([_nodes(list(rows))]).rename_columns([*_NODES, "ends_sha256", "hash"]), schema), "trie-upper")
    parents = top.select(F.col("hash").alias("at"), F.col("conv_id").alias("parent"))
    joined = lower.join(parents, "at", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent"))
    return top.drop("hash").unionByName(joined.select(*_NODES, "ends_sha256"))


def conversation_trie(df: DataFrame, conv_column: str, turn_column: str, role_column: str, text_column: str, rebuild: bool = False) -> DataFrame:
    """The trie of all conversations: a node for each different sequence of first turns (role and text).

    Turns are ordered by number, NULL first; of turns with one number, and of repeated rows, each counts, in the
    order of a hash of role and text. A NULL role or text is empty. Rows without conversation belong
    to none. An empty table has no node, else the root (depth 0) holds all conversations.

    Returns per node ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved_tokens`` of its subtree (for each node, the members but one times the
    characters of its last text), ``ends_sha256`` (of the ids, ascending and comma-joined, of conversations that end
    there). Further columns are ignored. Sequences are compared by 128-bit hashes.

    ``rebuild``: the first crc32(id) % 6 turns of a conversation come from the first one of its hundred.

    Texts are hashed where they are read. A task holds the upper trie, one group's trie of at most GROUP
    different conversations, and 20 bytes a turn of each of them.
    """
    rows = turn_rows(pick(df, conv=conv_column, turn=turn_column, role=role_column, text=text_column))
    return trie_nodes(rebuilt(rows) if rebuild else rows)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", rebuild=True)


OP11_SQL = """
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n
        FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (
        SELECT conv_id, xor(4294967295, list_reduce(
            list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
            lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, bit: xor(v >> 1, 3988292384 * (v & 1))))) % 6 AS h
        FROM (SELECT DISTINCT conv_id FROM turns)),
    built AS (
        SELECT i.conv_id, 0 AS own, t.n, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 100 AND t.n <= i.h
        UNION ALL SELECT i.conv_id, 1, t.n, t.role, t.text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.n > i.h),
    prefixes AS (
        SELECT conv_id, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY own, n) AS prefix FROM built
        UNION ALL SELECT conv_id, [] FROM ids),
    lasts AS (SELECT conv_id, max(len(prefix)) AS turns FROM prefixes GROUP BY conv_id),
    nodes AS (
        SELECT prefix, len(prefix) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (turns = len(prefix)), '') AS ends
        FROM prefixes JOIN lasts USING (conv_id) GROUP BY prefix),
    sized AS (
        SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[1:n.depth] = n.prefix) AS n_children
        FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]),
    above AS (SELECT s.*, unnest(range(0, depth + 1)) AS up FROM sized s),
    summed AS (
        SELECT prefix[1:up] AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
               sum(CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(prefix[depth].text) END) AS saved_tokens
        FROM above GROUP BY 1)
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
    FROM sized JOIN summed USING (prefix)"""
