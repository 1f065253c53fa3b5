"""Prefix trie of conversations from vertical bitmaps.

A shard holds some thousand conversations. It indexes (position, turn) to the bitset of the conversations
that have this turn there. From the root down, a node's bitset is intersected with the postings of the turns
that its members have next: each intersection is a child, its popcount the child's members in the shard, and
members without a next turn end at the node. Shards are merged by the digest of a node's turns, so a prefix
that a third of all conversations share costs one row a shard.

Sums over subtrees need no walk over levels. The smallest member of a node represents it, so the nodes that
a conversation represents are a chain down to its end, and each childless node has one representative. A second
pass over the shards intersects each node's bitset with the bitset of those representatives (leaves) and with the
bit planes of the chains' weights (saved tokens): both are sums of popcounts, added up over shards.

Scale. Texts are reduced to a digest and a word count on the scan; only these are shuffled, once, by groups of 20 ids,
where rebuilding needs them. Long conversations are cut into segments, so a shard's size is bounded by turns, not
conversations. End lists are sorted by range, joined in parts of bounded size, and streamed through the hash.
The turns of one conversation are numbered in one task as a stream, never held together.

Defined results. Null roles and texts are empty; null turns come first, equal turns are ordered by the digest of
role and text. Repeated rows are turns of their own. Rows without a conv_id belong to no conversation and are left out.
A table without conversations has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofmill.llm.common import stored
from proofmill.session import ship_code

#: Conversations that share the head of the smallest id among them.
GROUP = 20
#: A head is shorter than this.
HEADS = 4
#: Turns of one segment, segments and turns of one shard, ids of one part of an end list.
SEGMENT, SHARD, SHARD_TURNS, PART = 512, 4096, 65_536, 4096
ROOT = bytes(16)

_SEGMENTS = "conv_id long, depth long, node binary, turns binary, words array<long>, last boolean"


def turn_digest(role: str = "role", text: str = "text") -> Column:
    """16 bytes that tell a turn's role and text apart from all others."""
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def step(node: bytes, turn: bytes) -> bytes:
    """The digest of a node's child."""
    return hashlib.md5(node + turn, usedforsecurity=False).digest()


class _Writer:
    """Collects the segments of rebuilt conversations."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.conv = None

    def open(self, conv: int, heads: list[tuple[bytes, int]]) -> None:
        self.conv, self.depth, self.node, self.turns = conv, 0, ROOT, list(heads)

    def add(self, turn: tuple[bytes, int]) -> None:
        if len(self.turns) >= SEGMENT:
            self._cut(last=False)
        self.turns.append(turn)

    def close(self) -> None:
        if self.conv is not None:
            self._cut(last=True)

    def _cut(self, last: bool) -> None:
        self.rows.append((self.conv, self.depth, self.node, b"".join(t for t, _ in self.turns), [w for _, w in self.turns], last))
        if not last:
            for turn, _ in self.turns:
                self.node = step(self.node, turn)
            self.depth, self.turns = self.depth + len(self.turns), []

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.bool_()]
        self.rows = []
        names = ["conv_id", "depth", "node", "turns", "words", "last"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def rebuild(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Segments of every rebuilt conversation: the first h turns of the group's first one, then its own after its first h."""
    ship_code(conversations.sparkSession)
    conv = F.col("conv_id").cast("long")
    base = conv - conv % group
    rows = conversations.where("conv_id IS NOT NULL").select(
        conv.alias("conv"), base.alias("base"), F.col("turn").alias("turn"), turn_digest().alias("digest"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        (F.crc32(conv.cast("string").cast("binary")) % heads).cast("int").alias("head"),
    )
    # The group's first conversation comes before the others.
    rows = rows.repartition("base").sortWithinPartitions("base", F.col("conv") != F.col("base"), "conv", F.asc_nulls_first("turn"), "digest")

    def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, shared, own = _Writer(), None, [], 0
        for batch in batches:
            for conv, base, digest, words, head in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if base != at:
                    at, shared = base, []
                if conv != out.conv:
                    out.close()
                    out.open(conv, [] if conv == base else shared[:head])
                    own = 0
                own += 1
                if conv == base and own < heads:
                    shared.append((digest, words))
                if conv == base or own > head:
                    out.add((digest, words))
            yield out.take()
        out.close()
        yield out.take()

    return rows.select("conv", "base", "digest", "words", "head").mapInArrow(splice, _SEGMENTS)


class Shard:
    """Segments of conversations, ascending by id, and their vertical index."""

    def __init__(self, rows: list[dict]) -> None:
        self.rows = sorted(rows, key=lambda r: (r["conv_id"], r["depth"]))
        self.starts: dict[tuple[int, bytes], int] = {}
        self.postings: dict[tuple[int, bytes], int] = {}
        for i, r in enumerate(self.rows):
            bit, turns, depth = 1 << i, r["turns"], r["depth"]
            start = (depth, r["node"])
            self.starts[start] = self.starts.get(start, 0) | bit
            for k in range(0, len(turns), 16):
                posting = (depth + k // 16, turns[k : k + 16])
                self.postings[posting] = self.postings.get(posting, 0) | bit

    def nodes(self, alone_from: bool = False) -> Iterator[tuple[int, bytes, bytes | None, int, int, list[int]]]:
        """(depth, node, parent, words, members as a bitset, conversations that end here), depth first.

        With ``alone_from``, nodes that hold one conversation of all are left out: a segment says from which depth on.
        """
        for (start, digest), members in self.starts.items():
            # The node that a later segment starts from is a member's last node of the segment before.
            stack = [(start, digest, None, 0, members, start == 0)]
            while stack:
                depth, node, parent, words, bits, new = stack.pop()
                ends, left = [], bits
                while left:
                    i = (left & -left).bit_length() - 1
                    r = self.rows[i]
                    k = depth - start
                    if 16 * k >= len(r["turns"]):
                        left ^= 1 << i
                        if r["last"]:
                            ends.append(r["conv_id"])
                        continue
                    turn = r["turns"][16 * k : 16 * k + 16]
                    child = left & self.postings[depth, turn]
                    left ^= child
                    if not (alone_from and r["alone_from"] is not None and depth + 1 >= r["alone_from"]):
                        stack.append((depth + 1, step(node, turn), node, r["words"][k], child, True))
                if new:
                    yield depth, node, parent, words, bits, ends


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    rows, turns = [], 0
    for batch in batches:
        for r in batch.to_pylist():
            rows.append(r)
            turns += len(r["words"]) + 1
            if len(rows) >= SHARD or turns >= SHARD_TURNS:
                yield Shard(rows)
                rows, turns = [], 0
    if rows:
        yield Shard(rows)


def _shard_nodes(segments: DataFrame) -> DataFrame:
    """One row per node and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            found = [
                (node, parent, depth, words, shard.rows[(bits & -bits).bit_length() - 1]["conv_id"], bits.bit_count(), ends)
                for depth, node, parent, words, bits, ends in shard.nodes()
            ]
            kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["node", "parent", "depth", "words", "conv_id", "n_convs", "ends"]
            columns = zip(*found, strict=True) if found else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    kinds = "node binary, parent binary, depth long, words long, conv_id long, n_convs long, ends array<long>"
    return segments.mapInArrow(run, kinds)


def _subtree_sums(segments: DataFrame) -> DataFrame:
    """(node, leaves, weights) per shard: members that represent a childless node, and the weights of members' chains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            leaves, planes = 0, []
            for i, r in enumerate(shard.rows):
                leaves |= (r["leaf"] or 0) << i
                weight, b = r["weight"] or 0, 0
                while weight >> b:
                    if b == len(planes):
                        planes.append(0)
                    planes[b] |= (weight >> b & 1) << i
                    b += 1
            found = [
                (node, (bits & leaves).bit_count(), sum((bits & plane).bit_count() << b for b, plane in enumerate(planes)))
                for _, node, _, _, bits, _ in shard.nodes(alone_from=True)
            ]
            columns = zip(*found, strict=True) if found else [[]] * 3
            kinds = [pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["node", "leaves", "weights"])

    return segments.mapInArrow(run, "node binary, leaves long, weights long")


def _end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from rows (node, conv_id): ids ascending, joined by commas, hashed as a stream."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []
        for batch in batches:
            for n, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n != node or len(ids) >= PART:
                    if ids:
                        out.append((node, ids[0], ",".join(map(str, ids))))
                    node, ids = n, []
                ids.append(conv)
            yield _batch(out)
            out = []
        if ids:
            yield _batch([(node, ids[0], ",".join(map(str, ids)))])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        kinds = [pa.binary(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["node", "first", "part"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * 2
            arrays = [pa.array(c, k) for c, k in zip(columns, [pa.binary(), pa.string()], strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["node", "ends_sha256"])

        for batch in batches:
            out = []
            for n, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if n != node:
                    if state is not None:
                        out.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(part.encode())
                else:
                    state.update(b"," + part.encode())
            yield made(out)
        if state is not None:
            yield made([(node, state.hexdigest())])

    cut = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(parts, "node binary, first long, part string")
    return cut.repartition("node").sortWithinPartitions("node", "first").mapInArrow(stream, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    segments = stored(rebuild(conversations, group, heads), "trie-segments")
    partial = stored(_shard_nodes(segments), "trie-shards")
    nodes = partial.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.max("words").alias("words"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
    )
    nodes = stored(nodes, "trie-nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    weight = (F.col("n_convs") - 1) * F.col("words")
    chain = Window.partitionBy("conv_id").orderBy("depth")
    known = nodes.join(children, "node", "left").withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0)).cast("long"), "weight": weight,
            "above": F.coalesce(F.sum(weight).over(chain.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    )
    known = stored(known, "trie-known")
    chains = known.groupBy("conv_id").agg(
        F.sum("weight").alias("weight"), F.min(F.when(F.col("n_convs") == 1, F.col("depth"))).alias("alone_from"),
        F.max((F.col("n_children") == 0).cast("long")).alias("leaf"),
    )
    sums = _subtree_sums(segments.join(chains, "conv_id", "left")).groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("weights").alias("weights"))
    ends = partial.select("node", F.explode("ends").alias("conv_id"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # A node of one conversation has one leaf below and nothing to save; it has no sums.
    return (
        known.join(sums, "node", "left")
        .join(_end_digests(ends), "node", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
            F.coalesce(F.col("weights") - F.col("above"), F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


#: CRC-32 of a decimal number, bit by bit: the register after each byte's exclusive or and its eight shifts.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({c}::VARCHAR, ''), lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
    "lambda r, b: CASE WHEN b >= 0 THEN xor(r, b) WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END), 4294967295::BIGINT)"
)

ORACLE = rf"""
WITH own AS (
    SELECT conv_id::BIGINT AS c, conv_id - conv_id % 20 AS base, turn,
           md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS digest,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS pos FROM own),
ids AS (SELECT DISTINCT c, base, {_CRC.format(c='c')} % 4 AS h FROM own),
turns AS (
    SELECT i.c, n.pos, n.digest, n.words FROM ids i JOIN numbered n ON n.c = i.base WHERE n.pos <= i.h
    UNION ALL SELECT i.c, n.pos, n.digest, n.words FROM ids i JOIN numbered n ON n.c = i.c WHERE n.pos > i.h),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY pos) AS d FROM turns),
members AS (
    SELECT c, d, words, string_agg(digest, '') OVER (PARTITION BY c ORDER BY d) AS node,
           coalesce(string_agg(digest, '') OVER (PARTITION BY c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS parent
    FROM placed
    UNION ALL SELECT c, 0, 0, '', NULL FROM ids),
nodes AS (SELECT node, any_value(parent) AS parent, any_value(d) AS d, any_value(words) AS words, min(c) AS c, count(*) AS n FROM members GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS k FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
    SELECT m.node, count(*) FILTER (WHERE k.k IS NULL) AS leaves, sum((x.n - 1) * x.words) AS saved
    FROM nodes x JOIN members m ON m.c = x.c AND m.d <= x.d LEFT JOIN kids k ON k.node = x.node GROUP BY m.node),
lasts AS (SELECT c, max(d) AS d FROM members GROUP BY c),
ends AS (SELECT m.node, sha256(string_agg(m.c::VARCHAR, ',' ORDER BY m.c)) AS sha FROM members m JOIN lasts l ON l.c = m.c AND l.d = m.d GROUP BY m.node)
SELECT x.c AS conv_id, x.d AS depth, p.c AS parent_conv_id, x.n AS n_convs, coalesce(k.k, 0) AS n_children, b.leaves AS n_leaves,
       b.saved::BIGINT AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes x LEFT JOIN kids k ON k.node = x.node LEFT JOIN nodes p ON p.node = x.parent JOIN below b ON b.node = x.node LEFT JOIN ends e ON e.node = x.node
"""
