"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases: each phrase is the longest one known so far and one more code point
(the incremental parse of Lempel and Ziv, 1978). The phrases that the text adds to its dictionary are its phrase set; their
hashes go through ``LANES`` permutations, and the smallest value of each, cut to 16 bits, is a lane of the fingerprint. The
share of equal lanes of two fingerprints estimates the Jaccard similarity of the phrase sets, which grows with how
well one text's dictionary compresses the other.

Edited texts. A document's edited text keeps its front half and goes on with the front of the next document in
descending doc_id. Both parses share the front: the dictionary is rolled back to the half and the minima are kept.

Scale. Documents are dealt by ranges of doc_id, so texts are shuffled once and a document's neighbour comes next in
its task's stream. Only each range's first and last document meet across ranges, by a join on the range's number. Phrases
of a text are hashed in blocks, so memory follows the longest text.

Defined results. Null texts are empty; an empty text has no phrases and all lanes at their largest value, so two empty texts
are alike and an empty one is unlike all others. Equal doc_ids are ordered by the hash of the text; null doc_ids come last.
Repeated rows are neighbours of each other. A single document is its own neighbour. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmill.llm.common import stored
from proofmill.session import ship_code

LANES = 128
#: Phrases that are hashed at once.
BLOCK = 4096

# Odd multipliers and offsets of the permutations, from a seeded generator.
_SEEDS = np.random.Generator(np.random.PCG64(20))
_MULTIPLY = _SEEDS.integers(0, 1 << 64, LANES, dtype=np.uint64) | np.uint64(1)
_ADD = _SEEDS.integers(0, 1 << 64, LANES, dtype=np.uint64)
_NONE = np.full(LANES, np.iinfo(np.uint64).max, np.uint64)


class Parse:
    """An incremental Lempel-Ziv parse that can be rolled back to a mark."""

    def __init__(self) -> None:
        self.root: dict = {}
        self.node, self.held = self.root, ""
        self.added: list[tuple[dict, str]] | None = None

    def phrases(self, text: str) -> list[str]:
        """The phrases that the text adds to the dictionary, in order."""
        root, node, added, out = self.root, self.node, self.added, []
        start, at, text = 0, len(self.held), self.held + text
        for c in text[at:] if at else text:
            at += 1
            known = node.get(c)
            if known is None:
                node[c] = {}
                out.append(text[start:at])
                if added is not None:
                    added.append((node, c))
                start, node = at, root
            else:
                node = known
        self.node, self.held = node, text[start:]
        return out

    def mark(self) -> None:
        self.added, self.kept = [], (self.node, self.held)

    def back(self) -> None:
        for node, c in self.added:
            del node[c]
        self.added, (self.node, self.held) = [], self.kept


def minima(phrases: list[str], low: np.ndarray = _NONE) -> np.ndarray:
    """The smallest permuted hash of each lane, over the phrases and ``low``."""
    for i in range(0, len(phrases), BLOCK):
        block = phrases[i : i + BLOCK]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, block), np.uint64, len(block))
        low = np.minimum(low, _mix(hashes[:, None] * _MULTIPLY + _ADD).min(axis=0))
    return low


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    return x


def lanes(low: np.ndarray) -> bytes:
    """The fingerprint: the low 16 bits of each lane, big-endian."""
    return (low & np.uint64(0xFFFF)).astype(">u2").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal lanes; texts without phrases are like each other only."""
    return float((np.frombuffer(a, ">u2") == np.frombuffer(b, ">u2")).mean())


def fingerprint(text: str) -> bytes:
    return lanes(minima(Parse().phrases(text)))


class _Open:
    """A document whose neighbour is not known yet."""

    def __init__(self, doc_id: int | None, text: str) -> None:
        self.doc_id, self.text = doc_id, text
        self.parse = Parse()
        self.cut = len(text) - len(text) // 2
        self.front = minima(self.parse.phrases(text[: self.cut]))
        self.parse.mark()
        self.print = lanes(minima(self.parse.phrases(text[self.cut :]), self.front))
        self.parse.back()

    def close(self, following: _Open) -> tuple:
        tail = following.text[: len(self.text) // 2]
        edited = self.text[: self.cut] + tail
        new = lanes(minima(self.parse.phrases(tail), self.front))
        self.parse.back()
        sha = hashlib.sha256(edited.encode()).hexdigest()
        return self.doc_id, len(self.text), sha, self.print, new, likeness(self.print, new), likeness(self.print, following.print)


_DIGEST = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = [part.split()[0] for part in _DIGEST.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, both fingerprints (bytes), near_edited, near_next."""
    spark = docs.sparkSession
    ship_code(spark)
    names, kinds = [*_NAMES, "task", "edge", "text"], [*_KINDS, pa.int32(), pa.string(), pa.string()]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = TaskContext.get().partitionId(), None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                part = batch.slice(at, 256)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    here = _Open(doc_id, text)
                    if held is None:
                        rows.append((doc_id, *[None] * 6, task, "first", text))
                    else:
                        rows.append((*held.close(here), task, None, None))
                    held = here
                yield _batch(rows, names, kinds)
        if held is not None:
            yield _batch([(held.doc_id, *[None] * 6, task, "last", held.text)], names, kinds)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    source = source.withColumn("tie", F.xxhash64("text"))
    order = [F.desc_nulls_last("doc_id"), F.col("tie")]
    dealt = source.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")
    done = stored(dealt.mapInArrow(stream, f"{_DIGEST}, task int, edge string, text string"), "fingerprints")

    # One small row per range says which range comes next; after the last one comes the first.
    tasks = sorted(r["task"] for r in done.where("edge = 'first'").select("task").collect())
    following = dict(zip(tasks, tasks[1:] + tasks[:1], strict=True))
    turn = spark.createDataFrame(list(following.items()), "task int, following int")
    last = done.where("edge = 'last'").select("doc_id", "text", "task").join(turn, "task")
    first = done.where("edge = 'first'").select(F.col("task").alias("following"), F.col("text").alias("next_text"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield _batch([_Open(r["doc_id"], r["text"]).close(_Open(None, r["next_text"]))], _NAMES, _KINDS)

    edges = last.join(first, "following").select("doc_id", "text", "next_text").mapInArrow(pairs, _DIGEST)
    return done.where("edge IS NULL").select(*_NAMES).unionByName(edges)


def as_text(pairs: DataFrame) -> DataFrame:
    """Fingerprints as lower-case hex."""
    hexed: dict[str, Column] = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return pairs.withColumns(hexed)
