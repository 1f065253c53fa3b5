"""SHA-256 of files of any size, as a stream.

Spark's text source hands out the bytes between line feeds, and a file's bytes are these joined by line feeds. A file that one
task reads whole is hashed as its rows come, without a shuffle. A file that Spark splits sends its blocks, in parts of some
``PART`` bytes, to one task that reads them in order: a hash is a chain, so a file has one stream, but never one value. What the text
source leaves out follows from the file's size: a last line feed, and a byte order mark, for which a second state is carried along.

Any store that Spark's readers open will do. Files whose name ends like a compressed one (``COMPRESSED``) would be unpacked by the
text source; these are hashed from one value of at most 2 GB. A stretch of 2 GB without a line feed is beyond a row, too. Spark's sources list no
empty files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill.session import ship_code, stored

# Endings that the text source takes for compressed files.
COMPRESSED = [".bz2", ".deflate", ".gz", ".lz4", ".snappy", ".zst"]
PART = 1 << 20
_MARK = b"\xef\xbb\xbf"
_PARTS = "path string, size long, block long, number long, lines long, data binary, sha256 string"
_NAMES = ["path", "size", "block", "number", "lines", "data", "sha256"]
_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]


def decoded(path: Column) -> Column:
    """A file path of the metadata as it was named."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


class _Hash:
    """The running hash of one file's lines."""

    def __init__(self) -> None:
        self.plain, self.marked = hashlib.sha256(), hashlib.sha256(_MARK)
        self.seen, self.lines = 0, 0

    def add(self, data: bytes, lines: int) -> None:
        data = b"\n" + data if self.lines else data
        self.plain.update(data)
        self.marked.update(data)
        self.seen, self.lines = self.seen + len(data), self.lines + lines

    def value(self, size: int) -> str:
        left = size - self.seen
        state = self.marked if left >= len(_MARK) else self.plain
        left -= len(_MARK) if left >= len(_MARK) else 0
        if left not in (0, 1):
            raise ValueError(f"a file of {size} bytes was read as {self.seen}")
        state.update(b"\n" * left)
        return state.hexdigest()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names=_NAMES)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole files become their hash, blocks of split files become parts."""
    part_bytes = PART
    key, state, held, size, number = None, None, [], 0, 0

    def close() -> Iterator[tuple]:
        if key is not None and held:
            if state is None:
                yield (key[0], key[1], key[2], number, len(held), b"\n".join(held), None)
            else:
                state.add(b"\n".join(held), len(held))
        if state is not None:
            yield (key[0], key[1], 0, 0, 0, None, state.value(key[1]))

    for batch in batches:
        out = []
        for path, length, start, block, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            here = (path, length, start)
            if here != key:
                out += close()
                key, held, size, number = here, [], 0, 0
                state = _Hash() if start == 0 and block == length else None
            held.append(value)
            size += len(value) + 1
            if size >= part_bytes:
                data = b"\n".join(held)
                if state is None:
                    out.append((path, length, start, number, len(held), data, None))
                else:
                    state.add(data, len(held))
                held, size, number = [], 0, number + 1
        yield _rows(out)
    yield _rows(list(close()))


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of split files, in order, become the file's hash."""
    key, state = None, None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if (r["path"], r["size"]) != key:
                if key is not None:
                    out.append((*key, 0, 0, 0, None, state.value(key[1])))
                key, state = (r["path"], r["size"]), _Hash()
            state.add(r["data"], r["lines"])
        yield _rows(out)
    if key is not None:
        yield _rows([(*key, 0, 0, 0, None, state.value(key[1]))])


def file_digests(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """path, length and sha256 of every file below ``folder`` whose name matches."""
    options = {"recursiveFileLookup": "true", **({} if pattern is None else {"pathGlobFilter": pattern})}
    packed = F.lit(False)
    for ending in COMPRESSED:
        packed = packed | F.col("_metadata.file_path").endswith(ending)
    files = spark.read.format("binaryFile").options(**options).load(folder)
    text = spark.read.options(**options, lineSep="\n").text(folder).where(~packed).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("block"), F.col("value").cast("binary").alias("value"),
    )
    ship_code(spark)
    scanned = stored(text.mapInArrow(_scan, _PARTS), "file-parts")
    parts = scanned.where("sha256 IS NULL").repartition("path", "size").sortWithinPartitions("path", "size", "block", "number")
    done = scanned.where("sha256 IS NOT NULL").unionByName(parts.mapInArrow(_join, _PARTS)).select("path", "sha256")
    listed = files.where(~packed).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"))
    # A file that is a byte order mark has no line.
    mark = F.when(F.col("length") == len(_MARK), F.lit(hashlib.sha256(_MARK).hexdigest()))
    hashed = listed.join(done, "path", "left").select("path", "length", F.coalesce("sha256", mark).alias("sha256"))
    small = files.where(packed).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"), F.sha2("content", 256).alias("sha256")
    )
    return hashed.unionByName(small).withColumn("path", decoded(F.col("path")))
