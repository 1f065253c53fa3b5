"""Packing by power-of-two decomposition.

A document of n ids is cut into whole sequences of the largest power of two that fits, and
its rest into the powers of two that sum to it, largest first. Pieces of equal length share a
bucket (column ``bucket``, the power), and every piece is a sequence of its own: no sequence crosses documents and none is padded.

Scale. Documents are never shuffled or gathered: each task encodes its own rows and
writes its pieces, each with its bucket, so a writer that partitions by it (``write_buckets``) forms the buckets without a shuffle. A sequence id is the task's number and the row's place in it, so it needs no
global counting; documents must be a scan or a written table, whose rows come again in the
same order when a task is repeated.

Encoding. A pre-token's ids come from the library's merges, once per pre-token and cache
generation (bounded). Special strings inside texts become their single ids.

Defined results. A null or empty text has only the closing id. Repeated rows are packed each;
null doc_ids stay null. An empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmill.llm import pretokens
from proofmill.llm.common import sliced, without
from proofmill.session import ship_code

END_ID = 1
SEQUENCE = 2048
#: Pre-tokens that a task remembers.
CACHE = 300_000


@cache
def encoder(path: str, size: int = CACHE):
    """A function from a text to its ids as little-endian 32-bit bytes; a Python worker keeps it over tasks."""
    tokenize = pretokens.load(path).model.tokenize
    pattern, special = pretokens.specials(path)
    whole = {s: i.to_bytes(4, "little") for s, i in special.items()}
    space = pretokens.byte_letters()[32]

    def encode(piece: str) -> bytes:
        rest = piece[1:]
        if piece[0] == " " and rest.isascii() and rest.isprintable() and " " not in rest:
            letters = space + rest  # visible ASCII stands for itself
        else:
            letters = pretokens.byte_level(piece)
        ids = [t.id for t in tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    known = pretokens.Known(encode, size, "packing").__getitem__

    def plain(text: str) -> bytes:
        return b"".join(map(known, pretokens.byte_pretokens(text, path)))

    def run(text: str) -> bytes:
        if not text:
            return b""
        if pattern is None or not pattern.search(text):
            return plain(text)
        return b"".join(whole.get(part) or plain(part) for part in pattern.split(text) if part)

    return run


def pieces_of(n: int, limit: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of the powers of two that n splits into, none above ``limit``."""
    out = [(i * limit, limit) for i in range(n // limit)]
    at, rest = n - n % limit, n % limit
    while rest:
        length = 1 << (rest.bit_length() - 1)
        out.append((at, length))
        at, rest = at + length, rest - length
    return out


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = SEQUENCE, end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset, bucket (log2 of length), and the ids (little-endian bytes) if asked for."""
    if limit < 1 or limit & (limit - 1):
        raise ValueError("the sequence length must be a power of two")
    ship_code(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pretokens.claim("packing")
        encode = encoder(tokenizer_path)
        for batch in sliced(batches):
            key, text = batch.columns
            rows, starts, lengths, totals, sums, ids = [], [], [], [], [], []
            for i, t in enumerate(text.to_pylist()):
                data = encode(t or "") + end
                n = len(data) // 4
                for start, length in pieces_of(n, limit):
                    part = data[4 * start : 4 * (start + length)]
                    rows.append(i)
                    starts.append(start)
                    lengths.append(length)
                    totals.append(n)
                    sums.append(zlib.crc32(part))
                    ids.append(part if with_ids else None)
            yield pa.RecordBatch.from_arrays(
                [
                    key.take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                    pa.array(totals, pa.int64()), pa.array(sums, pa.int64()), pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kinds = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"
    out = source.mapInArrow(run, kinds).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
    )
    return out if with_ids else without(out, "ids")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write pieces in one folder per bucket, straight from the tasks that cut them: no shuffle and no copy."""
    pieces.write.partitionBy("bucket").parquet(path)
