"""Hashes of files read as streams, against hashlib."""

import hashlib
import random

import pytest

from proofmill.sources import files


def contents():
    rng = random.Random(4)
    return {
        "empty.bin": b"", "line feed.bin": b"\n", "feeds.bin": b"\n\n\n", "no+feed.bin": b"abc", "end%20.bin": b"abc\n", "crlf.txt": b"a\r\nb\r\n\r", "marked.txt": b"\xef\xbb\xbfabc\n",
        "mark only.txt": b"\xef\xbb\xbf", "ünï.bin": bytes(range(256)) * 9, "deep/er/x.bin": rng.randbytes(50_000), "one line.bin": b"x" * 30_000, "y.gz": b"no archive",
        "deep/z.bin": rng.randbytes(20_000) + b"\n" * 3000, "real.parquet": b"PAR1" + rng.randbytes(5000) + b"PAR1",
    }


@pytest.mark.parametrize("split", ["900", "100000000"])
def test_equal_to_hashlib(spark, tmp_path, split, monkeypatch):
    for name, data in contents().items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        told = {r.path.split(f"{tmp_path.name}/", 1)[1]: (r.length, r.sha256) for r in files.file_digests(spark, str(tmp_path)).collect()}
        parquet = files.file_digests(spark, str(tmp_path), "*.parquet").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert told == {name: (len(data), hashlib.sha256(data).hexdigest()) for name, data in contents().items() if data}
    assert [r.sha256 for r in parquet] == [told["real.parquet"][1]]


def test_parts_of_any_size_give_one_hash(monkeypatch):
    """The same bytes as one block and as blocks of a split file, in parts of a few bytes."""
    import pyarrow as pa

    data = random.Random(6).randbytes(4000) + b"\n"
    lines = data.split(b"\n")[:-1]
    kinds = pa.schema([("path", pa.string()), ("size", pa.int64()), ("start", pa.int64()), ("block", pa.int64()), ("value", pa.binary())])
    monkeypatch.setattr(files, "PART", 100)

    def scanned(rows):
        return [r for b in files._scan(iter([pa.RecordBatch.from_pylist(rows[:3], kinds), pa.RecordBatch.from_pylist(rows[3:], kinds)])) for r in b.to_pylist()]

    def rows(cuts):
        return [
            {"path": "f", "size": len(data), "start": start, "block": len(data) if cuts == [0] else 1, "value": v}
            for k, start in enumerate(cuts) for v in lines[start : (cuts + [len(lines)])[k + 1]]
        ]

    whole = scanned(rows([0]))
    assert [r["sha256"] for r in whole] == [hashlib.sha256(data).hexdigest()]
    parts = scanned(rows([0, 4, 9]))
    assert len(parts) > 10 and all(r["sha256"] is None for r in parts)
    joined = [r for b in files._join(iter([pa.RecordBatch.from_pylist(sorted(parts, key=lambda r: (r["block"], r["number"])), pa.schema(list(zip(files._NAMES, files._KINDS))))])) for r in b.to_pylist()]
    assert [r["sha256"] for r in joined] == [hashlib.sha256(data).hexdigest()]
