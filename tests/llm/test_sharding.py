import hashlib
import zlib
from bisect import bisect_left
from collections import Counter

import pytest
from pyspark.sql import functions as F

from proofmill.llm import sharding as s


@pytest.mark.parametrize("slack", [0.0, 0.1])
def test_plan_is_bounded_and_whole(slack):
    counts = {c * 61 % s.CELLS: c % 5 + 1 for c in range(2000)} | {7: 9000}
    plan = s.assign(counts, 16, slack)
    held, slots = Counter(), {}
    for cell, first, end, shard, base in plan:
        held[cell] += end - first
        slots.setdefault(shard, []).extend(range(base, base + end - first))
    assert held == Counter(counts)
    bounds = s.bounds(sum(counts.values()), 16, slack)
    assert all(sorted(x) == list(range(len(x))) and len(x) <= bounds[k] for k, x in slots.items())
    assert slack or max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_keys_go_home_or_clockwise_to_the_first_shard_with_room():
    counts = dict.fromkeys(range(0, s.CELLS, 16), 1)
    cells, owners = s.ring(8)
    plan = s.assign(counts, 8)
    full = Counter(p[3] for p in plan)
    home = {c: owners[bisect_left(cells, c) % len(cells)] for c in counts}
    for cell, *_, shard, _ in plan:
        if shard != home[cell]:
            assert full[home[cell]] == s.bounds(len(counts), 8)[home[cell]]


def walk(counts, shards, slack):
    """(cell, rank) -> (shard, slot), one key at a time: home first, then every key left over goes clockwise node by node."""

    def digest(text):
        return hashlib.md5(text.encode()).digest()

    nodes = sorted((int.from_bytes(digest(f"{shard}/{v}")[:8], "big") % s.CELLS, shard) for shard in range(shards) for v in range(s.NODES))
    total = sum(counts.values())
    room = max(total, int(total * (1 + slack)))
    bound = {shard: room // shards + (1 if shard < room % shards else 0) for shard in range(shards)}
    used, placed, left = Counter(), {}, []
    for cell in sorted(counts, key=lambda c: digest(f"cell/{c}")):
        home = next((i for i, (at, _) in enumerate(nodes) if at >= cell), 0)
        for rank in range(counts[cell]):
            shard = nodes[home][1]
            if used[shard] < bound[shard]:
                placed[cell, rank] = (shard, used[shard])
                used[shard] += 1
            else:
                left.append((cell, rank, home))
    for cell, rank, at in left:
        while used[nodes[at][1]] >= bound[nodes[at][1]]:
            at = (at + 1) % len(nodes)
        shard = nodes[at][1]
        placed[cell, rank] = (shard, used[shard])
        used[shard] += 1
    return placed


@pytest.mark.parametrize("slack", [0.0, 0.1])
def test_plan_equals_a_walk_key_by_key(slack):
    for counts in ({}, {5: 1}, {s.CELLS - 1: 40, 0: 3}, {c * 61 % s.CELLS: c % 5 + 1 for c in range(700)} | {7: 1000}):
        plan = {(cell, rank): (shard, base + rank - first) for cell, first, end, shard, base in s.assign(counts, 16, slack) for rank in range(first, end)}
        assert plan == walk(counts, 16, slack)


def test_rows_equal_a_walk_key_by_key(spark, data, monkeypatch):
    """Rows of one cell are interchangeable; how many of a cell go where, and their slots, are the walk's. One id holds a third of all rows."""
    monkeypatch.setattr(s, "WINDOW_ROWS", 50)
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.range(docs.count() // 2).select(F.lit(77).cast("long").alias("doc_id"), F.lit("hot").alias("text")))
    cell = F.shiftrightunsigned(F.xxhash64("doc_id"), 48).alias("cell")
    counts = Counter(r["cell"] for r in docs.select(cell).collect())
    got = Counter((r["cell"], r["shard"], r["slot"]) for r in s.shard(docs, 16).select(cell, "shard", "slot").collect())
    assert got == Counter((c, *place) for (c, _), place in walk(counts, 16, 0.0).items())


def test_movement_is_limited_when_a_shard_joins():
    counts = dict.fromkeys(range(0, s.CELLS, 4), 1)
    where = [{p[0]: p[3] for p in s.assign(counts, n, slack=0.2)} for n in (16, 17)]
    moved = sum(where[0][c] != where[1][c] for c in counts) / len(counts)
    assert moved < 0.25


def test_documents_get_gapless_places(make, odd_docs, monkeypatch):
    monkeypatch.setattr(s, "WINDOW_ROWS", 5)  # a hot key is split
    hot = make([(77, "same", "en", "a", 4)] * 40, odd_docs.schema)
    docs = odd_docs.unionByName(hot).withColumnRenamed("source", "shard")
    rows = s.shard(docs, 4).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        text = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", None)
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert s.shard(odd_docs.limit(0), 4).count() == 0


def test_shards_are_written(odd_docs, tmp_path, spark):
    s.write_shards(s.shard(odd_docs, 3), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 3
