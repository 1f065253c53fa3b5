"""Positions and texts in order, dealt by ranges of sampled keys."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from proofmill.operators import ordered


def test_ranks_of_sparse_keys(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(-(2**63), 2**63), f"k{rng.random()}") for _ in range(3000)]
    rows += [("hot", rng.randrange(-(2**63), 2**63), "x") for _ in range(4000)] + [("one", None, None)]
    frame = spark.createDataFrame(rows, "g string, key long, name string").repartition(7)
    for order in (["key"], ["name", "key"]):
        told = defaultdict(list)
        for r in ordered.ranked_positions(frame, ["g"], order).collect():
            told[r.g].append((r.pos, tuple(r[c] for c in order)))
        assert sum(map(len, told.values())) == len(rows)
        for g, found in told.items():
            keys = sorted((tuple(r[["g", "key", "name"].index(c)] for c in order) for r in rows if r[0] == g), key=lambda k: tuple((x is not None, x) for x in k))
            assert [k for _, k in sorted(found)] == keys and sorted(p for p, _ in found) == list(range(len(found)))


def test_no_task_sorts_a_group(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        frame = spark.range(20_000).select(F.lit("g").alias("g"), F.xxhash64("id").alias("key"))
        ranked = ordered.ranked_positions(frame, ["g"], ["key"])
        sizes = [r["count"] for r in ranked.groupBy("__range" if "__range" in ranked.columns else F.floor(F.col("pos") / 5000)).count().collect()]
        assert len(sizes) == 4 and max(sizes) == 5000
        assert ranked.select(F.max("pos"), F.countDistinct("pos")).first()[:] == (19_999, 20_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_ordered_text_in_chunks(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randrange(50), i, str(rng.randrange(1000))) for i in range(2000)]
    frame = spark.createDataFrame(rows, "g string, a int, b int, t string").repartition(5)
    for fanout in (3, 8192):
        told = {r.g: (r.members, r.line) for r in ordered.ordered_text(frame, ["g"], ["a", "b"], F.col("t"), ", ", "line", fanout).collect()}
        for g in "ab":
            own = sorted((a, b, t) for x, a, b, t in rows if x == g)
            assert told[g] == (len(own), ", ".join(t for *_, t in own))
