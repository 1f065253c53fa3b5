"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``CELLS`` cells. A key's hash names its cell; every shard has ``nodes`` virtual nodes at hashed cells.
A cell's home is the shard of the first node at or clockwise after it. Each shard takes the keys whose home it is, up
to its bound; keys that find it full continue clockwise to the next shard with room. With ``slack`` 0
bounds differ by one at most, so shard sizes do (law ``rows``); a larger slack leaves room and moves fewer keys.

Scale. Keys are counted per cell first; those at most 65,536 counts (the ring is fixed, whatever the number of rows)
are all that the driver sees, and from them it says how many keys of each cell go where. Rows then get their rank within
the cell, in windows of about ``WINDOW_ROWS`` rows: a cell with more (one key may repeat endlessly) is split by the
row's number. The plan (two rows a cell at most, and one per shard) is joined as a broadcast of that bounded size.
Texts are read once for their size and checksum and never shuffled unless the caller keeps them.

Defined results. A null text counts as empty. Null ids share one cell. Repeated rows get places of their own. An empty
table gives an empty result. Results replace columns of the same names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proofmill.session import stored

CELLS = 1 << 16
NODES = 128
WINDOW_ROWS = 200_000
OWN = ["size", "text_crc32", "law", "shard", "slot", "grown_shard", "shard_row", "shard_cell"]


def ring(shards: int, nodes: int = NODES) -> tuple[list[int], list[int]]:
    """Cells of the virtual nodes in ring order, and the shard of each. A node's cell depends on its own shard and number only."""
    placed = sorted(
        (int.from_bytes(hashlib.md5(f"{s}/{v}".encode(), usedforsecurity=False).digest()[:8], "big") % CELLS, s, v)
        for s in range(shards) for v in range(nodes)
    )
    return [c for c, _, _ in placed], [s for _, s, _ in placed]


def bounds(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """The most keys each shard takes; they differ by one at most and hold all keys together."""
    room = max(total, int(total * (1 + slack)))
    return [room // shards + (s < room % shards) for s in range(shards)]


def assign(counts: dict[int, int], shards: int, slack: float = 0.0, nodes: int = NODES) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, slot of the first) that together hold every key of every cell once."""
    cells, owners = ring(shards, nodes)
    room = bounds(sum(counts.values()), shards, slack)
    used = [0] * shards
    plan: list[tuple[int, int, int, int, int]] = []

    def take(cell: int, rank: int, n: int, shard: int) -> int:
        n = min(n, room[shard] - used[shard])
        if n:
            plan.append((cell, rank, rank + n, shard, used[shard]))
            used[shard] += n
        return n

    # Cells come in hashed order, so overflow strikes no region of the ring in particular.
    order = sorted(counts, key=lambda c: hashlib.md5(f"cell/{c}".encode(), usedforsecurity=False).digest())
    rest = []
    for cell in order:
        at = bisect_left(cells, cell) % len(cells)
        done = take(cell, 0, counts[cell], owners[at])
        if done < counts[cell]:
            rest.append((cell, at, done))
    for cell, at, done in rest:
        while done < counts[cell]:
            at = (at + 1) % len(cells)
            done += take(cell, done, counts[cell] - done, owners[at])
    return plan


def shard(
    docs: DataFrame, shards: int, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, nodes: int = NODES,
) -> DataFrame:
    """The ``keep`` columns (all by default) with size, text_crc32, law, shard, slot and grown_shard."""
    spark = docs.sparkSession
    kept = [c for c in (keep or docs.columns) if c.lower() not in OWN]
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            *[F.col(f"`{c}`") for c in kept], (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 48).cast("int").alias("shard_cell"), F.monotonically_increasing_id().alias("shard_row"),
        ),
        "shard-rows",
    )
    counts = {r["shard_cell"]: r["count"] for r in rows.groupBy("shard_cell").count().collect()}
    plan = assign(counts, shards, slack, nodes)
    pieces = spark.createDataFrame(plan, "shard_cell int, first long, end long, shard int, base long")

    # Ranks: split the large cells by row number, and begin each part where the one before ends.
    large = spark.createDataFrame([(c, n // WINDOW_ROWS + 1) for c, n in counts.items() if n > WINDOW_ROWS], "shard_cell int, parts int")
    split = rows.join(F.broadcast(large), "shard_cell", "left").withColumn("part", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("shard_row"), F.col("parts"))).otherwise(0))
    parts = split.where("parts IS NOT NULL").groupBy("shard_cell", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard_cell").orderBy("part")) - F.col("n")
    parts = parts.select("shard_cell", "part", before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("shard_cell", "part").orderBy("shard_row")) - 1
    ranked = split.withColumn("rank", rank.cast("long"))
    if not large.isEmpty():
        ranked = ranked.join(parts, ["shard_cell", "part"], "left").withColumn("rank", F.col("rank") + F.coalesce("before", F.lit(0)))
    return (
        ranked.join(F.broadcast(pieces), "shard_cell")
        .where("rank >= first AND rank < end")
        .select(
            *[F.col(f"`{c}`") for c in kept], "size", "text_crc32", F.lit("rows" if slack == 0 else "bound").alias("law"), "shard",
            (F.col("base") + F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard; a shard's rows are spread over as many tasks as it has files."""
    files = F.floor(F.col("slot") / rows_per_file)
    sharded.withColumn("part_no", files).repartition("shard", "part_no").sortWithinPartitions("shard", "slot").drop("part_no").write.partitionBy("shard").parquet(path)
