"""Embedding near-dedup by PCA-ordered tiled comparison.

1. Vectors of one label and dimension that are equal are one class.
2. PCA of the second moments of all unit vectors (summed over the tasks) gives a rotation whose leading dimensions hold
   most of every product.
3. Vectors fall into cells of a grid over the two leading dimensions, as wide as the largest distance that a link allows, so links only
   join neighbouring cells. Cells are cut by hash into tiles of about ``TILE`` vectors.
4. Tiles of neighbouring cells meet if their boxes over ``LEAD`` dimensions are close enough. A pair of tiles is compared
   by leading dimensions first: what the other dimensions can add is bounded by the product of suffix norms; pairs that cannot
   reach the threshold stop, and a tile pair stops when none is left. Survivors are decided by the product of the plain unit
   vectors in double precision; the rotated ones only rule pairs out.
5. A tile pair gives one row per linked vector: the number of its links and the smallest vector of its local group. Links are never
   listed one by one. Groups grow together by alternating stars on tables.

Scale. A tile is bounded whatever the size of a label, of a cell or of a group of copies: a large near-copy group is
cut into tiles like everything else. ``BLOCK`` tiles of a cell form a block, and pairs of tiles are dealt by pairs of blocks: a
tile travels once per pair of blocks, not once per pair of tiles, and a task holds two blocks. A rotation is d*d numbers per dimension.

Defined results. Vectors that are null, zero, or hold null or non-finite components, and vectors without a label, link with nothing:
no links, a group of their own. Rows of equal vectors link with each other. Null ids: the component is null
and the row is kept; others still count it as a link. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmill.llm.common import connected_components, few_rows, smallest_reached
from proofmill.session import ship_code, stored

TILE = 512
LEAD = 8
#: Tiles of a cell that travel together.
BLOCK = 8
#: Rounding allowance of products of unit vectors while pairs are being ruled out.
ROUND_OFF = 1e-9


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest, dimension and unit vector of usable vectors; nulls for the others."""
    for batch in batches:
        digests, dims, units = [], [], []
        for label, values in zip(batch.column("label").to_pylist(), batch.column("vector").to_pylist(), strict=True):
            x = None
            if label is not None and values and None not in values:
                x = np.array(values, np.float64) + 0.0  # one zero
                if np.isfinite(x).all() and x.any():
                    peak = np.abs(x).max()
                    unit = x / peak
                    unit /= np.sqrt(unit @ unit)
                else:
                    x = None
            digests.append(None if x is None else xxhash.xxh128_digest(x.tobytes()))
            dims.append(None if x is None else len(x))
            units.append(None if x is None else unit.tobytes())
        yield pa.RecordBatch.from_arrays(
            [*batch.select(["row", "vec_id", "label"]).columns, pa.array(digests, pa.binary()), pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
            names=["row", "vec_id", "label", "digest", "dim", "unit"],
        )


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One matrix of second moments per task and dimension."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = np.array(batch.column("dim").to_pylist())
        units = batch.column("unit").to_pylist()
        for d in np.unique(dims):
            x = np.stack([np.frombuffer(units[i]) for i in np.flatnonzero(dims == d)])
            sums[int(d)] = sums.get(int(d), 0) + x.T @ x
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["dim", "moment"]
    )


def _add(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(m) for m in group["moment"])
    return pd.DataFrame({"dim": group["dim"].iloc[:1].to_numpy(), "moment": [total.tobytes()]})


def _rotation(group: pd.DataFrame) -> pd.DataFrame:
    d = int(group["dim"].iloc[0])
    _, vectors = np.linalg.eigh(sum(np.frombuffer(m).reshape(d, d) for m in group["moment"]))
    return pd.DataFrame({"dim": [d], "rotation": [np.ascontiguousarray(vectors[:, ::-1]).tobytes()]})


def compare_tiles(unit_a: np.ndarray, unit_b: np.ndarray, rotation: np.ndarray, threshold: float, same: bool, lead: int = LEAD) -> np.ndarray:
    """Which pairs of unit vectors (rows of a and b) reach the threshold; the rotation brings the heaviest dimensions to the front."""
    a, b, d = unit_a @ rotation, unit_b @ rotation, unit_a.shape[1]

    def tails(x: np.ndarray, k: int) -> np.ndarray:
        return np.sqrt((x[:, k:] ** 2).sum(axis=1))

    k = min(lead, d)
    product = a[:, :k] @ b[:, :k].T
    alive = product + np.outer(tails(a, k), tails(b, k)) >= threshold - ROUND_OFF
    if same:
        np.fill_diagonal(alive, False)
    out = np.zeros(alive.shape, bool)
    while k < d and alive.any():
        if alive.mean() > 0.05:  # many are left: the next dimensions for all of them
            more = min(2 * k, d)
            product += a[:, k:more] @ b[:, k:more].T
        else:
            i, j = np.nonzero(alive)
            more = min(2 * k, d)
            product[i, j] += np.einsum("nd,nd->n", a[i, k:more], b[j, k:more])
        k = more
        alive &= product + np.outer(tails(a, k), tails(b, k)) >= threshold - ROUND_OFF
    i, j = np.nonzero(alive)
    for at in range(0, len(i), 4096):
        few = slice(at, at + 4096)
        out[i[few], j[few]] = np.einsum("nd,nd->n", unit_a[i[few]], unit_b[j[few]]) >= threshold
    return out


def link_vectors(
    vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", tile: int = TILE
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``."""
    spark = vectors.sparkSession
    ship_code(spark)
    source = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    units = stored(source.mapInArrow(_units, "row long, vec_id long, label string, digest binary, dim int, unit binary"), "units")
    usable = units.where("unit IS NOT NULL")
    classes = usable.groupBy("label", "dim", "digest").agg(F.min("row").alias("row"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id"), F.min_by("unit", "row").alias("unit"))
    classes = stored(classes, "vector-classes")

    salted = classes.select("dim", "unit").mapInArrow(_moments, "dim int, moment binary").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    added = salted.groupBy("dim", "salt").applyInPandas(_add, "dim int, moment binary")
    rotations = {r["dim"]: np.frombuffer(bytes(r["rotation"])).reshape(r["dim"], r["dim"]) for r in added.groupBy("dim").applyInPandas(_rotation, "dim int, rotation binary").collect()}
    shared = spark.sparkContext.broadcast(rotations)
    reach = float(np.sqrt(2 - 2 * threshold)) + ROUND_OFF  # the distance of unit vectors at the threshold

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.frombuffer(u) @ shared.value[d] for u, d in zip(batch.column("unit").to_pylist(), batch.column("dim").to_pylist(), strict=True)]
            cells = [[int(np.floor(x[i] / reach)) if i < len(x) else 0 for i in (0, 1)] for x in out]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["label", "dim", "row", "copies"]).columns, pa.array([c[0] for c in cells], pa.int32()), pa.array([c[1] for c in cells], pa.int32()), batch.column("unit")],
                names=["label", "dim", "row", "copies", "c0", "c1", "x"],
            )

    placed = classes.select("label", "dim", "row", "copies", "unit").mapInArrow(rotate, "label string, dim int, row long, copies long, c0 int, c1 int, x binary")
    placed = stored(placed, "rotated")
    cell = ["label", "dim", "c0", "c1"]
    sizes = placed.groupBy(*cell).agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    dealt = placed.join(sizes, cell).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    # Blocks with the same hash would travel together, which changes no result.
    dealt = dealt.withColumn("block", F.xxhash64(*cell, F.floor(F.col("part") / BLOCK)))

    def box(group: pd.DataFrame) -> pd.DataFrame:
        x, first = np.stack([np.frombuffer(v) for v in group["x"]]), group.iloc[0]
        lead = x @ shared.value[int(first["dim"])][:, :LEAD]
        return pd.DataFrame(
            {
                "tile": [int(group["row"].min())], "label": [first["label"]], "dim": [first["dim"]], "c0": [first["c0"]], "c1": [first["c1"]],
                "block": [first["block"]], "low": [lead.min(axis=0).tolist()], "high": [lead.max(axis=0).tolist()], "rows": [group["row"].tolist()],
                "copies": [group["copies"].tolist()], "x": [x.tobytes()],
            }
        )

    tiles = stored(
        dealt.repartition(*cell, "part").groupBy(*cell, "part").applyInPandas(box, "tile long, label string, dim int, c0 int, c1 int, block long, low array<double>, high array<double>, rows array<long>, copies array<long>, x binary"),
        "tiles",
    )
    head = tiles.select("tile", *cell, "block", "low", "high")
    near = F.explode(F.array(*[F.struct((F.col("c0") + i).alias("c0"), (F.col("c1") + j).alias("c1")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    other = head.select("label", "dim", near.alias("c"), F.col("tile").alias("b"), F.col("block").alias("block_b"), F.col("low").alias("low_b"), F.col("high").alias("high_b")).select("label", "dim", "c.c0", "c.c1", "b", "block_b", "low_b", "high_b")
    gaps = F.zip_with(
        F.zip_with("low", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high", lambda x, y: x - y), lambda x, y: F.pow(F.greatest(x, y, F.lit(0.0)), 2)
    )
    pairs = head.join(other, cell).where("tile <= b").where(F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g) <= reach * reach)
    # Of a pair of blocks, the smaller comes first whichever of its tiles does.
    one, two = F.least("block", "block_b").alias("one"), F.greatest("block", "block_b").alias("two")
    pairs = stored(pairs.select(one, two, F.col("tile").alias("a"), "b"), "tile-pairs")
    partners = pairs.groupBy("one", "two", F.col("a").alias("tile")).agg(F.collect_list("b").alias("partners"))  # as many as a block has tiles
    partnered = pairs.select("one", "two", F.col("b").alias("tile")).distinct().join(partners, ["one", "two", "tile"], "full_outer")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        held = {t.tile: (np.array(t.rows, np.int64), np.array(t.copies, np.int64), np.frombuffer(t.x).reshape(-1, t.dim)) for t in group.itertuples()}
        for t in group.itertuples():
            ra, ca, xa = held[t.tile]
            for b in t.partners if t.partners is not None else ():
                rb, cb, xb = held[b]
                same = t.tile == b
                linked = compare_tiles(xa, xb, shared.value[t.dim], threshold, same)
                if not linked.any():
                    continue
                la, lb = smallest_reached(linked, ra, rb)
                n, root, rows = linked @ cb, la, ra
                if not same:
                    n, root, rows = np.concatenate([n, linked.T @ ca]), np.concatenate([la, lb]), np.concatenate([ra, rb])
                on = n > 0
                out.append(pd.DataFrame({"row": rows[on], "n": n[on], "root": root[on]}))
        return pd.concat(out) if out else pd.DataFrame({"row": [], "n": [], "root": []}, dtype=np.int64)

    payload = tiles.select("tile", "dim", "rows", "copies", "x")
    with few_rows(spark, 8):  # a row is a tile
        found = partnered.join(payload, "tile").groupBy("one", "two").applyInPandas(compare, "row long, n long, root long")
        found = stored(found, "tile-links")

    counts = found.groupBy("row").agg(F.sum("n").alias("n"))
    groups = connected_components(found.select(F.col("row").alias("a"), F.col("root").alias("b")), "vectors").withColumnRenamed("node", "row")
    own = stored(
        classes.drop("unit", "dim").join(counts, "row", "left").join(groups, "row", "left")
        .withColumn("component", F.coalesce("component", "row")).withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("copies") - 1),
        "vector-groups",
    )
    first = own.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = own.join(first, "component").select("label", "digest", "n_links", "component_id")
    linked = usable.select("row", "vec_id", "label", "digest").join(named, ["label", "digest"]).select("vec_id", "n_links", "component_id")
    alone = units.where("unit IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.unionByName(alone).withColumn("component_id", F.when(F.col("vec_id").isNotNull(), F.col("component_id")))
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


ORACLE = r"""
WITH RECURSIVE usable AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND (SELECT bool_and(v IS NOT NULL AND isfinite(v)) AND bool_or(v <> 0) FROM (SELECT unnest(embedding) AS v))),
links AS (
  SELECT a.r AS ra, a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.r <> b.r AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = vec_id LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) g ON g.a = vec_id
"""
