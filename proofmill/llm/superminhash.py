"""MinHash near-dedup with SuperMinHash signatures.

1. Sketch. A document's set is its distinct shingles (64-bit hashes). SuperMinHash: every element visits
   the signature's places in its own random order; its visit of rank j offers the value j + r (r uniform in
   [0, 1)), and a place keeps the smallest offer. The ranks of one element are a permutation, so places
   are correlated and the estimate varies less than with independent hashes. A document stops at the first
   rank that can no longer lower its largest value, which for texts longer than the signature is after two or three ranks.
2. Classes. Equal sets (128-bit digest) are one class; only classes go on.
3. Bands. 32 bands of 4 places: two sets at similarity 0.8 share no band with probability 5e-8.
4. Links. In every bucket each member is compared with ``LEADERS`` leaders, and found links are grouped at once. A bucket whose
   members are then all in one group is done: no further pair in it can change the groups.
5. Rest. Members of the buckets still open form clusters (one per smallest group in a bucket), cut by hash into tiles of bounded
   size. All pairs of tiles of a cluster are compared: shared shingles of all their pairs at once as a product of incidence
   matrices. Nothing is capped. Links give one row per linked member, not one per pair. All links are confirmed on full sets.
6. Grouping. Union-find over confirmed links as alternating stars on tables.

Row numbers. Rows are numbered once, in the written table of sketches, which also names each row's place in its file. Texts are read again by
that place, which is the same under any split, so no text is copied (a table that is no scan of files is written once).

Scale. Copies are combined before the shuffle, buckets are never gathered: leaders come from a grouped
minimum and a join, whose hot side can be split. Only classes that share a bucket have their sets written. A large group of near copies costs
one comparison per member and leader; of its members that no leader reaches, tiles are compared, not rows.

Defined results. Null and word-free texts have an empty set, are linked with nothing and kept.
Repeated rows get a row each, in the same class. A row with a null id is kept with a null component, links through it
hold for the others. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmill.llm.common import FOLDER, connected_components, drop_folder, few_rows, identified, sliced, smallest_reached, stored, text_bytes
from proofmill.llm.pretokens import Known, claim
from proofmill.session import ship_code

PLACES, BANDS = 128, 32
LEADERS = 2
#: Most sets and bytes of a tile, about; columns of an incidence matrix at a time.
TILE_SETS, TILE_BYTES, COLUMNS = 512, 4 << 20, 1 << 13
_STEP, _M1, _M2, _BASE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def _mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@cache
def _word_hashes() -> Known:
    return Known(xxhash.xxh64_intdigest, 100_000, "near")


def shingles(data: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; a shorter text is one shingle, a word-free one none."""
    words = (data or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = _word_hashes()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    total = np.full(n, len(h) if len(h) < k else k, np.uint64)
    for i in range(min(k, len(h))):
        total = _mix(total * _BASE + h[i : i + n])
    return np.unique(total)


def superminhash(elements: np.ndarray, owner: np.ndarray, n: int, places: int = PLACES) -> np.ndarray:
    """Signatures (n, places) of n sets; ``owner`` names the set of each element. Sets without elements keep infinity."""
    best = np.full(n * places, np.inf)
    picks: list[np.ndarray] = []  # the exchange partner of each earlier rank, per element
    for j in range(places):
        if not len(elements):
            break
        r = (_mix(elements + np.uint64((2 * j + 1) * int(_STEP) % 2**64)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        pick = (_mix(elements + np.uint64((2 * j + 2) * int(_STEP) % 2**64)) % np.uint64(places - j)).astype(np.int32) + j
        place = pick.copy()
        for t in range(j - 1, -1, -1):  # undo the exchanges: which place of the first order stands here
            place[place == picks[t]] = t
        np.minimum.at(best, owner * places + place, r + j)
        picks.append(pick)
        going = best.reshape(n, places).max(axis=1) > j + 1
        on = going[owner]
        if not on.all():
            elements, owner, picks = elements[on], owner[on], [p[on] for p in picks]
    return best.reshape(n, places)


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    n, places = signatures.shape
    parts = np.ascontiguousarray(signatures).view(np.uint64).reshape(n, bands, places // bands)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands))
    for i in range(parts.shape[2]):
        keys = _mix(keys * _BASE + parts[:, :, i])
    return keys.view(np.int64)


def sketches(rows: DataFrame, k: int, places: int = PLACES, bands: int = BANDS) -> DataFrame:
    """The columns of ``rows`` but ``text``, and n_shingles, digest, keys, per row."""
    ship_code(rows.sparkSession)
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near")
        for batch in sliced(batches):
            sets = [shingles(t, k) for t in batch.column("text").to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            owner = np.repeat(np.arange(len(sets)), sizes)
            keys = band_keys(superminhash(np.concatenate(sets), owner, len(sets), places), bands) if len(sets) else np.empty((0, bands), np.int64)
            offsets = np.arange(0, keys.size + 1, bands, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(f.name) for f in kept], pa.array(sizes), pa.array([xxhash.xxh128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                ],
                names=[*[f.name for f in kept], "n_shingles", "digest", "keys"],
            )

    passed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(run, f"{passed}, n_shingles long, digest binary, keys array<long>")


def _texts(docs: DataFrame, file: str, place: str, text_col: str, id_col: str) -> DataFrame:
    return docs.select(F.col(file).alias("file"), F.col(place).alias("place"), F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))


def _sets(texts: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near")
        for batch in sliced(batches):
            sets = pa.array([shingles(t, k).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("row"), sets], names=["row", "elements"])

    return texts.select("row", "text").mapInArrow(run, "row long, elements binary")


def _shared(a: pa.Array, b: pa.Array) -> pa.Array:
    """Size of the intersection of two sets of distinct elements."""
    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
        both = np.sort(np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)]))
        out.append(int(np.count_nonzero(both[1:] == both[:-1])))
    return pa.array(out, pa.int64())


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets reach the similarity."""
    _shared.__annotations__ = {"a": pa.Array, "b": pa.Array, "return": pa.Array}
    shared = F.arrow_udf(_shared, "long").asNondeterministic()
    size = F.octet_length("elements") / 8
    left = sets.select(F.col("row").alias("a"), F.col("elements").alias("x"), size.cast("long").alias("nx"))
    right = sets.select(F.col("row").alias("b"), F.col("elements").alias("y"), size.cast("long").alias("ny"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where((F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent))
        .select("a", "b", "nx", "ny", shared("x", "y").alias("s"))
        .where((F.col("s") * 100 >= (F.col("nx") + F.col("ny") - F.col("s")) * percent))
        .select("a", "b")
    )


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sets of two lists (sorted distinct elements), by blocks of elements."""
    sizes = np.array([len(x) for x in (*a, *b)])
    elements, column = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(a), len(b)), np.int64)
    order = np.argsort(column, kind="stable")
    edges = np.searchsorted(column[order], np.arange(0, len(elements) + COLUMNS, COLUMNS))
    for k in range(len(edges) - 1):
        part = order[edges[k] : edges[k + 1]]
        block = np.zeros((len(sizes), COLUMNS), np.float32)
        block[owner[part], column[part] - k * COLUMNS] = 1
        out += np.rint(block[: len(a)] @ block[len(a) :].T).astype(np.int64)
    return out


def _tile_links(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):  # a row is two tiles
            for pair in batch.to_pylist():
                a, b = ([np.frombuffer(x, np.uint64) for x in pair[c]] for c in ("sets_a", "sets_b"))
                rows_a, rows_b = (np.array(pair[c], np.int64) for c in ("rows_a", "rows_b"))
                shared = shared_counts(a, b)
                total = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :] - shared
                linked = (100 * shared >= percent * total) & (rows_a[:, None] != rows_b[None, :])
                if linked.any():
                    roots_a, roots_b = smallest_reached(linked, rows_a, rows_b)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([rows_a, rows_b])), pa.array(np.concatenate([roots_a, roots_b]))], names=["a", "b"])

    return run


def _rest(open_members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what all pairs of each bucket's members connect. ``open_members``: key, row, component."""
    cluster = open_members.groupBy("key").agg(F.min("component").alias("cluster"))
    members = open_members.join(cluster, "key").select("cluster", "row").distinct().join(sets, "row")
    size = F.greatest(F.ceil(F.count("*") / TILE_SETS), F.ceil(F.sum(F.octet_length("elements")) / TILE_BYTES)).cast("int")
    members = stored(members, "cluster-members")
    dealt = members.join(members.groupBy("cluster").agg(size.alias("parts")), "cluster").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    both = F.collect_list(F.struct("row", "elements"))
    tiles = dealt.repartition("cluster", "part").groupBy("cluster", "part").agg(both.alias("m")).select("cluster", "part", F.col("m.row").alias("rows"), F.col("m.elements").alias("sets"))
    tiles = stored(tiles, "cluster-tiles")
    left = tiles.select("cluster", F.col("part").alias("pa"), F.col("rows").alias("rows_a"), F.col("sets").alias("sets_a"))
    right = tiles.select("cluster", F.col("part").alias("pb"), F.col("rows").alias("rows_b"), F.col("sets").alias("sets_b"))
    with few_rows(open_members.sparkSession, 4):  # a row is two tiles
        return stored(left.join(right, "cluster").where("pa <= pb").drop("pa", "pb", "cluster").mapInArrow(_tile_links(percent), "a long, b long").where("a <> b"), "rest-links")


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, text_col: str = "text", id_col: str = "doc_id", leaders: int = LEADERS
) -> DataFrame:
    """One row per row of ``docs``: row (its number), file and place, doc_id, n_shingles, component_id, group (a row number for each group), kept."""
    source, file, place = identified(docs.select(id_col, text_col), "rows")
    return _grouped(_texts(source, file, place, text_col, id_col), k, percent, leaders)


def _grouped(texts: DataFrame, k: int, percent: int, leaders: int = LEADERS) -> DataFrame:
    """``near_duplicates`` of (file, place, doc_id, text)."""
    sketch = stored(sketches(texts.select(F.monotonically_increasing_id().alias("row"), "*"), k), "sketches")
    firsts = F.min_by(F.struct("keys", "n_shingles", "file", "place"), "row").alias("first")
    classes = sketch.where("n_shingles > 0").groupBy("digest").agg(F.min("row").alias("row"), F.min("doc_id").alias("first_id"), firsts)
    classes = stored(classes.select("digest", "row", "first_id", "first.*"), "classes")
    # Buckets of two or more classes; a class alone everywhere is done.
    keyed = classes.select(F.explode("keys").alias("key"), "row", F.col("n_shingles").alias("n"))
    busy = keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    members = stored(keyed.join(busy, "key"), "buckets")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """The full sets of the given rows, from their texts."""
        places = wanted.distinct().join(classes.select("row", "file", "place"), "row")
        return stored(_sets(texts.join(places, ["file", "place"]), k), "shingle-sets")

    links = None
    if leaders:
        least = [F.min(F.struct(F.xxhash64("row", F.lit(i)).alias("h"), "row", "n")) for i in range(leaders)]
        first = members.groupBy("key").agg(*[F.struct(x["row"].alias("leader"), x["n"].alias("ln")).alias(f"l{i}") for i, x in enumerate(least)])
        first = first.select("key", F.inline(F.array_distinct(F.array(*[f"l{i}" for i in range(leaders)]))))
        # Sets whose sizes differ too much cannot be alike; only the others are loaded.
        alike = F.least("n", "ln") * 100 >= F.greatest("n", "ln") * percent
        pairs = members.join(first, "key").where("row <> leader").where(alike).select(F.least("row", "leader").alias("a"), F.greatest("row", "leader").alias("b"))
        pairs = stored(pairs.distinct(), "pairs")
        links = stored(_confirmed(pairs, sets_of(pairs.select(F.explode(F.array("a", "b")).alias("row"))), percent), "confirmed")

    def grouped(found: DataFrame) -> DataFrame:
        return stored(connected_components(found, "near").withColumnRenamed("node", "row"), "groups")

    groups = grouped(links) if links is not None and not links.isEmpty() else None
    now = members.withColumn("component", F.col("row")) if groups is None else members.join(groups, "row", "left").withColumn("component", F.coalesce("component", "row"))
    open_keys = now.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("key")
    still = stored(now.drop("n").join(open_keys, "key"), "open-buckets")
    rest = _rest(still, sets_of(still.select("row")), percent)
    if not rest.isEmpty():
        groups = grouped(rest if links is None else links.unionByName(rest))

    own = classes.select("digest", "row", "first_id")
    if groups is None:
        own = own.withColumn("component", F.col("row"))
    else:
        own = own.join(groups, "row", "left").withColumn("component", F.coalesce("component", "row"))
    smallest = own.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = own.join(smallest, "component").select("digest", "component_id", F.col("component").alias("group"))
    full = sketch.where("n_shingles > 0").drop("keys").join(named, "digest").select("row", "file", "place", "doc_id", "n_shingles", "component_id", "group")
    alone = sketch.where("n_shingles = 0").select("row", "file", "place", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.col("row").alias("group"))
    both = full.unionByName(alone).withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return both.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group: the first row that has the group's smallest id. Rows without
    words or id all stay, and so do rows of one id whose texts are in different groups. Columns stay as they are, whatever their names."""
    source, file, place = identified(docs, "rows")
    folder = f"near-{uuid.uuid4().hex}/"
    token = FOLDER.set(folder)
    try:
        found = _grouped(_texts(source, file, place, text_col, id_col), k, percent)
    finally:
        FOLDER.reset(token)
    where = F.struct("file", "place")
    sure = found.where("kept AND (n_shingles = 0 OR doc_id IS NULL)").select(where.alias("at"))
    firsts = found.where("kept AND n_shingles > 0 AND doc_id IS NOT NULL").groupBy("group").agg(F.min_by(where, "row").alias("at")).select("at")
    chosen = sure.unionByName(firsts).select(F.col("at.file").alias(file), F.col("at.place").alias(place))
    chosen = stored(chosen, "chosen")
    drop_folder(docs.sparkSession, folder)  # only the chosen places are needed from here on
    return source.join(chosen, [file, place], "left_semi").drop(file, place)


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM (
    SELECT x.r AS ra, y.r AS rb, count(*) AS s FROM shingles x JOIN shingles y ON x.g = y.g AND x.r <> y.r GROUP BY x.r, y.r) p
  JOIN sizes sa ON sa.r = ra JOIN sizes sb ON sb.r = rb JOIN words a ON a.r = ra JOIN words b ON b.r = rb
  WHERE 100 * s >= 80 * (sa.n + sb.n - s)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id <= coalesce(m, doc_id) AS kept
FROM words LEFT JOIN sizes USING (r) LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) ON a = doc_id
"""
