"""Edit distance between predicted and reference texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmill.functions.canonical import let
from proofmill.session import ship_code


def common_prefix(left: Column, right: Column) -> Column:
    """Length of the common beginning, bit by bit from the largest power of two: each step compares the next piece only."""
    shorter = F.least(F.length(left), F.length(right))
    powers = F.transform(F.sequence(F.floor(F.log2(F.greatest(shorter, F.lit(1)))).cast("int"), F.lit(0), F.lit(-1)), lambda b: F.pow(F.lit(2), b).cast("int"))
    return F.aggregate(
        powers, F.lit(0),
        lambda at, step: F.when(
            (at + step <= shorter) & (F.substring(left, at + 1, step) == F.substring(right, at + 1, step)), at + step
        ).otherwise(at),
    )


def _rest(texts: Column, turned: bool) -> Column:
    """Both texts (a struct of l and r) without their common beginning, turned round first if asked for."""
    left, right = (F.reverse(texts[c]) if turned else texts[c] for c in ("l", "r"))
    whole = F.named_struct(F.lit("l"), left, F.lit("r"), right)
    return let(
        let(whole, lambda t: F.named_struct(F.lit("l"), t["l"], F.lit("r"), t["r"], F.lit("at"), common_prefix(t["l"], t["r"]))),
        lambda t: F.named_struct(*[x for c in ("l", "r") for x in (F.lit(c), F.substring(t[c], t["at"] + 1, F.length(t[c])))]),
    )


#: Thresholds double at most so often; texts of a row are shorter than 2^31.
_DOUBLINGS = 31

#: A band is tried while it is narrower than one part in so many of the shorter text; beyond, whole columns as bits are quicker.
_NARROW = 128


def _banded(texts: Column) -> Column:
    """Exact distance of trimmed texts where a narrow band holds it, else -1: bands of doubling width, from the difference of lengths on."""
    left, right = texts["l"], texts["r"]
    least = F.greatest(F.abs(F.length(left) - F.length(right)), F.lit(1)).cast("bigint")
    shorter = F.least(F.length(left), F.length(right))

    def tried(found: Column, doubling: Column) -> Column:
        threshold = (least * F.pow(F.lit(2), doubling)).cast("bigint")
        banded = F.call_function("levenshtein", left, right, threshold.cast("int"))
        return F.when((found >= 0) | (threshold * _NARROW >= shorter), found).otherwise(banded)

    return F.when(shorter == 0, F.greatest(F.length(left), F.length(right))).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.lit(_DOUBLINGS - 1)), F.lit(-1), tried)
    )


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of a longer and a shorter text."""
    apart = np.flatnonzero(a[: len(b)] != b)
    return int(apart[0]) if len(apart) else len(b)


def bit_distance(left: str, right: str) -> int:
    """Edit distance of whole texts, a column of the table at a time: its steps of one up and down are the bits of two whole numbers.

    The longer text is the column, so there are as many steps as the shorter has letters. Common ends go first.
    """
    a, b = (np.frombuffer(text.encode("utf-32-le"), np.uint32) for text in sorted((left, right), key=len, reverse=True))
    same = _common(a, b)
    a, b = a[same:], b[same:]
    same = _common(a[::-1], b[::-1])
    codes, shorter = a[: len(a) - same], b[: len(b) - same].tolist()
    places = {c: int.from_bytes(np.packbits(codes == c, bitorder="little").tobytes(), "little") for c in set(shorter)}
    size = len(codes)
    every, last = (1 << size) - 1, 1 << size >> 1
    up, down, distance = every, 0, size
    for c in shorter:
        equal = places[c]
        level = equal | down
        crossed = (((equal & up) + up) ^ up) | equal
        rises, falls = down | (every & ~(crossed | up)), up & crossed
        distance += (rises & last != 0) - (falls & last != 0)
        rises, falls = rises << 1 | 1, falls << 1
        up, down = (falls | ~(level | rises)) & every, rises & level & every
    return distance


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distances of -1 worked out from the texts; the texts (the two last columns) go."""
    for batch in batches:
        *kept, known, left, right = batch.columns
        told = [bit_distance(left[i].as_py(), right[i].as_py()) if d == -1 else d for i, d in enumerate(known.to_pylist())]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(told, pa.int32())], names=[f"c{i}" for i in range(len(kept) + 1)])


def _distances(pairs: DataFrame, kept: list[Column], names: list[str]) -> DataFrame:
    """The kept columns and the plain edit distance (substitution 1, no swaps) of whole texts; NULL if either is.

    Equal texts and narrow bands, behind common ends, are column expressions; all else goes by Arrow batches (``bit_distance``).
    """
    ship_code(pairs.sparkSession)
    left, right = F.col("prediction"), F.col("reference")
    whole = F.named_struct(F.lit("l"), left, F.lit("r"), right)
    trimmed = let(let(whole, lambda t: _rest(t, False)), lambda t: _rest(t, True))

    def known(distance: Column, texts: Column | None = None) -> Column:
        left_over = [F.when(distance == -1, texts[c]) if texts is not None else F.lit(None).cast("string") for c in ("l", "r")]
        return F.struct(distance.cast("int").alias("d"), left_over[0].alias("l"), left_over[1].alias("r"))

    narrow = F.greatest(F.abs(F.length(left) - F.length(right)), F.lit(1)).cast("bigint") * _NARROW < F.least(F.length(left), F.length(right))
    told = F.when(left == right, known(F.lit(0))).when(left.isNotNull() & right.isNotNull() & ~narrow, known(F.lit(-1), whole)).when(
        left.isNotNull() & right.isNotNull(),
        let(let(trimmed, lambda t: F.struct(t.alias("t"), _banded(t).alias("d"))), lambda x: known(x["d"], x["t"])),
    )
    rows = pairs.select(*kept, F.inline(F.array(told)))
    fields = [*rows.schema.fields[:-2]]
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    return rows.mapInArrow(_filled, schema).toDF(*names, "distance")


def edit_distance_scores(predictions: DataFrame, references: DataFrame, key: str, threshold: int | None = None) -> DataFrame:
    """Edit distance per pair, whole texts.

    With ``threshold`` a larger distance is reported as -1. Pairs are dealt out anew before the work: their cost is far
    above that of moving them, and a small table would be one task.
    """
    pairs = predictions.join(references, key).repartition(F.xxhash64("prediction"))
    longest = F.greatest(F.length("prediction"), F.length("reference")).alias("longest")
    names = [c for c in pairs.columns if c not in ("prediction", "reference")]
    if threshold is not None:
        return pairs.select(*names, F.levenshtein("prediction", "reference", threshold).alias("distance"), longest)
    return _distances(pairs, [*[F.col(f"`{c}`") for c in names], longest], [*names, "longest"]).select(*[F.col(f"`{c}`") for c in names], "distance", "longest")
