"""Order-dependent work on groups.

``plain_digests`` hashes the ordered elements of groups that are bounded by their source (the parts of one sample come
from one row). ``tree_digests`` hashes groups of any size by one rule: each chunk of positions gives one node, and the
ordered nodes give the root, also where there is a single chunk. No task holds more than one chunk, and equal content
gives equal digests under any partitioning.

``dense_positions`` numbers the rows of each group 0, 1, 2, ... from a compact integer
order key, ``ranked_positions`` from any order keys; neither sorts a group in one place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofmill.functions.canonical import digest, json_hex, json_list
from proofmill.session import stored

#: Positions of a chunk.
FANOUT = 8192


@dataclass(frozen=True)
class Digest:
    """One digest to compute: JSON element per row (NULL = not in the list) and text around the list."""

    element: Column
    prefix: str = ""
    suffix: str = ""


@dataclass(frozen=True)
class Rollup:
    """A plain aggregate carried along: over rows first, over chunk results after."""

    rows: Column
    merge: Callable[[str], Column]


def _listed(
    df: DataFrame, group: list[str], order: list[str], digests: dict[str, Digest], rollups: dict[str, Rollup]
) -> DataFrame:
    """Per group: the JSON array of every digest's ordered elements, and the aggregates."""
    names = {name: f"__e_{name}" for name in digests}
    rows = df.select("*", *[spec.element.alias(names[name]) for name, spec in digests.items()])
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in names.values()])
    gathered = rows.groupBy(*group).agg(
        F.sort_array(F.collect_list(packed)).alias("__items"), *[spec.rows.alias(name) for name, spec in rollups.items()]
    )
    return gathered.select(
        *group, *rollups, *[json_list(F.col(f"__items.{e}")).alias(name) for name, e in names.items()]
    )


def _around(spec: Digest, text: Column) -> Column:
    return digest(F.concat(F.lit(spec.prefix), text, F.lit(spec.suffix)))


def plain_digests(
    df: DataFrame, group: list[str], order: list[str], digests: dict[str, Digest], rollups: dict[str, Rollup] | None = None
) -> DataFrame:
    """One row per group; each digest is that of the JSON array of the group's elements."""
    rollups = rollups or {}
    lists = _listed(df, group, order, digests, rollups)
    return lists.select(*group, *rollups, *[_around(spec, F.col(name)).alias(name) for name, spec in digests.items()])


def tree_digests(
    df: DataFrame, group: list[str], chunk: Column, order: list[str], digests: dict[str, Digest], rollups: dict[str, Rollup] | None = None,
) -> DataFrame:
    """One row per group; each digest is that of the JSON array of the digests of its chunks."""
    rollups = rollups or {}
    lists = _listed(df.withColumn("__chunk", chunk), [*group, "__chunk"], order, digests, rollups)
    nodes = lists.select(*group, "__chunk", *rollups, *[digest(F.col(name)).alias(name) for name in digests])
    above = {name: Digest(json_hex(F.col(name)), spec.prefix, spec.suffix) for name, spec in digests.items()}
    return plain_digests(nodes, group, ["__chunk"], above, {name: Rollup(spec.merge(name), spec.merge) for name, spec in rollups.items()})


def dense_positions(
    df: DataFrame, group: list[str], order: str, out: str = "pos", width: int = 65536
) -> DataFrame:
    """Add the 0-based rank of ``order`` (integer, unique per group).

    Rows are ranked inside slices of ``width`` order values; a running total of
    slice counts gives each slice its start. A slice holds at most ``width`` rows.
    """
    sliced = df.withColumn("__slice", F.floor(F.col(order) / F.lit(width)).cast("bigint"))
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(*group, "__slice")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*group, "__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    inside = Window.partitionBy(*group, "__slice").orderBy(order)
    return (
        sliced.join(starts, [*group, "__slice"])
        .withColumn(out, (F.col("__start") + F.row_number().over(inside) - 1).cast("bigint"))
        .drop("__slice", "__start")
    )


def ranked_positions(df: DataFrame, group: list[str], order: list[str], out: str = "pos") -> DataFrame:
    """Add the 0-based rank of the ``order`` columns, of any type and spread, within each group.

    Spark samples the keys and deals the rows by ranges of group and order, so no group is sorted in one place and no range is
    one row. The dealt rows are written with the running number of their task; of a group, each range needs only its
    first number and its count, and running sums of the counts give every range its start. Ties come in any order, but each
    row has a rank of its own; null keys come first.
    """
    keys = [*group, *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = stored(dealt.select("*", F.spark_partition_id().alias("__range"), F.monotonically_increasing_id().alias("__at")), "ranked")
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        kept.groupBy(*group, "__range")
        .agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
        .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first"))
        .select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)], F.col("__range").alias("__r"), "__start")
    )
    same = F.col("__range") == F.col("__r")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    placed = kept.join(starts, same).withColumn(out, F.col("__start") + F.col("__at"))
    return placed.select(*[c for c in df.columns if c != out], out)


def ordered_text(df: DataFrame, group: list[str], order: list[str], piece: Column, separator: str, out: str, fanout: int = FANOUT) -> DataFrame:
    """Per group: the pieces of its rows, in order, joined by the separator, and the number of rows (``members``).

    Two levels: rows are dealt by ranges, each task joins runs of ``fanout`` of them, and a group joins the results. No list
    holds more than ``fanout`` rows, or one text per so many rows.
    """
    dealt = df.select(*group, *order, piece.alias("__piece")).repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    kept = stored(dealt.select(*group, "__piece", F.monotonically_increasing_id().alias("__at")), "ordered")

    def joined(frame: DataFrame, keys: list[str], text: str, place: str) -> DataFrame:
        gathered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place, text))), lambda r: r[text]), separator)
        return frame.groupBy(*keys).agg(gathered.alias("__text"), F.sum("__n").alias("__n"))

    chunks = joined(kept.withColumn("__n", F.lit(1)).withColumn("__chunk", F.floor(F.col("__at") / fanout)), [*group, "__chunk"], "__piece", "__at")
    return joined(chunks, group, "__text", "__chunk").withColumnsRenamed({"__text": out, "__n": "members"})


def first_per_group(df: DataFrame, group: list[str], order: list, count: int, out: str = "rank") -> DataFrame:
    """The first ``count`` rows of each group; Spark trims each task's rows before the shuffle."""
    ranked = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(out, F.row_number().over(ranked)).filter(F.col(out) <= count)
