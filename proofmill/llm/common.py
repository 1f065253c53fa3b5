"""What the training-data operators share: byte views of texts, slices of batches, row identities, stored steps, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill import session

#: Rows that a function works on at once. Spark bounds an Arrow batch by bytes; what is made of it in Python is many times as large.
SLICE_ROWS = 256

#: Folds A-Z and turns every byte that is no word byte (0-9, a-z, 0x80 and up) into a space.
WORD_BYTES = bytes((b + 32) if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


#: Folder below the work folder that intermediate tables are written to; an operator may set one of its own and drop it whole.
FOLDER: ContextVar[str] = ContextVar("folder", default="")


def stored(df: DataFrame, label: str) -> DataFrame:
    return session.stored(df, FOLDER.get() + label)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove the intermediate tables of one call, once its result no longer needs them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{session.shared_dir(spark)}/proofmill/{folder.rstrip('/')}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sliced(batches: Iterator, rows: int = SLICE_ROWS) -> Iterator:
    """Batches (or arrays, or tuples of arrays) in slices of few rows."""
    for batch in batches:
        columns = batch if isinstance(batch, tuple) else (batch,)
        for at in range(0, len(columns[0]), rows):
            parts = tuple(c.slice(at, rows) for c in columns)
            yield parts if isinstance(batch, tuple) else parts[0]


@contextmanager
def few_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of few rows for the jobs run inside, where each row is large; the session's setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Names of the columns that ``identified`` adds.
FILE, PLACE = "file_mark", "file_place"


def identified(docs: DataFrame, label: str) -> tuple[DataFrame, str, str]:
    """``docs`` with two columns that stay a row's identity under any split: a hash of its file's path and its place in the file.

    A scan of Parquet files has both, so nothing is copied; any other table is written once, with running numbers. Returns the
    names of the columns.
    """
    file, place = free_name(docs, FILE), free_name(docs, PLACE)

    def marked(frame: DataFrame) -> DataFrame:
        return frame.select(*[F.col(f"`{c}`") for c in docs.columns], F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))

    try:
        if "_metadata" not in {c.lower() for c in docs.columns}:
            return marked(docs), file, place
    except AnalysisException:  # no scan of files with row numbers
        pass
    numbered = docs.select("*", F.lit(0).cast("long").alias(file), F.monotonically_increasing_id().alias(place))
    return stored(numbered, label), file, place


def text_bytes(column: str | Column) -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def folded_words(data: bytes | None) -> list[bytes]:
    """Lower-case A-Z words of UTF-8 bytes: runs of ASCII digits, ASCII letters and all bytes from 0x80."""
    return (data or b"").translate(WORD_BYTES).split()


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose names an operator is about to give its own results (names compare without case, as Spark does)."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def smallest_reached(linked: np.ndarray, rows_a: np.ndarray, rows_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest row that each row reaches over the links between two tiles."""
    la, lb, far = rows_a.copy(), rows_b.copy(), np.iinfo(np.int64).max
    while True:
        na = np.minimum(la, np.where(linked, lb[None, :], far).min(axis=1))
        nb = np.minimum(lb, np.where(linked, na[:, None], far).min(axis=0))
        if (na == la).all() and (nb == lb).all():
            return la, lb
        la, lb = na, nb


def connected_components(links: DataFrame, label: str) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Alternating stars: every node's larger neighbours move to its smallest neighbour, then
    its smaller ones do. Each step is one grouped minimum and one join on the node (a hot centre
    is combined before the shuffle and its join partition can be split), and each result is a
    written table, so lineage stays short. Only one flag per round reaches the driver.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{label}-links"
    )
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written, so that the join below has a shuffle of its own on either side and a hot node's partition can be split.
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{label}-low")
        # Large star: for u, every neighbour v > u is linked to the smallest of u's neighbourhood.
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, f"{label}-large")
        # Small star: for u, every neighbour v < u and u itself are linked to the smallest of them.
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), f"{label}-least")
        small = (
            large.join(least, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        small = stored(small, f"{label}-small")
        # Done when the links are stars around nodes that are nobody's larger neighbour.
        centres = small.select(F.col("v").alias("u")).distinct()
        done = small.join(centres, "u", "left_semi").isEmpty() and small.groupBy("u").count().where("count > 1").isEmpty()
        edges = small
        if done:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
