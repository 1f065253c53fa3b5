"""Published tables: new folders by Spark's partitioned writers, and one small version name.

A merge overwrites the key buckets it touches, as partitions of a new version's folder; ``buckets``, a small table in that folder,
says in which folder each bucket of each table is now. The version counts once its name stands under the next number in
``_versions``. That file is created only if no other has the number, so of two writers that started from the same version one
fails, or starts again from the new one. Readers see the old tables or the new ones, and what they are reading stays.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill.session import stored

VERSIONS, MAP = "_versions", "buckets"
BUCKETS = 64
BUCKET = "key_bucket"
_MAP = "name string, bucket int, folder string"


class StaleVersionError(RuntimeError):
    """Another writer has published since the version this one started from."""


def _path(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def current_number(spark: SparkSession, root: str) -> int:
    """The number of the newest version; 0 where nothing is published."""
    fs, folder = _path(spark, f"{root}/{VERSIONS}")
    if not fs.exists(folder):
        return 0
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return max((int(n) for n in names if re.fullmatch(r"\d+", n)), default=0)


def version_at(spark: SparkSession, root: str, number: int) -> str | None:
    """The folder of a version; None for number 0."""
    return spark.read.text(f"{root}/{VERSIONS}/{number:012d}").first()["value"] if number else None


def current_version(spark: SparkSession, root: str) -> str | None:
    """The folder of the newest version."""
    return version_at(spark, root, current_number(spark, root))


def stage(spark: SparkSession, root: str, tables: dict[str, DataFrame], options: dict | None = None) -> str:
    """Write tables into a new version folder without showing it to readers."""
    version = f"v-{uuid.uuid4().hex}"
    for name, frame in tables.items():
        frame.write.options(**(options or {})).mode("errorifexists").parquet(f"{root}/{version}/{name}")
    return version


def activate(spark: SparkSession, root: str, version: str, after: int | None = None) -> int:
    """Publish a staged version as the one after number ``after`` (the current one if not given); fails if that is taken."""
    number = (current_number(spark, root) if after is None else after) + 1
    fs, target = _path(spark, f"{root}/{VERSIONS}/{number:012d}")
    try:
        stream = fs.create(target, False)
    except Exception as taken:
        if fs.exists(target):
            raise StaleVersionError(f"version {number} of {root} exists") from taken
        raise
    stream.write(bytearray(version.encode()))
    stream.close()
    return number


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], cluster_by: str | None = None, after: int | None = None) -> str:
    """Stage every table whole and make the version current.

    ``cluster_by`` gathers equal keys into the same files, sorted; Spark splits a key that is too large for one task.
    ``after`` is the number of the version that ``tables`` were worked out from.
    """
    after = current_number(spark, root) if after is None else after
    if cluster_by is not None:
        tables = {n: t.hint("rebalance", cluster_by).sortWithinPartitions(cluster_by) for n, t in tables.items()}
    version = stage(spark, root, tables)
    activate(spark, root, version, after)
    return version


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def bucket_folders(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """(name, bucket, folder) of a version's tables by bucket: at most one row per table and bucket."""
    version = version_at(spark, root, current_number(spark, root) if number is None else number)
    fs, path = _path(spark, f"{root}/{version}/{MAP}")
    if version is None or not fs.exists(path):
        return spark.createDataFrame([], _MAP)
    return spark.read.schema(_MAP).parquet(f"{root}/{version}/{MAP}")


def _read(spark: SparkSession, root: str, folders: list[str], schema) -> DataFrame:
    paths = [f"{root}/{f}" for f in sorted(folders)]
    return spark.read.parquet(*paths) if paths else spark.createDataFrame([], schema)


def merge(
    spark: SparkSession, root: str, changes: dict[str, DataFrame], key: str, how: dict[str, Callable[[DataFrame, DataFrame], DataFrame]],
    buckets: int = BUCKETS, after: int | None = None, attempts: int = 3,
) -> int:
    """Publish tables of which only the key buckets that ``changes`` touch are read and written again.

    ``how[name](old, new)`` gives a table's rows from the stored rows of the touched buckets and the changes. All tables share
    the key's buckets (choose their number by the size of the data, and keep it); a table that is not there yet starts empty.
    Untouched buckets keep their folders. The bucket numbers are all that reaches the driver. Changes to tables that are there are stored
    first, since their buckets are asked for before they are merged; tables that are new are written at once. With ``after``, the merge fails if that
    version is no longer the newest; without, it starts again from the newest one, ``attempts`` times at most.
    """
    changes, kept = {name: frame.withColumn(BUCKET, bucket_of(F.col(key), buckets)) for name, frame in changes.items()}, False
    for attempt in range(1, attempts + 1):
        start = current_number(spark, root) if after is None else after
        known = {(r["name"], r["bucket"]): r["folder"] for r in bucket_folders(spark, root, start).collect()}
        if not kept and any(name in changes for name, _ in known):
            changes, kept = {name: stored(frame, f"changes-{name}") for name, frame in changes.items()}, True
        version = _write_merged(spark, root, changes, key, how, buckets, known)
        try:
            return activate(spark, root, version, start)
        except StaleVersionError:
            if after is not None or attempt == attempts:
                raise
    raise ValueError("attempts must be positive")


def _write_merged(spark: SparkSession, root: str, changes: dict[str, DataFrame], key: str, how: dict, buckets: int, known: dict) -> str:
    there = any(name in changes for name, _ in known)
    touched = {r[0] for frame in changes.values() for r in frame.select(BUCKET).distinct().collect()} if there else set()
    version, now = f"v-{uuid.uuid4().hex}", dict(known)
    for name, new in changes.items():
        old = _read(spark, root, [f for (n, bucket), f in known.items() if n == name and bucket in touched], new.drop(BUCKET).schema)
        merged = how[name](old, new.drop(BUCKET)).withColumn(BUCKET, bucket_of(F.col(key), buckets))
        folder = f"{version}/{name}"
        dealt = merged.hint("rebalance", BUCKET, key).sortWithinPartitions(BUCKET, key)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{root}/{folder}")
        written = spark.read.schema(merged.schema).parquet(f"{root}/{folder}").select(BUCKET).distinct().collect()
        now = {k: f for k, f in now.items() if k[0] != name or k[1] not in touched}
        now |= {(name, r[0]): f"{folder}/{BUCKET}={r[0]}" for r in written}
    rows = [(n, bucket, folder) for (n, bucket), folder in sorted(now.items())]
    spark.createDataFrame(rows, _MAP).coalesce(1).write.parquet(f"{root}/{version}/{MAP}")
    return version


def read_table(spark: SparkSession, root: str, name: str, keys: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The rows of a table. With ``keys``, only the buckets that can hold them are listed and read."""
    number = current_number(spark, root)
    if not number:
        raise FileNotFoundError(f"nothing published under {root}")
    held = bucket_folders(spark, root, number).where(F.col("name") == name)
    folders = held.collect()
    if not folders:
        return spark.read.parquet(f"{root}/{version_at(spark, root, number)}/{name}")
    if keys is None:
        return _read(spark, root, [r["folder"] for r in folders], None)
    wanted = spark.createDataFrame([(k,) for k in keys], "key string").select(bucket_of(F.col("key"), buckets)).distinct().collect()
    there = [r["folder"] for r in folders if r["bucket"] in {w[0] for w in wanted}]
    any_folder = spark.read.parquet(f"{root}/{folders[0]['folder']}")
    return _read(spark, root, there, any_folder.schema)
