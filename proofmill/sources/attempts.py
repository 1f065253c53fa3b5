"""Many attempt folders below one root.

An attempt is a folder with a ``run_manifest.json``, ``reports/**``, ``predictions/<report_id>/*.jsonl`` and
``reviews/<report_id>/*.jsonl``. Run, model and subset come from the path, so one recursive listing reads any number of
attempts. Each name may also be a folder of part files, and each folder may carry a column name as ``partitionBy``
writes it (``attempt=a1/kind=predictions/report_id=m/file=set_default.jsonl/part-0.txt``).

Many small attempts cost more in files than in bytes: a file of 1 KB is made, listed and opened for itself. An archive holds the
same files as rows (``write_archive``), so its own files grow with the bytes. The scans read either, by the same rules of paths.
"""

from __future__ import annotations

import re
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill.sources import lines, manifests, reports
from proofmill.sources.files import decoded

_NAME = r"(?:[^/=]+=)?"
_BEFORE = rf"^(?:.*?/)?{_NAME}([^/]+)/{_NAME}"

# What the scans read, by path.
_MANIFEST = rf"(^|/){_NAME}run_manifest[^/]*\.json(/[^/]+)?$"
_REPORT = rf"(^|/){_NAME}reports/.*\.json(/[^/]+)?$"
_LINES = _BEFORE + rf"(predictions|reviews)/{_NAME}([^/]+)/{_NAME}([^/]+?)\.jsonl(?:/[^/]+)?$"
_CONTENTS = {"manifests": _MANIFEST, "reports": _REPORT, "lines": _LINES}
_ARCHIVE = "path string, block_start bigint, value string, content string"


def below(root: str, path: Column | str = "_metadata.file_path") -> Column:
    """The part of a file's path that follows ``root``, decoded."""
    folder = re.escape(urlparse(root).path.rstrip("/"))
    return F.regexp_replace(decoded(F.col(path) if isinstance(path, str) else path), f"^.*?{folder}/+", "")


def attempt_of(relative: Column, inside: str) -> Column:
    """The attempt folder: what lies above the first folder or file that ``inside`` (a pattern) matches."""
    return F.regexp_extract(relative, _BEFORE + inside, 1)


def write_archive(files: DataFrame, root: str) -> None:
    """Add files to the archive at ``root``: path (below the attempts' root), block_start, value.

    A document is one row. A file of lines is cut into any number of blocks, each a run of whole lines with their line ends, numbered
    by ``block_start`` in the file's order; a block is one value, so it has to be small, a file need not be. Rows lie by
    what the scans look for (``content``); a file that two of them look for is held for each, one that none does as ``other``.
    """
    held = F.array_compact(F.array(*[F.when(F.col("path").rlike(pattern), F.lit(name)) for name, pattern in _CONTENTS.items()]))
    content = F.explode(F.when(F.size(held) > 0, held).otherwise(F.array(F.lit("other")))).alias("content")
    files.select("path", F.col("block_start").cast("bigint").alias("block_start"), "value", content).write.mode("append").partitionBy("content").parquet(root)


def _archived(spark: SparkSession, root: str, content: str) -> DataFrame:
    return spark.read.schema(_ARCHIVE).parquet(root).where(F.col("content") == content).drop("content")


def _documents(spark: SparkSession, root: str, pattern: str, archive: bool, content: str) -> DataFrame:
    """Path below the root and whole text of the documents that ``content`` names."""
    if archive:
        return _archived(spark, root, content).select("path", F.col("value").alias("document"))
    documents = reports.read_documents(spark, root, pattern).withColumn("path", below(root, F.col("path")))
    return documents.where(F.col("path").rlike(_CONTENTS[content]))


def scan_attempt_manifests(spark: SparkSession, root: str, pattern: str = "run_manifest*.json", archive: bool = False) -> DataFrame:
    """Parsed manifests with their ``attempt``; a manifest that names no run, or does not parse, stands for its folder."""
    parsed = manifests.parse_run_manifests(_documents(spark, root, pattern, archive, "manifests"))
    attempt = attempt_of(F.col("path"), r"run_manifest[^/]*\.json")
    return parsed.withColumn("attempt", attempt).withColumn("run_id", F.coalesce("run_id", "attempt"))


def scan_attempt_reports(spark: SparkSession, root: str, pattern: str = "*.json", archive: bool = False) -> DataFrame:
    """Every document below a ``reports`` folder, with its ``attempt`` and flags."""
    placed = _documents(spark, root, pattern, archive, "reports")
    if archive:
        # small documents, packed well: their file may be one task, and the shuffle too few bytes for more
        placed = placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    return reports.parse_reports(placed.withColumn("attempt", attempt_of(F.col("path"), "reports/")))


def _named(path: Column, *others: Column | str) -> list:
    names = {"attempt": 1, "folder": 2, "report_id": 3, "stem": 4}
    return [*[F.regexp_extract(path, _LINES, group).alias(name) for name, group in names.items()], *others]


def scan_attempt_folders(
    spark: SparkSession, root: str, owners: DataFrame, pattern: str = "*.jsonl", numbered: bool = False, archive: bool = False
) -> DataFrame:
    """Prediction and review lines of every attempt, of its own model only.

    ``owners``: attempt, run_id, dataset, report_id (a null report_id takes all models). The path is read before a line is: files
    of other models and attempts go by a join on their names, in an archive before their blocks are cut into lines. ``numbered``
    keeps blank lines and adds ``seq`` (see ``lines.line_numbers``).
    """
    named = owners.select("attempt", "run_id", "dataset", F.col("report_id").alias("own"))

    def owned(placed: DataFrame) -> DataFrame:
        return placed.where("attempt <> ''").join(named, "attempt").where(F.col("own").isNull() | (F.col("own") == F.col("report_id")))

    def told(placed: DataFrame, *others: str) -> DataFrame:
        kind = F.when(F.col("folder") == "predictions", F.lit("predicted")).otherwise(F.lit("reviewed")).alias("kind")
        subset = lines.subset_from_stem(F.col("stem"), F.col("dataset")).alias("subset")
        return placed.select("run_id", kind, "report_id", subset, "source", "block_start", *others)

    seq = ["seq"] if numbered else []
    if archive:
        blocks = _archived(spark, root, "lines").select(*_named(F.col("path"), F.col("path").alias("source"), "block_start", "value"))
        cut = lines.block_lines(told(owned(blocks), "value"), numbered)
        return cut.select("run_id", "kind", "report_id", "subset", "source", "block_start", "line", *seq)
    scanned = lines.plain_lines(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern), root, numbered)
    held = [F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block_start"), F.col("value").alias("line")]
    return told(owned(scanned.select(*_named(below(root), *held, *seq))), "line", *seq)
