"""Score report documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill.schemas import METRIC, REPORT


def read_documents(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """One row per file below ``root`` whose name matches: path and whole text."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))


def parse_reports(documents: DataFrame) -> DataFrame:
    """Documents with ``is_report`` / ``parse_error`` flags and the report's members as columns.

    A report is an object with a ``metrics`` list and a ``dataset_name`` member,
    be it null. Unparsable documents stay as rows: a run with nothing but broken
    files is told apart from a run without files. A document is read as the
    member of an outer object, so text after it makes it invalid; only one that
    does not have the shape is read again, as one opaque value.
    """
    wrapped = F.concat(F.lit('{"d":'), F.col("document"), F.lit("}"))
    options = {"allowSingleQuotes": "false"}
    shape = F.from_json(
        wrapped, "d struct<metrics:array<string>,dataset_name:variant>, damaged string",
        {**options, "columnNameOfCorruptRecord": "damaged"},
    )
    opaque = F.from_json(wrapped, "d string", options)["d"]
    is_null = F.coalesce(F.trim(F.col("document")) == "null", F.lit(False))
    shaped = documents.select("*", F.inline(F.array(shape)))
    sound = F.col("damaged").isNull() & F.col("d").isNotNull()
    flagged = shaped.withColumns(
        {
            "parse_error": ~F.when(sound, F.lit(True)).otherwise(opaque.isNotNull() | is_null),
            "is_report": sound & F.col("d.metrics").isNotNull() & F.col("d.dataset_name").isNotNull(),
        }
    )
    kept = [*[c for c in documents.columns if c != "document"], "parse_error", "is_report"]
    return report_columns(flagged.select(*kept, F.when(F.col("is_report"), F.col("document")).alias("document")))


_METRIC_OPTIONS = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "damaged"}


def report_columns(documents: DataFrame) -> DataFrame:
    """Replace ``document`` by the report's members; ``inline`` makes Spark parse each text once.

    ``metric_texts`` are the metrics as they are written, for work on single metrics (``metric_members``); ``metrics`` are the
    same, typed one by one.
    """
    kept = [c for c in documents.columns if c != "document"]
    member = lambda text: F.from_json(text, METRIC.strip(), _METRIC_OPTIONS)
    told = documents.select(*kept, F.inline(F.array(F.from_json("document", REPORT))))
    return told.withColumns({"metric_texts": F.col("metrics"), "metrics": F.transform("metrics", member)})


def metric_members(reports: DataFrame, kept: list[str]) -> DataFrame:
    """One row per metric of each report: its place ``m_pos`` and, parsed once, ``m``; a misshapen member is ``m.damaged`` or null."""
    texts = reports.select(*kept, F.posexplode("metric_texts").alias("m_pos", "text"))
    return texts.select(*kept, "m_pos", F.inline(F.array(F.struct(F.from_json("text", METRIC.strip(), _METRIC_OPTIONS).alias("m")))))


def scan_reports(spark: SparkSession, root: str) -> DataFrame:
    """Every document below ``root`` with its flags; report members are NULL for the others."""
    return parse_reports(read_documents(spark, root))
