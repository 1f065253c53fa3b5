"""Prediction and review lines.

Two layouts are read. The attempt layout names everything in the path,
``predictions|reviews/<report_id>/<dataset>_<subset>.jsonl``. The partitioned
layout, ``kind=/run_id=/report_id=/subset=``, is the one for large campaigns: Spark
prunes it by folder before any line is parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PATH = r"/(predictions|reviews)/([^/]+)/([^/]+)\.jsonl$"


def subset_from_stem(stem: Column, dataset: Column) -> Column:
    """Drop the ``<dataset>_`` prefix of a file stem; other stems are the subset themselves."""
    prefix = F.concat(dataset, F.lit("_"))
    return F.when(F.startswith(stem, prefix), F.substring(stem, F.length(prefix) + 1, F.length(stem))).otherwise(stem)


def not_blank(text: Column) -> Column:
    """Whether a text has more than white space; from ``!`` on, its first character tells so without a pattern."""
    return (text >= F.lit("!")) | text.rlike(r"\S")


def plain_lines(reader, path: str, numbered: bool = False) -> DataFrame:
    """``value`` and file metadata of each line; blank lines go, or stay with the running number ``seq`` of the scan."""
    text = reader.text(path)
    if not numbered:
        return text.filter(not_blank(F.col("value")))
    return text.select("*", "_metadata", F.monotonically_increasing_id().alias("seq"))


def block_lines(blocks: DataFrame, numbered: bool = False) -> DataFrame:
    """Blocks of whole lines (``value``) cut into ``line``s, at the ends the text source knows; blank ones as in ``plain_lines``.

    Line ends are made alike where a block has others than a line feed, since a single character is cut at without a pattern.
    """
    value, kept = F.col("value"), [c for c in blocks.columns if c != "value"]
    alike = F.when(value.contains("\r"), F.regexp_replace(value, r"\r\n?", "\n")).otherwise(value)
    cut = blocks.select(*kept, F.split(alike, "\n", -1).alias("__cut"))
    if not numbered:
        return cut.select(*kept, F.explode("__cut").alias("line")).where(not_blank(F.col("line")))
    size = F.size("__cut")
    ended = (size > 1) & (F.element_at("__cut", -1) == "")  # the last line's end starts no further line
    lines = F.when(ended, F.slice("__cut", F.lit(1), size - 1)).otherwise(F.col("__cut"))
    return cut.select(*kept, F.posexplode(lines).alias("seq", "line")).withColumn("seq", F.col("seq").cast("bigint"))


#: Lines that ``line_numbers`` counts as one chunk.
CHUNK = 16_384


def line_numbers(lines: DataFrame, wanted: Column, columns: list[str]) -> DataFrame:
    """The wanted lines with ``line_no``, their exact number in the file, blank lines counted; all else is only counted.

    ``lines`` come from a scan with ``numbered``, which may split files anywhere: ``seq`` runs on within a block of a file,
    so a chunk of the scan has its number of lines and its first ``seq``. Running sums of the chunks of a file, in order
    of ``block_start``, give every chunk its first line. One scan does it all: nothing relies on a second one being split
    alike. A chunk lists at most ``CHUNK`` lines.
    """
    row = F.struct("seq", *columns)
    chunks = lines.groupBy("source", "block_start", F.floor(F.col("seq") / CHUNK).alias("chunk")).agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"), F.collect_list(F.when(wanted, row)).alias("rows")
    )
    before = Window.partitionBy("source").orderBy("block_start", "first").rowsBetween(Window.unboundedPreceding, -1)
    placed = chunks.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.size("rows") > 0)
    one = placed.select("source", "block_start", "start", "first", F.explode("rows").alias("row"))
    return one.select(
        "source", "block_start", *[F.col(f"row.{c}").alias(c) for c in columns],
        (F.col("start") + F.col("row.seq") - F.col("first") + 1).alias("line_no"),
    )


def scan_attempt_lines(
    spark: SparkSession, root: str, run_id: str, dataset: str, report_id: str | None = None
) -> DataFrame:
    """Lines of one attempt folder. With ``report_id`` only that model's folder is listed."""
    frames = []
    hadoop = spark._jvm.org.apache.hadoop.fs
    for folder, kind in (("predictions", "predicted"), ("reviews", "reviewed")):
        path = f"{root}/{folder}" + (f"/{report_id}" if report_id is not None else "")
        location = hadoop.Path(path)
        if not location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location):
            continue
        reader = spark.read.option("pathGlobFilter", "*.jsonl")
        if report_id is None:
            reader = reader.option("recursiveFileLookup", "true")
        file_path = F.url_decode(F.col("_metadata.file_path"))
        frames.append(
            reader.text(path).filter(not_blank(F.col("value"))).select(
                F.lit(run_id).alias("run_id"),
                F.lit(kind).alias("kind"),
                F.regexp_extract(file_path, _PATH, 2).alias("report_id"),
                subset_from_stem(F.regexp_extract(file_path, r"/([^/]+)\.jsonl$", 1), F.lit(dataset)).alias("subset"),
                F.col("_metadata.file_path").alias("source"),
                F.col("_metadata.file_block_start").alias("block_start"),
                F.col("value").alias("line"),
            )
        )
    if not frames:
        return spark.createDataFrame(
            [], "run_id string, kind string, report_id string, subset string, source string, block_start bigint, line string"
        )
    lines = frames[0]
    for frame in frames[1:]:
        lines = lines.unionByName(frame)
    return lines


def write_partitioned_lines(lines: DataFrame, root: str) -> None:
    """Store lines in the partitioned layout (``line`` is the text, the rest are folders)."""
    placed = lines.select("kind", "run_id", "report_id", "subset", F.col("line").alias("value"))
    # one writer per folder, hot folders split by size
    placed.hint("rebalance", "kind", "run_id", "report_id", "subset").write.partitionBy(
        "kind", "run_id", "report_id", "subset"
    ).mode("overwrite").text(root)


def scan_partitioned_lines(spark: SparkSession, root: str, owners: DataFrame | None = None, numbered: bool = False) -> DataFrame:
    """Lines of many runs. ``owners`` (run_id, report_id) keeps only each run's own model folder; ``numbered`` as in ``line_numbers``."""
    schema = "value string, kind string, run_id string, report_id string, subset string"
    lines = plain_lines(spark.read.schema(schema), root, numbered)
    lines = lines.select(
        "run_id", "kind", "report_id", "subset",
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value").alias("line"), *(["seq"] if numbered else []),
    )
    if owners is not None:
        lines = lines.join(owners.select("run_id", "report_id"), ["run_id", "report_id"], "left_semi")
    return lines
