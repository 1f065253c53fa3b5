"""Pinned datasets: a fixed id set cut from a table, with provenance and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill.sources.files import file_digests
from proofmill.sources.tables import activate, current_version, stage

DATA, IDS, SUMS = "data", "ids", "checksums"


def pin_rows(table: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """The rows of the wanted ids."""
    return table.join(ids.select(id_column).distinct(), id_column, "left_semi")


def file_checksums(spark: SparkSession, folder: str) -> DataFrame:
    files = file_digests(spark, folder, "*.parquet")
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "sha256")


def pin_extract(
    spark: SparkSession, table: DataFrame, ids: DataFrame, id_column: str, root: str, force: bool = False
) -> dict:
    """Publish the pinned rows under ``root`` unless a valid copy is already there."""
    if not force and current_version(spark, root) is not None:
        verdict = pin_verify(spark, root, ids, id_column).first()
        if verdict["ok"]:
            return {"status": "exists", "path": root, "reason": verdict["reason"]}
    wanted = ids.select(id_column).distinct()
    version = stage(spark, root, {DATA: pin_rows(table, ids, id_column), IDS: wanted})
    base = f"{root}/{version}"
    rows, expected = spark.read.parquet(f"{base}/{DATA}").count(), spark.read.parquet(f"{base}/{IDS}").count()
    if rows != expected:
        raise ValueError(f"expected exactly {expected} rows for the wanted ids, found {rows}")
    file_checksums(spark, f"{base}/{DATA}").write.parquet(f"{base}/{SUMS}")
    activate(spark, root, version)
    return {"status": "created", "path": root, "rows": rows}


def id_set_check(data: DataFrame, recorded: DataFrame, wanted: DataFrame, id_column: str) -> DataFrame:
    """One row of counts: do the table, its provenance and the wanted ids hold the same ids?

    The three sets are stacked and counted per id, so one shuffle answers all of it.
    """
    def tagged(frame: DataFrame, d: int, r: int, w: int) -> DataFrame:
        return frame.select(F.col(id_column).alias("id"), *[F.lit(v).cast("bigint").alias(n) for v, n in ((d, "d"), (r, "r"), (w, "w"))])

    per_id = (
        tagged(data, 1, 0, 0).unionByName(tagged(recorded, 0, 1, 0)).unionByName(tagged(wanted, 0, 0, 1))
        .groupBy("id").agg(F.sum("d").alias("d"), F.max("r").alias("r"), F.max("w").alias("w"))
    )
    return per_id.agg(
        F.coalesce(F.sum("d"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("w"), F.lit(0)).alias("wanted"),
        F.count_if(F.col("r") != F.col("w")).alias("provenance_differs"),
        F.count_if((F.col("w") == 1) & (F.col("d") == 0)).alias("absent"),
        F.count_if((F.col("w") == 0) & (F.col("d") > 0)).alias("unexpected"),
        F.count_if(F.col("d") > 1).alias("repeated"),
    )


def pin_reason(counts: DataFrame) -> DataFrame:
    """(ok, reason) from the counts; ``checksum_differs`` may be present."""
    c = F.col
    checksum = c("checksum_differs") if "checksum_differs" in counts.columns else F.lit(0)
    text = lambda *p: F.concat(*[x.cast("string") if not isinstance(x, str) else F.lit(x) for x in p])
    reason = (
        F.when(c("provenance_differs") > 0, text("provenance ids differ from the wanted ids: ", c("provenance_differs")))
        .when(checksum > 0, text("checksum mismatch in files: ", checksum))
        .when(c("rows") != c("wanted"), text("expected ", c("wanted"), " rows, found ", c("rows")))
        .when((c("absent") > 0) | (c("unexpected") > 0),
              text("ids differ: ", c("absent"), " absent, ", c("unexpected"), " unexpected"))
        .otherwise(F.lit("content verified"))
    )
    return counts.select("*", (reason == "content verified").alias("ok"), reason.alias("reason"))


def pin_verify(spark: SparkSession, root: str, wanted: DataFrame, id_column: str) -> DataFrame:
    """Check a published pinned dataset against the wanted ids and its own checksums."""
    version = current_version(spark, root)
    if version is None:
        return spark.createDataFrame([(False, f"pinned dataset missing: {root}")], "ok boolean, reason string")
    base = f"{root}/{version}"
    data = spark.read.parquet(f"{base}/{DATA}")
    if id_column not in data.columns:
        return spark.createDataFrame([(False, f"pinned table has no {id_column} column")], "ok boolean, reason string")
    actual, stored = file_checksums(spark, f"{base}/{DATA}"), spark.read.parquet(f"{base}/{SUMS}")
    differs = actual.withColumnRenamed("sha256", "now").join(stored, "file", "full_outer").agg(
        F.count_if(~F.col("now").eqNullSafe(F.col("sha256"))).alias("checksum_differs")
    )
    counts = id_set_check(data, spark.read.parquet(f"{base}/{IDS}"), wanted.select(id_column).distinct(), id_column)
    # both are single rows: stack them and take each column's only value
    both = counts.unionByName(differs, allowMissingColumns=True)
    return pin_reason(both.agg(*[F.max(c).alias(c) for c in both.columns]))


def read_pinned(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{current_version(spark, root)}/{DATA}")
