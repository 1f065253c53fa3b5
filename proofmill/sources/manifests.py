"""Run manifests: one ``run_manifest.json`` per attempt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill.functions.canonical import canonical_variant, digest, json_hex, json_list, json_object, json_strings, json_text
from proofmill.schemas import MANIFEST_DETAIL, RUN_MANIFEST
from proofmill.sources.reports import read_documents


def parse_run_manifests(documents: DataFrame) -> DataFrame:
    """Typed manifests from ``path`` and ``document``; free-form members stay JSON text.

    ``computed_identity`` is the identity of the manifest that the document itself holds (``content_identity``);
    ``parse_failure`` names a document that is no JSON object.
    """
    whole = documents.withColumn("__v", F.try_parse_json("document"))
    broken = ~F.coalesce(F.schema_of_variant("__v").startswith("OBJECT"), F.lit(False))
    return whole.select(
        "path", F.from_json("document", RUN_MANIFEST).alias("m"), content_identity(F.col("__v")).alias("computed_identity"),
        F.when(broken, F.lit("manifest_parse_error: not a JSON object")).alias("parse_failure"),
    ).select("path", F.col("m.attempt_id").alias("run_id"), "m.*", "computed_identity", "parse_failure").drop("attempt_id")


def content_identity(document: Column) -> Column:
    """Digest of the canonical text of ``sample_manifest``; where that is absent or empty, of the rows its stored detail gives.

    One rule at every size, worked out in the document's own row. Values keep their JSON kind, so numeric ids stay numbers.
    """
    stored = F.try_variant_get(document, "$.sample_manifest", "variant")
    given = F.to_json(stored)
    detail = F.from_json(F.to_json(F.try_variant_get(document, "$.sample_manifest_detail", "variant")), MANIFEST_DETAIL)

    def listed(samples: Column, name: str) -> Column:
        return digest(json_list(F.transform(samples, lambda x: json_hex(x[name]))))

    def row(entry: Column) -> Column:
        samples = entry["value"]
        return json_object(
            subset=json_text(entry["key"]), selected=F.size(samples).cast("string"),
            sample_ids=json_strings(F.transform(samples, lambda x: x["id"])),
            media_evidence=F.forall(samples, lambda x: F.coalesce(x["media_evidence"], F.lit(True))).cast("string"),
            **{name: json_hex(listed(samples, name)) for name in ("question_digest", "media_digest", "input_digest")},
        )

    rows = F.map_entries(detail)
    return F.when(given.isNotNull() & ~given.isin("null", "[]", "{}", '""', "0", "false"), digest(canonical_variant(stored))).when(
        F.size(rows) > 0, digest(json_list(F.transform(rows, row)))
    )


def scan_run_manifests(spark: SparkSession, root: str) -> DataFrame:
    return parse_run_manifests(read_documents(spark, root, "run_manifest*.json"))


def manifest_samples(manifests: DataFrame) -> DataFrame:
    """Per-sample rows of the stored detail, in their stored order."""
    subsets = manifests.select(
        "run_id",
        F.posexplode(F.map_entries(F.from_json("sample_manifest_detail", MANIFEST_DETAIL))).alias("subset_pos", "entry"),
    )
    return subsets.select(
        "run_id",
        F.col("subset_pos").cast("bigint").alias("subset_pos"),
        F.col("entry.key").alias("subset"),
        F.posexplode("entry.value").alias("pos", "sample"),
    ).select(
        "run_id", "subset", "subset_pos", F.col("pos").cast("bigint").alias("pos"),
        F.col("sample.id").alias("sample_id"),
        *[F.col(f"sample.{n}").alias(n) for n in ("question_digest", "media_digest", "input_digest", "media_evidence")],
    )


def manifest_rows(manifests: DataFrame) -> DataFrame:
    """Stored manifest rows; ``sample_ids`` is kept as canonical JSON."""
    return manifests.select("run_id", F.posexplode("sample_manifest").alias("subset_pos", "row")).select(
        "run_id", F.col("subset_pos").cast("bigint").alias("subset_pos"), "row.subset", "row.selected",
        F.to_json("row.sample_ids").alias("sample_ids_json"),
        "row.question_digest", "row.media_digest", "row.input_digest", "row.media_evidence",
    )
