"""From evidence to verdicts: the jobs a campaign runs end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmill.functions.identity import clean_identity
from proofmill.operators import coverage, diagnostics, imports, metrics, validity
from proofmill.session import stored


def coverage_tables(runs: DataFrame, samples: DataFrame, manifest_rows: DataFrame, facts: DataFrame) -> dict[str, DataFrame]:
    """Comparability per run (``verdicts``) and what it rests on: ``coverage`` per subset, every missing and unexpected key
    (``gaps``), every unexpected subset, all reasons.

    The facts are read once: everything else comes from their counts per key,
    which are stored because three branches need them.
    """
    counts = stored(coverage.key_counts(facts), "key-counts")
    per_sample = stored(coverage.sample_counts(samples, counts), "sample-counts")
    merged = coverage.coverage_merge(manifest_rows, coverage.subset_coverage(per_sample))
    malformed = counts.groupBy("run_id").agg(F.sum("n_malformed").alias("malformed_lines"))
    gaps = coverage.coverage_gaps(per_sample, counts)
    unexpected = coverage.unexpected_subsets(manifest_rows, counts)
    reasons = validity.comparability_reasons(merged, coverage.gap_heads(gaps), unexpected, malformed)
    return {
        "verdicts": validity.assess_comparability(runs, merged, reasons), "coverage": merged, "gaps": gaps,
        "unexpected_subsets": unexpected, "reasons": reasons,
    }


def coverage_verdicts(runs: DataFrame, samples: DataFrame, manifest_rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Comparability per run from selected samples and the evidence fact table."""
    return coverage_tables(runs, samples, manifest_rows, facts)["verdicts"]


def outcomes(
    runs: DataFrame, samples: DataFrame, manifest_rows: DataFrame, facts: DataFrame, metric_rows: DataFrame
) -> DataFrame:
    """Validity, comparability and diagnostics of each run in one row.

    ``runs`` carries the columns ``assess_run`` needs; score problems and repeated
    metric identities become report errors first.
    """
    bad_scores = metric_rows.filter(F.col("score_problem").isNotNull()).groupBy("run_id").agg(
        F.min("score_problem").alias("bad_score")
    )
    repeated = metrics.duplicate_metric_check(metric_rows).select("run_id", F.col("repeated_identities"))
    checked = (
        runs.join(bad_scores, "run_id", "left").join(repeated, "run_id", "left")
        .withColumns(
            {
                "report_error": F.coalesce(
                    "report_error", "bad_score",
                    F.when(F.col("repeated_identities").isNotNull(), F.lit("duplicate metric identity")),
                ),
                "report_error_kind": F.coalesce(
                    "report_error_kind",
                    F.when(F.col("bad_score").isNotNull() | F.col("repeated_identities").isNotNull(), F.lit("metric_parse_error")),
                ),
            }
        ).drop("bad_score", "repeated_identities")
    )
    valid = validity.assess_run(checked, metric_rows, manifest_rows)
    comparable = coverage_verdicts(runs, samples, manifest_rows, facts)
    told = diagnostics.diagnostics_json(diagnostics.run_diagnostics(diagnostics.subset_evidence(facts)), diagnostics.stop_reason_counts(facts))
    return (
        valid.join(comparable, "run_id").join(told, "run_id", "left")
        .withColumn(
            "status_reason",
            validity.compose_reason(
                F.col("validity_status"), F.col("status_reason"), F.col("comparability"), F.col("comparability_reason")
            ),
        )
    )


def import_batch(manifests: DataFrame, assessed: DataFrame, history: DataFrame, stored_metrics: DataFrame) -> DataFrame:
    """Decide a batch of artifact folders against the history.

    ``manifests`` are parsed run manifests; each carries the identity of its own content.
    ``assessed`` are the outcomes by run id, with ``parse_failure`` where the
    folder could not be read.
    """
    artifacts = (
        manifests.select(
            "run_id", "dataset", "suite", "model_id", "report_id", "model_config_identity", "protocol_identity",
            clean_identity(F.col("sample_manifest_identity")).alias("declared_identity"),
            "computed_identity", F.to_timestamp("created_at").alias("created_at"),
        )
        .join(assessed.select("run_id", "validity_status", "status_reason", "comparability", "parse_failure"), "run_id", "left")
    )
    return imports.import_decision(artifacts, history, stored_metrics)
