"""Re-importing artifacts: self-check, conflicts with history, downgrades, decision.

A batch holds one artifact per run; a second artifact of the same run belongs
to the next batch, where the first is history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmill.functions.identity import clean_identity
from proofmill.operators.validity import is_formal

# Fields that must not change between imports, as (artifact column, stored column).
IMMUTABLE = ["dataset", "suite", "model_id", "model_config_identity", "protocol_identity", "sample_manifest_identity"]


def artifact_selfcheck(artifacts: DataFrame) -> DataFrame:
    """Does the artifact itself carry the identity it claims?

    Needs model_id, model_config_identity, protocol_identity, declared_identity,
    computed_identity (NULL without manifest content), validity_status,
    status_reason. Adds sample_manifest_identity and identity_inconsistent; an
    artifact whose identity cannot be proven becomes unverified.
    """
    declared, computed = clean_identity(F.col("declared_identity")), F.col("computed_identity")
    missing = [
        F.when(clean_identity(F.col(name)).isNull(), F.lit(f"{name}: <missing>"))
        for name in ("model_id", "model_config_identity", "protocol_identity")
    ]
    missing.append(
        F.when(F.coalesce(declared, computed).isNull(), F.lit("sample_manifest_identity: <missing>"))
        .when(declared.isNotNull() & computed.isNull(), F.lit("sample_manifest_identity: declared without manifest content"))
    )
    checked = artifacts.withColumns(
        {
            "sample_manifest_identity": F.coalesce(declared, computed),
            "identity_inconsistent": F.coalesce(declared != computed, F.lit(False)),
            "__missing": F.array_compact(F.array(*missing)),
        }
    )
    unproven = F.size("__missing") > 0
    note = F.concat(F.lit("import_identity_unverifiable: "), F.array_join("__missing", "; "))
    said = F.coalesce(F.col("status_reason"), F.lit(""))
    return checked.withColumns(
        {
            "status_reason": F.when(unproven, F.when(said != "", F.concat(said, F.lit("; "), note)).otherwise(note)).otherwise(
                F.col("status_reason")
            ),
            "validity_status": F.when(unproven, F.lit("unverified")).otherwise(F.col("validity_status")),
        }
    ).drop("__missing")


def _conflicts(artifact: str, stored: str) -> Column:
    """Array of conflict texts between two aliased rows."""
    found = []
    for name in IMMUTABLE:
        old = clean_identity(F.col(f"{stored}.{name}"))
        new = clean_identity(F.col(f"{artifact}.{name}"))
        if name == "model_id":
            new = F.coalesce(new, clean_identity(F.col(f"{artifact}.report_id")))
        found.append(
            F.when(
                old.isNotNull() & ~old.eqNullSafe(new),
                F.concat(F.lit(f"{name}: db="), old, F.lit(" manifest="), F.coalesce(new, F.lit("<missing>"))),
            )
        )
    return F.array_compact(F.array(*found))


def identity_conflicts(checked: DataFrame, history: DataFrame) -> DataFrame:
    """Artifacts whose identity differs from the stored run, one text per field.

    A stored value with nothing to compare is a conflict; an unknown stored value is not.
    """
    joined = checked.alias("a").join(history.alias("h"), F.col("a.run_id") == F.col("h.run_id"))
    return joined.select(F.col("a.run_id").alias("run_id"), _conflicts("a", "h").alias("conflicts")).filter(
        F.size("conflicts") > 0
    )


def is_downgrade(
    stored_validity: Column, stored_comparability: Column, validity: Column, comparability: Column
) -> Column:
    """An accepted run may only be replaced by a complete one, a formal run only by a formal one."""
    lost = stored_validity.isin("complete", "partial") & ~validity.eqNullSafe("complete")
    unproven = is_formal(stored_validity, stored_comparability) & ~is_formal(validity, comparability)
    return F.coalesce(lost, F.lit(False)) | unproven


def downgrade_guard(checked: DataFrame, history: DataFrame) -> DataFrame:
    """Artifacts that would downgrade a stored run."""
    joined = checked.alias("a").join(history.alias("h"), F.col("a.run_id") == F.col("h.run_id"))
    return joined.filter(
        is_downgrade(
            F.col("h.validity_status"), F.col("h.comparability"), F.col("a.validity_status"), F.col("a.comparability")
        )
    ).select(
        F.col("a.run_id").alias("run_id"),
        F.col("h.validity_status").alias("kept_validity"), F.col("h.comparability").alias("kept_comparability"),
        F.col("a.validity_status").alias("new_validity"), F.col("a.comparability").alias("new_comparability"),
    )


def import_decision(artifacts: DataFrame, history: DataFrame, stored_metrics: DataFrame) -> DataFrame:
    """One decision per artifact: failed, rejected or committed, with what is kept.

    Tests in order: parse failure, self-check, identity conflict, downgrade.
    ``stored_metrics`` are the metric rows of the history.
    """
    checked = artifact_selfcheck(artifacts)
    counts = stored_metrics.groupBy("run_id").agg(F.count(F.lit(1)).alias("metric_rows"))
    joined = (
        checked.alias("a")
        .join(history.alias("h"), F.col("a.run_id") == F.col("h.run_id"), "left")
        .join(counts.alias("c"), F.col("a.run_id") == F.col("c.run_id"), "left")
        .withColumn("conflicts", F.when(F.col("h.run_id").isNotNull(), _conflicts("a", "h")).otherwise(F.array().cast("array<string>")))
    )
    stored = F.col("h.run_id").isNotNull()
    failed = F.col("a.parse_failure").isNotNull()
    inconsistent = F.col("a.identity_inconsistent")
    conflicting = F.size("conflicts") > 0
    downgraded = stored & is_downgrade(
        F.col("h.validity_status"), F.col("h.comparability"), F.col("a.validity_status"), F.col("a.comparability")
    )
    mismatch = F.concat(
        F.lit("identity_conflict: sample_manifest_identity: declared="), F.col("a.declared_identity"),
        F.lit(" computed="), F.col("a.computed_identity"),
    )
    decision = (
        F.when(failed, "failed").when(inconsistent, "rejected_selfcheck").when(conflicting, "rejected_conflict")
        .when(downgraded, "rejected_downgrade").when(stored, "committed_update").otherwise("committed_new")
    )
    reason = (
        F.when(failed, F.col("a.parse_failure")).when(inconsistent, mismatch)
        .when(conflicting, F.concat(F.lit("identity_conflict: "), F.array_join("conflicts", "; ")))
        .otherwise(F.col("a.status_reason"))
    )
    committed = decision.startswith("committed")
    return joined.select(
        F.col("a.run_id").alias("run_id"),
        decision.alias("decision"),
        reason.alias("reason"),
        F.when(~failed, F.when(committed, F.col("a.validity_status")).otherwise(F.col("h.validity_status"))).alias("validity_status"),
        F.when(~failed, F.when(committed, F.col("a.comparability")).otherwise(F.col("h.comparability"))).alias("comparability"),
        F.when(~committed & ~failed & stored, F.coalesce("c.metric_rows", F.lit(0))).alias("metrics_kept"),
        F.when(committed, F.coalesce("h.finished_at", "a.created_at")).alias("finished_at"),
        F.when(committed, F.col("a.sample_manifest_identity")).alias("sample_manifest_identity"),
    )


def split_decisions(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to commit, rows for the audit table)."""
    committed = F.col("decision").startswith("committed")
    return decisions.filter(committed), decisions.filter(~committed)
