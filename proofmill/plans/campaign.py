"""Import of a whole campaign: every attempt folder below a root, in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill.operators import evidence, metrics
from proofmill.plans import verdicts
from proofmill.session import stored
from proofmill.sources import attempts, manifests
from proofmill.sources.lines import not_blank


def read_campaign(spark: SparkSession, root: str, pattern: str | None = None, archive: bool = False) -> dict[str, DataFrame]:
    """``manifests``, ``reports`` (by run) and ``lines`` (of each run's own model) of all attempts below ``root``.

    ``pattern`` names the files where documents and lines are folders of part files; with ``archive``, ``root`` is one
    (``attempts.write_archive``). Manifests are stored, since runs, samples and decisions all start from them.
    """
    given = {"archive": archive} | ({} if pattern is None else {"pattern": pattern})
    told = stored(attempts.scan_attempt_manifests(spark, root, **given), "manifests")
    owners = told.select("attempt", "run_id", "dataset", "report_id")
    reports = attempts.scan_attempt_reports(spark, root, **given).join(owners.select("attempt", "run_id"), "attempt")
    lines = attempts.scan_attempt_folders(spark, root, owners, numbered=True, **given)
    return {"manifests": told, "reports": reports, "lines": lines}


def campaign_outcomes(campaign: dict[str, DataFrame]) -> DataFrame:
    """Verdict of every attempt, with ``parse_failure`` where its manifest or report cannot be read."""
    told = campaign["manifests"]
    reports = stored(campaign["reports"], "reports")
    asked = told.select("run_id", "dataset", F.lit(None).cast("string").alias("pretty_name"), "report_id")
    owned = metrics.report_ownership(asked, reports)
    matched = reports.join(owned.where("result = 'ok'").select("run_id", F.col("report_path").alias("path")), ["run_id", "path"])
    none = F.lit(None).cast("string")
    runs = owned.join(matched.select("run_id", "execution_summary"), "run_id", "left").select(
        "run_id", F.lit(False).alias("interrupted"), none.alias("task_error"),
        F.when(F.col("result") != "ok", F.col("result")).alias("report_error_kind"), none.alias("report_error"), "execution_summary",
    )
    rows = manifests.manifest_rows(told)
    samples = told.select("run_id", F.inline("sample_manifest")).select("run_id", "subset", F.explode("sample_ids").alias("sample_id"))
    usable = campaign["lines"].where(not_blank(F.col("line")))
    facts = stored(evidence.typed_evidence(usable), "evidence")
    assessed = verdicts.outcomes(runs, samples, rows, facts, metrics.metric_flatten(matched))
    unread = told.select("run_id", F.col("parse_failure").alias("manifest_failure"))
    report = F.when(F.col("status_reason").rlike("^report_"), F.concat(F.lit("ReportError: "), F.col("status_reason")))
    return assessed.join(unread, "run_id", "left").withColumn("parse_failure", F.coalesce("manifest_failure", report)).drop("manifest_failure")


def import_campaign(
    spark: SparkSession, root: str, history: DataFrame, stored_metrics: DataFrame, pattern: str | None = None, archive: bool = False
) -> DataFrame:
    """One import decision per attempt folder below ``root``, against the history."""
    campaign = read_campaign(spark, root, pattern, archive)
    assessed = stored(campaign_outcomes(campaign), "outcomes")
    return verdicts.import_batch(campaign["manifests"], assessed, history, stored_metrics)
