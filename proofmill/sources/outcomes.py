"""Outcome documents, the import audit, and the performance block of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofmill.operators.imports import split_decisions


def outcome_documents(outcomes: DataFrame) -> DataFrame:
    """(run_id, document): each run's outcome as one JSON object with its members in order; missing values are left out."""
    members = [F.col(f"`{c}`") for c in sorted(outcomes.columns)]
    return outcomes.select("run_id", F.to_json(F.struct(*members)).alias("document"))


def write_evidence_json(outcomes: DataFrame, decisions: DataFrame, root: str) -> None:
    """Outcome documents of the committed runs, one per line, and the rejected or failed ones as audit rows.

    ``<root>/outcomes`` is written anew with the batch; ``<root>/import_audit`` only grows: a run that is refused again gets
    another row with its time. Rows are clustered by run, so one run's document is found in one file.
    """
    committed, audit = split_decisions(decisions)
    documents = outcome_documents(outcomes.join(committed.select("run_id"), "run_id", "left_semi"))
    documents.hint("rebalance", "run_id").sortWithinPartitions("run_id").write.mode("overwrite").parquet(f"{root}/outcomes")
    audit.withColumn("audited_at", F.current_timestamp()).write.mode("append").parquet(f"{root}/import_audit")


def carry_performance(outcomes: DataFrame, reports: DataFrame) -> DataFrame:
    """Outcomes with ``perf_json``: the performance block of the run's report, kept as it is written."""
    blocks = reports.filter(F.col("perf_metrics").isNotNull()).groupBy("run_id").agg(F.min("perf_metrics").alias("perf_json"))
    kept = outcomes.drop("perf_json")
    return kept.join(blocks, "run_id", "left")


def performance_values(runs: DataFrame) -> DataFrame:
    """Long form of ``perf_json``: (run_id, measure, statistic, value). A measure that is a plain number has no statistic."""
    top = F.from_json("perf_json", "map<string,string>")
    measures = runs.select("run_id", F.explode(top).alias("measure", "body"))
    parts = F.from_json("body", "map<string,string>")
    none = F.lit(None).cast("string")
    listed = F.when(F.col("body").startswith("{"), F.map_entries(parts)).otherwise(F.array(F.struct(none.alias("key"), F.col("body").alias("value"))))
    rows = measures.select("run_id", "measure", F.inline(listed).alias("statistic", "text"))
    return rows.select("run_id", "measure", "statistic", F.col("text").try_cast("double").alias("value"))
