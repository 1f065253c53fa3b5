"""Generation diagnostics per subset and per run.

Everything here is a sum, a count or a maximum, so Spark combines on the map
side and a run with a third of all lines costs no more per task than the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmill.functions.canonical import json_text
from proofmill.operators.evidence import TOKENS, generation_calls

SUBSET = ["run_id", "subset"]
# Stop reasons with a meaning of their own.
TRUNCATED = ["max_tokens", "model_length"]
FILTERED = "content_filter"
UNKNOWN = "unknown"

SUMS = [
    "predicted_lines", "reviewed_lines", "generation_calls", "truncated_calls", "content_filter_calls",
    "unknown_stop_reason_calls", "missing_stop_reason", "usage_samples", "missing_usage", "malformed_lines",
    "agent_samples", "agent_steps",
]
TOKEN_SUMS = ["input_tokens", "output_tokens", "total_tokens"]


def _calls(of: list[str]) -> Column:
    one = F.coalesce(F.get("stop_reasons", 0).isin(of), F.lit(False)).cast("int")  # most lines are one call
    many = F.coalesce(F.size(F.filter("stop_reasons", lambda r: r.isin(of))), F.lit(0))
    return F.sum(F.when(F.size("stop_reasons") == 1, one).otherwise(many)).cast("bigint")


def subset_evidence(evidence: DataFrame) -> DataFrame:
    """Per (run, subset): lines, files, stop reasons, tokens and agent steps.

    Lines are first reduced per file, which also yields the file counts without
    a distinct aggregate.
    """
    usable = F.col("problem").isNull()
    predicted = usable & (F.col("kind") == "predicted")
    reviewed = usable & (F.col("kind") == "reviewed")
    known = F.when(F.size("stop_reasons") == 1, F.get("stop_reasons", 0) != UNKNOWN).otherwise(F.exists("stop_reasons", lambda r: r != UNKNOWN))
    per_file = evidence.groupBy(*SUBSET, "kind", "source").agg(
        F.count_if(predicted).alias("predicted_lines"),
        F.count_if(reviewed).alias("reviewed_lines"),
        F.sum(F.when(predicted, F.size("stop_reasons")).otherwise(0)).alias("generation_calls"),
        _calls(TRUNCATED).alias("truncated_calls"),
        _calls([FILTERED]).alias("content_filter_calls"),
        _calls([UNKNOWN]).alias("unknown_stop_reason_calls"),
        F.count_if(predicted & ~known).alias("missing_stop_reason"),
        F.count_if(predicted & F.col("has_usage")).alias("usage_samples"),
        F.count_if(predicted & ~F.col("has_usage")).alias("missing_usage"),
        F.count_if(~usable).alias("malformed_lines"),
        F.count_if(F.col("steps") > 0).alias("agent_samples"),
        F.coalesce(F.sum("steps"), F.lit(0)).alias("agent_steps"),
        F.max("steps").alias("agent_steps_max"),
        *[F.coalesce(F.sum(t), F.lit(0)).cast(TOKENS).alias(t) for t in TOKEN_SUMS],
    )
    return per_file.groupBy(*SUBSET).agg(
        F.count_if(F.col("kind") == "predicted").alias("predicted_sources"),
        F.count_if(F.col("kind") == "reviewed").alias("reviewed_sources"),
        *[F.sum(c).alias(c) for c in SUMS],
        F.max("agent_steps_max").alias("agent_steps_max"),
        *[F.sum(t).cast(TOKENS).alias(t) for t in TOKEN_SUMS],
    )


def stop_reason_histogram(evidence: DataFrame) -> DataFrame:
    """Calls per (run, subset, stop reason)."""
    return generation_calls(evidence).groupBy(*SUBSET, "stop_reason").agg(F.count(F.lit(1)).alias("calls"))


def stop_reason_counts(evidence: DataFrame) -> DataFrame:
    """(run_id, stop_reason_counts): calls per stop reason of each run as a JSON object, reasons in order."""
    per_run = stop_reason_histogram(evidence).groupBy("run_id", "stop_reason").agg(F.sum("calls").alias("calls"))
    entries = F.sort_array(F.collect_list(F.struct("stop_reason", "calls")))
    listed = per_run.groupBy("run_id").agg(entries.alias("entries"))
    text = F.transform("entries", lambda e: F.concat(json_text(e["stop_reason"]), F.lit(":"), e["calls"].cast("string")))
    return listed.select("run_id", F.concat(F.lit("{"), F.array_join(text, ","), F.lit("}")).alias("stop_reason_counts"))


def usage_totals(evidence: DataFrame) -> DataFrame:
    """Token sums per (run, subset) over prediction lines, with and without usage."""
    lines = evidence.filter((F.col("kind") == "predicted") & F.col("problem").isNull())
    return lines.groupBy(*SUBSET).agg(
        *[F.sum(t).cast(TOKENS).alias(t) for t in TOKEN_SUMS],
        F.count_if("has_usage").alias("usage_samples"),
        F.count_if(~F.col("has_usage")).alias("missing_usage"),
    )


def mean_to_cents(total: Column, count: Column) -> Column:
    """total/count rounded half up to two places in whole-number arithmetic."""
    return F.when(count > 0, F.floor((total * 200 + count) / (count * 2)) / F.lit(100.0))


def run_diagnostics(subsets: DataFrame) -> DataFrame:
    """Per run, from the subset rows."""
    totals = subsets.groupBy("run_id").agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.max("agent_steps_max").alias("agent_steps_max"),
        *[F.sum(t).cast(TOKENS).alias(t) for t in TOKEN_SUMS],
    )
    return totals.select(
        "run_id", "generation_calls", "truncated_calls", "content_filter_calls", "unknown_stop_reason_calls",
        F.col("missing_stop_reason").alias("samples_without_stop_reason"),
        F.col("missing_usage").alias("samples_without_usage"),
        *TOKEN_SUMS, "malformed_lines", "agent_samples", "agent_steps",
        F.when(F.col("agent_samples") > 0, F.col("agent_steps_max")).alias("agent_steps_max"),
        mean_to_cents(F.col("agent_steps"), F.col("agent_samples")).alias("agent_steps_mean"),
    )


def agent_step_stats(evidence: DataFrame) -> DataFrame:
    """Count, total, maximum and mean of agent steps per run; runs without steps are absent."""
    stats = evidence.filter(F.col("steps") > 0).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("samples"), F.sum("steps").alias("total_steps"), F.max("steps").alias("max_steps")
    )
    return stats.withColumn("mean_steps", mean_to_cents(F.col("total_steps"), F.col("samples")))


def diagnostics_json(diagnostics: DataFrame, reasons: DataFrame | None = None) -> DataFrame:
    """(run_id, diagnostics_json) in the form the run history keeps; ``reasons`` are the stop-reason counts by run."""
    if reasons is None:
        diagnostics = diagnostics.withColumn("stop_reason_counts", F.lit(None).cast("string"))
    else:
        diagnostics = diagnostics.join(reasons, "run_id", "left")
    return diagnostics.select(
        "run_id",
        F.to_json(
            F.struct(
                F.from_json("stop_reason_counts", "map<string,bigint>").alias("stop_reason_counts"),
                "generation_calls", "truncated_calls", "content_filter_calls", "unknown_stop_reason_calls",
                "samples_without_stop_reason", "samples_without_usage", "malformed_lines",
                F.struct(*[F.col(t).cast("double").alias(t) for t in TOKEN_SUMS]).alias("usage_totals"),
                F.when(
                    F.col("agent_samples") > 0,
                    F.struct(
                        F.col("agent_samples").alias("count"), F.col("agent_steps").alias("total"),
                        F.col("agent_steps_max").alias("max"), F.col("agent_steps_mean").alias("mean"),
                    ),
                ).alias("agent_steps"),
            )
        ).alias("diagnostics_json"),
    )
