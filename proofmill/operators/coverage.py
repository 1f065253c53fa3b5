"""Reconciling selected samples, predictions and reviews by key.

All three inputs are stacked and counted per key before anything else, so a key
that repeats a billion times shrinks to one row on the map side. Counting per
key replaces the outer joins the definition suggests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmill.operators.ordered import first_per_group

SUBSET = ["run_id", "subset"]
HEAD = 5  # keys quoted in a reason text; the full lists stay in ``coverage_gaps``

COUNTS = [
    "predicted", "predicted_total", "predicted_missing", "predicted_extra", "predicted_duplicates",
    "reviewed", "reviewed_total", "reviewed_missing", "reviewed_extra", "reviewed_duplicates",
]


def key_counts(evidence: DataFrame) -> DataFrame:
    """Lines per (run, subset, sample, repeat): predicted, reviewed and unusable ones.

    Unusable lines have no sample id and meet in one row per subset, so this
    table alone answers every later coverage question.
    """
    usable = F.col("problem").isNull()
    return evidence.groupBy(*SUBSET, F.when(usable, F.col("sample_id")).alias("sample_id"), "repeat").agg(
        F.count_if(usable & (F.col("kind") == "predicted")).alias("n_predicted"),
        F.count_if(usable & (F.col("kind") == "reviewed")).alias("n_reviewed"),
        F.count_if(~usable).alias("n_malformed"),
    )


def _keys(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("n_malformed") == 0)


def sample_counts(samples: DataFrame, counts: DataFrame) -> DataFrame:
    """Per (run, subset, sample): is it selected, and how its keys meet."""
    has_prediction, has_review = F.col("n_predicted") > 0, F.col("n_reviewed") > 0

    def flag(condition: Column) -> Column:
        return condition.cast("bigint")

    lines = _keys(counts).select(
        *SUBSET, "sample_id",
        F.lit(0).cast("bigint").alias("expected"),
        F.col("n_predicted").alias("predicted_lines"),
        F.col("n_reviewed").alias("reviewed_lines"),
        flag(has_prediction).alias("predicted_keys"),
        flag(has_review).alias("reviewed_keys"),
        flag(has_prediction & has_review).alias("matched_keys"),
    )
    zero = F.lit(0).cast("bigint")
    selected = samples.select(
        *SUBSET, "sample_id", F.lit(1).cast("bigint").alias("expected"),
        *[zero.alias(c) for c in ("predicted_lines", "reviewed_lines", "predicted_keys", "reviewed_keys", "matched_keys")],
    )
    return lines.unionByName(selected).groupBy(*SUBSET, "sample_id").agg(
        F.max("expected").alias("expected"),
        *[F.sum(c).alias(c) for c in ("predicted_lines", "reviewed_lines", "predicted_keys", "reviewed_keys", "matched_keys")],
    )


def subset_coverage(per_sample: DataFrame) -> DataFrame:
    """All coverage counts per (run, subset), for every subset seen on either side.

    Predictions are compared by sample id (any repeat covers the sample); reviews
    are compared with prediction keys including the repeat. Without selected
    samples nothing is missing and every predicted id counts as covered and extra.
    """
    selected, predicted = F.col("expected") == 1, F.col("predicted_keys") > 0
    totals = per_sample.groupBy(*SUBSET).agg(
        F.sum("expected").alias("expected"),
        F.count_if(predicted).alias("bases"),
        F.count_if(selected & predicted).alias("covered"),
        F.count_if(selected & ~predicted).alias("missing"),
        F.count_if(~selected & predicted).alias("extra"),
        *[F.sum(c).alias(c) for c in ("predicted_lines", "reviewed_lines", "predicted_keys", "reviewed_keys", "matched_keys")],
    )
    return totals.select(
        *SUBSET,
        "expected",
        F.when(F.col("expected") == 0, F.col("bases")).otherwise(F.col("covered")).alias("predicted"),
        F.col("predicted_lines").alias("predicted_total"),
        F.col("missing").alias("predicted_missing"),
        F.col("extra").alias("predicted_extra"),
        (F.col("predicted_lines") - F.col("predicted_keys")).alias("predicted_duplicates"),
        F.col("matched_keys").alias("reviewed"),
        F.col("reviewed_lines").alias("reviewed_total"),
        (F.col("predicted_keys") - F.col("matched_keys")).alias("reviewed_missing"),
        (F.col("reviewed_keys") - F.col("matched_keys")).alias("reviewed_extra"),
        (F.col("reviewed_lines") - F.col("reviewed_keys")).alias("reviewed_duplicates"),
    )


def coverage_predicted(samples: DataFrame, evidence: DataFrame) -> DataFrame:
    """Predictions against the selected samples, for subsets with either."""
    predictions = key_counts(evidence.filter(F.col("kind") == "predicted"))
    return subset_coverage(sample_counts(samples, predictions)).select(
        *SUBSET, "predicted", "predicted_total", "predicted_missing", "predicted_extra"
    )


def coverage_reviewed(evidence: DataFrame) -> DataFrame:
    """Reviews against prediction keys; needs no sample table."""
    both, predicted, reviewed = F.least("n_predicted", "n_reviewed") > 0, F.col("n_predicted") > 0, F.col("n_reviewed") > 0
    return _keys(key_counts(evidence)).groupBy(*SUBSET).agg(
        F.count_if(both).alias("reviewed"),
        F.sum("n_reviewed").alias("reviewed_total"),
        F.count_if(predicted & ~reviewed).alias("reviewed_missing"),
        F.count_if(reviewed & ~predicted).alias("reviewed_extra"),
    )


def duplicate_evidence(evidence: DataFrame) -> DataFrame:
    """Repeated keys per (run, subset) and kind: lines beyond the first of each key."""
    return _keys(key_counts(evidence)).groupBy(*SUBSET).agg(
        F.sum(F.greatest(F.col("n_predicted") - 1, F.lit(0))).alias("predicted_duplicates"),
        F.sum(F.greatest(F.col("n_reviewed") - 1, F.lit(0))).alias("reviewed_duplicates"),
    )


def coverage_gaps(per_sample: DataFrame, counts: DataFrame) -> DataFrame:
    """The full lists behind the counts: one row per missing or unexpected key.

    ``kind``/``gap`` name the list; prediction gaps are keyed by sample id,
    review gaps by ``<sample>#r<repeat>``. Takes ``sample_counts`` and ``key_counts``.
    """
    selected, predicted = F.col("expected") == 1, F.col("predicted_keys") > 0
    by_sample = per_sample.filter(selected != predicted).select(
        *SUBSET, F.lit("predicted").alias("kind"),
        F.when(selected, F.lit("missing")).otherwise(F.lit("extra")).alias("gap"),
        F.col("sample_id").alias("key"),
    )
    has_prediction, has_review = F.col("n_predicted") > 0, F.col("n_reviewed") > 0
    by_key = _keys(counts).filter(has_prediction != has_review).select(
        *SUBSET, F.lit("reviewed").alias("kind"),
        F.when(has_prediction, F.lit("missing")).otherwise(F.lit("extra")).alias("gap"),
        F.concat("sample_id", F.lit("#r"), F.col("repeat").cast("string")).alias("key"),
    )
    return by_sample.unionByName(by_key)


def gap_heads(gaps: DataFrame, count: int = HEAD) -> DataFrame:
    """The first keys of every gap list in sorted order, as an array of at most ``count``."""
    head = first_per_group(gaps, [*SUBSET, "kind", "gap"], ["key"], count)
    return head.groupBy(*SUBSET, "kind", "gap").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "key"))), lambda r: r["key"]).alias("keys")
    )


def coverage_merge(manifest: DataFrame, coverage: DataFrame) -> DataFrame:
    """Manifest rows with their coverage; a subset without evidence gets zeros and misses all."""
    joined = manifest.join(coverage.select(*SUBSET, *COUNTS), SUBSET, "left")
    absent = {name: F.lit(0).cast("bigint") for name in COUNTS}
    absent["predicted_missing"] = F.coalesce(F.col("selected"), F.lit(0)).cast("bigint")
    return joined.select(
        *[F.col(c) for c in manifest.columns], *[F.coalesce(F.col(c), absent[c]).alias(c) for c in COUNTS]
    )


def unexpected_subsets(manifest: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence subsets the manifest does not name."""
    seen = evidence.select(*SUBSET).distinct()
    return seen.join(manifest.select(*SUBSET), SUBSET, "left_anti")
