"""The planned run matrix and what has been covered of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BATCH = 4


def resolve_limit(cli_limit: int | None, profile: str, pinned: Column, full_limit: Column, profile_limit: int | None) -> Column:
    """Samples per subset: the caller's limit, one for pinned data, the full cap, or the profile's."""
    if cli_limit is not None:
        return F.lit(cli_limit).cast("bigint")
    rest = full_limit if profile == "full" else F.lit(profile_limit)
    return F.when(F.coalesce(pinned, F.lit(False)), F.lit(1)).otherwise(rest).cast("bigint")


def expand_plan(
    selection: DataFrame,
    suites: DataFrame,
    datasets: DataFrame,
    profile: str,
    profile_limit: int | None = None,
    cli_limit: int | None = None,
    cli_batch: int | None = None,
    default_batch: int | None = None,
    include_extensions: bool = False,
    explicit: DataFrame | None = None,
) -> DataFrame:
    """Expected runs: each selected model with every dataset of its selected suites.

    ``selection``: model_alias, model_pos, suite. ``suites``: suite, suite_pos,
    batch_size, sandbox. ``datasets``: suite, dataset, dataset_pos, core, pinned,
    full_limit, batch_size, sandbox. ``explicit`` (dataset) overrides the core
    filter. All joins are on the suite.
    """
    chosen = datasets
    if explicit is not None:
        chosen = chosen.join(explicit.select("dataset").distinct(), "dataset", "left_semi")
    elif not include_extensions:
        chosen = chosen.filter(F.coalesce("core", F.lit(False)))
    models = selection.groupBy("model_alias", "suite").agg(F.min("model_pos").alias("model_pos"))
    policy = suites.select(
        "suite", "suite_pos", F.col("batch_size").alias("suite_batch"), F.col("sandbox").alias("suite_sandbox")
    )
    joined = chosen.join(policy, "suite").join(models, "suite")
    pinned = F.coalesce("pinned", F.lit(False))
    return joined.select(
        "model_alias", "suite", "dataset", "model_pos", "suite_pos", "dataset_pos",
        F.lit(profile).alias("profile"),
        resolve_limit(cli_limit, profile, pinned, F.col("full_limit"), profile_limit).alias("sample_limit"),
        F.coalesce(
            F.lit(cli_batch), F.col("batch_size"), F.col("suite_batch"), F.lit(default_batch), F.lit(DEFAULT_BATCH)
        ).cast("bigint").alias("batch_size"),
        F.coalesce("sandbox", "suite_sandbox").alias("sandbox"),
        pinned.alias("pinned"),
    )


def plan_coverage(plan: DataFrame, runs: DataFrame, allow_partial: bool = False) -> DataFrame:
    """Planned entries with their attempts and whether an acceptable run exists."""
    accepted = ["complete", "partial"] if allow_partial else ["complete"]
    acceptable = (F.col("execution_status") == "completed") & F.col("validity_status").isin(accepted)
    seen = runs.groupBy("model_alias", "dataset").agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(acceptable).alias("acceptable_runs")
    )
    return plan.select("model_alias", "suite", "dataset").join(seen, ["model_alias", "dataset"], "left").select(
        "model_alias", "suite", "dataset",
        F.coalesce("attempts", F.lit(0)).alias("attempts"),
        F.coalesce("acceptable_runs", F.lit(0)).alias("acceptable_runs"),
        (F.coalesce("acceptable_runs", F.lit(0)) > 0).alias("covered"),
    )
