"""Run history: insert-only attempts, outcomes, child rows, old formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmill.functions.identity import clean_identity
from proofmill.sources.tables import BUCKETS, read_table

OVERWRITTEN = [
    "execution_status", "validity_status", "status_reason", "phase", "comparability", "num_requested",
    "num_succeeded", "num_errored", "incomplete", "report_path", "diagnostics_json", "perf_json", "error",
    "primary_metric_json",
]
KEPT_WHEN_MISSING = ["finished_at", "imported_at"]
IDENTITIES = ["protocol_identity", "sample_manifest_identity", "model_id", "model_config_identity"]


def insert_attempts(existing: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    """Decide an insert-only batch: one row per run id, never replacing a stored run.

    The first row (by ``order``) of an unknown run id is inserted; every other row
    counts as rejected. Returns the row's columns, ``inserted`` and ``rejected_rows``.
    """
    columns = [c for c in new.columns if c != "run_id"]
    first = F.struct(*columns)
    batch = new.groupBy("run_id").agg(
        F.min_by(first, F.struct(*order)).alias("row"), F.count(F.lit(1)).alias("n")
    )
    known = existing.select("run_id", F.lit(True).alias("known"))
    decided = batch.join(known, "run_id", "left").withColumn("inserted", F.col("known").isNull())
    return decided.select(
        "run_id", "row.*", "inserted", (F.col("n") - F.col("inserted").cast("bigint")).alias("rejected_rows")
    )


def upsert_outcome(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Write outcomes into the run table.

    Result columns are overwritten, completion and import times survive a missing
    new value, an identity is filled only while the stored one is unknown, and
    everything else of a stored run stays. An outcome without a stored run
    becomes a new run.
    """
    old, new = runs.alias("o"), outcomes.alias("n")
    joined = old.join(new, F.col("o.run_id") == F.col("n.run_id"), "full_outer")
    has_new = F.col("n.run_id").isNotNull()
    has_old = F.col("o.run_id").isNotNull()
    columns = [F.coalesce("o.run_id", "n.run_id").alias("run_id")]
    for name in runs.columns:
        if name == "run_id":
            continue
        stored = F.col(f"o.{name}")
        given = F.col(f"n.{name}") if name in outcomes.columns else F.lit(None).cast(runs.schema[name].dataType)
        if name in OVERWRITTEN:
            value = F.when(has_new, given).otherwise(stored)
        elif name in KEPT_WHEN_MISSING:
            value = F.coalesce(given, stored)
        elif name in IDENTITIES:
            value = F.when(has_new, F.coalesce(clean_identity(stored), clean_identity(given))).otherwise(stored)
        else:
            value = F.when(has_old, stored).otherwise(given)
        columns.append(value.alias(name))
    return joined.select(*columns)


def replace_children(stored: DataFrame, new: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Child rows after the outcomes: those of rewritten runs are replaced, the rest stay."""
    kept = stored.join(outcomes.select("run_id"), "run_id", "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def add_columns(table: DataFrame, schema: str) -> DataFrame:
    """The table with every column of ``schema``, in its order; missing ones are NULL.

    Columns the schema does not know stay at the end. Doing it twice changes nothing.
    """
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    named = [
        (F.col(f.name) if f.name in table.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted.fields
    ]
    extra = [c for c in table.columns if c not in wanted.fieldNames()]
    return table.select(*named, *extra)


def migrate_runs_v1(old: DataFrame, existing: DataFrame) -> DataFrame:
    """Version-1 runs as legacy rows: success is legacy evidence, anything else is invalid."""
    success = F.coalesce(F.col("status") == "success", F.lit(False))
    moved = old.select(
        "run_id", "run_group", F.col("model").alias("model_alias"), "suite", "profile", "dataset",
        F.when(success, F.lit("completed")).otherwise(F.coalesce("status", F.lit("None"))).alias("execution_status"),
        F.when(success, F.lit("legacy")).otherwise(F.lit("invalid")).alias("validity_status"),
        F.lit("migrated from v1").alias("status_reason"),
        F.lit("legacy").alias("phase"),
        F.lit("legacy").alias("comparability"),
        "started_at", "finished_at", "num_requested", "num_succeeded", "num_errored", "incomplete",
        F.col("version").alias("harness_version"),
        F.lit("0.1.0").alias("tool_version"),
        "git_commit", "output_dir", "config_json", "error",
    )
    return moved.join(existing.select("run_id"), "run_id", "left_anti")


def migrate_metrics_v1(old: DataFrame, existing: DataFrame) -> DataFrame:
    """Version-1 metrics under ``legacy:`` keys; a key already stored wins."""
    key = ["run_id", "metric_key", "category_key", "subset"]
    label = F.coalesce(F.col("category"), F.lit("None"))
    moved = old.filter(F.col("metric").isNotNull() & F.col("subset").isNotNull()).select(
        "run_id", F.concat(F.lit("legacy:"), "metric").alias("metric_key"), F.col("metric").alias("metric_name"),
        F.concat(F.lit("legacy:"), label).alias("category_key"),
        F.to_json(F.array("category")).alias("category_json"),
        "subset", "num", "score", "macro_score", F.lit(False).alias("is_primary"), "pos",
    )
    rest = [c for c in moved.columns if c not in key]
    first = moved.groupBy(*key).agg(F.min_by(F.struct(*rest), "pos").alias("r")).select(*key, "r.*").drop("pos")
    return first.join(existing.select(*key), key, "left_anti")


def migrate_samples_v1(old: DataFrame, existing: DataFrame) -> DataFrame:
    """Version-1 id lists as one ``legacy`` subset; the count is NULL when the list is unreadable."""
    ids = F.try_parse_json("sample_ids")
    kind = F.schema_of_variant(ids)
    lists = F.map_values(F.try_variant_get(ids, "$", "map<string,variant>"))
    in_lists = F.aggregate(
        lists, F.lit(0).cast("bigint"),
        lambda acc, v: acc + F.coalesce(F.size(F.try_variant_get(v, "$", "array<variant>")), F.lit(0)),
    )
    counted = old.select(
        "run_id", F.lit("legacy").alias("subset"),
        F.when(kind.startswith("OBJECT"), in_lists)
        .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(ids, "$", "array<variant>")).cast("bigint"))
        .alias("selected"),
        F.col("sample_ids").alias("sample_ids_json"),
        F.lit(False).alias("media_evidence"),
        "dataset",
    )
    rest = F.struct("selected", "sample_ids_json", "media_evidence")
    first = counted.groupBy("run_id", "subset").agg(F.min_by(rest, "dataset").alias("r")).select("run_id", "subset", "r.*")
    return first.join(existing.select("run_id", "subset"), ["run_id", "subset"], "left_anti")


def get_attempt(spark: SparkSession, root: str, run_id: str, buckets: int = BUCKETS) -> DataFrame:
    """The stored run, from its key bucket alone."""
    return read_table(spark, root, "runs", [run_id], buckets).filter(F.col("run_id") == run_id)


def latest_extra(spark: SparkSession, root: str, run_id: str, buckets: int = BUCKETS) -> DataFrame:
    """The run's manifest rows in order of subset, from its key bucket alone; a run's subsets are few."""
    rows = read_table(spark, root, "sample_manifest", [run_id], buckets).filter(F.col("run_id") == run_id)
    return rows.orderBy("subset")
