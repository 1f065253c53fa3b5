"""Score reports to metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmill.functions.canonical import canonical_variant, json_strings
from proofmill.functions.identity import TOP_CATEGORY_KEY, category_key, metric_key
from proofmill.functions.scalars import count_problem, count_value, score_problem, score_value
from proofmill.sources.reports import metric_members


def dimensions_json(text: Column) -> Column:
    """Canonical JSON of a dimensions object; missing or empty is ``{}``."""
    empty = text.isNull() | text.isin("", "null", "[]", "{}", "0", "false")
    value = F.try_parse_json(text)
    return F.when(empty, F.lit("{}")).otherwise(canonical_variant(value))


def identity_is_valid(name: Column) -> Column:
    return F.coalesce(~name.rlike(r"^(?U)[\s\x1c-\x1f]*$"), F.lit(False))


def report_ownership(runs: DataFrame, documents: DataFrame) -> DataFrame:
    """Find the one report of each run.

    ``runs``: run_id, dataset, pretty_name, report_id. ``documents``: run_id, path,
    dataset_name, model_name, is_report, parse_error. ``result`` is ok, ambiguous,
    mismatch, parse_error or missing, tested in this order.
    """
    # documents shrink to one row per name pair first, so a run with very many files joins as few rows
    named = documents.groupBy("run_id", "dataset_name", "model_name").agg(
        F.count_if("is_report").alias("n_reports"),
        F.count_if("parse_error").alias("n_broken"),
        F.min(F.when(F.col("is_report"), F.col("path"))).alias("path"),
    )
    joined = runs.join(named, "run_id", "left")
    matched = F.coalesce(
        (F.col("model_name") == F.col("report_id"))
        & (
            (F.col("dataset_name") == F.col("dataset"))
            | ((F.col("dataset_name") == F.col("pretty_name")) & (F.col("pretty_name") != ""))
        ),
        F.lit(False),
    )
    none = F.lit(0).cast("bigint")
    counted = joined.groupBy("run_id").agg(
        F.coalesce(F.sum(F.when(matched, F.col("n_reports"))), none).alias("matched"),
        F.coalesce(F.sum("n_reports"), none).alias("reports"),
        F.coalesce(F.sum("n_broken"), none).alias("broken"),
        F.min(F.when(matched, F.col("path"))).alias("report_path"),
    )
    result = (
        F.when(F.col("matched") == 1, "ok").when(F.col("matched") > 1, "ambiguous")
        .when(F.col("reports") > 0, "mismatch").when(F.col("broken") > 0, "parse_error").otherwise("missing")
    )
    return counted.select(
        "run_id", result.alias("result"), "matched", "reports", "broken",
        F.when(F.col("matched") == 1, F.col("report_path")).alias("report_path"),
    )


def metric_flatten(reports: DataFrame) -> DataFrame:
    """Metric rows of each report: the metric, its categories, their subsets.

    ``reports``: run_id, metric_texts and primary_metric_identity (``schemas.REPORT``).
    Identities are worked out once per metric, then one explode walks its levels.
    ``score_problem`` names a bad score, a count that is no whole number, or a member that is no metric; ``pos`` (metric, category, subset) is the order
    of the rows within the report.
    """
    primary = F.col("primary_metric_identity")
    keyed_reports = reports.select(
        "run_id",
        F.when(
            F.coalesce(primary["name"], primary["aggregation"], primary["dimensions"]).isNotNull(),
            metric_key(primary["name"], primary["aggregation"], dimensions_json(primary["dimensions"])),
        ).alias("primary_key"),
        "metric_texts",
    )
    exploded = metric_members(keyed_reports, ["run_id", "primary_key"])
    name, aggregation = F.col("m.identity.name"), F.col("m.identity.aggregation")
    given = lambda col: F.nullif(col, F.lit(""))
    keyed = exploded.withColumn("dimensions_json", dimensions_json(F.col("m.identity.dimensions"))).select(
        "run_id", "primary_key", "m_pos", "m", "dimensions_json",
        metric_key(name, aggregation, F.col("dimensions_json")).alias("metric_key"),
        F.coalesce(given(name), given(F.col("m.legacy_name")), F.lit("metric")).alias("metric_name"),
        identity_is_valid(name).alias("identity_valid"),
        aggregation.alias("aggregation"),
        F.col("m.semantics.kind").alias("semantics_kind"),
        F.col("m.semantics.display_kind").alias("display_kind"),
        F.col("m.semantics.direction").alias("direction"),
        F.coalesce(given(F.col("m.semantics.display_unit")), F.col("m.semantics.raw_unit")).alias("unit"),
        F.when(F.col("m").isNull() | F.col("m.damaged").isNotNull(), F.lit("metric does not have the shape of one")).alias("shape_problem"),
    )

    def row(num, score, macro, where, category, subset, order):
        fields = {
            "num_text": num, "score_text": score, "macro_text": macro, "place": where, "category": category, "subset": subset, "pos": order,
        }
        return F.named_struct(*[part for name, value in fields.items() for part in (F.lit(name), value)])

    place = F.concat(F.lit("metrics["), F.col("m_pos").cast("string"), F.lit("]"))
    no_path = F.array().cast("array<string>")
    none = F.lit(None).cast("string")
    at = lambda cat, sub: (
        F.struct(F.col("m_pos").cast("bigint").alias("metric"), cat.cast("bigint").alias("category"), sub.cast("bigint").alias("subset"))
    )
    base = row(F.col("m.num"), F.col("m.score"), F.col("m.macro_score"), place, no_path, F.lit(""), at(F.lit(0), F.lit(0)))

    def category_rows(category: Column, index: Column) -> Column:
        path = F.coalesce(category["name"], no_path)
        where = F.concat(place, F.lit(".categories["), index.cast("string"), F.lit("]"))
        own = row(category["num"], category["score"], category["macro_score"], where, path, F.lit(""), at(index + 1, F.lit(0)))
        subsets = F.transform(
            F.coalesce(category["subsets"], F.array()),
            lambda s, i: row(
                s["num"], s["score"], none, F.concat(where, F.lit(".subsets")), path,
                F.coalesce(s["name"], F.lit("")), at(index + 1, i + 1),
            ),
        )
        return F.concat(F.array(own), subsets)

    categories = F.flatten(F.transform(F.coalesce(F.col("m.categories"), F.array()), category_rows))
    levels = F.when(F.size("m.categories") > 0, F.concat(F.array(base), categories)).otherwise(F.array(base))
    rows = keyed.select(*[c for c in keyed.columns if c not in ("m", "m_pos")], F.inline(levels))
    return rows.select(
        "run_id", "metric_key", "metric_name", "identity_valid", "aggregation", "dimensions_json", "semantics_kind",
        "display_kind", "direction", "unit",
        F.col("metric_key").eqNullSafe(F.col("primary_key")).alias("is_primary"),
        F.when(F.size("category") == 0, F.lit(TOP_CATEGORY_KEY)).otherwise(category_key(F.col("category"))).alias("category_key"),
        json_strings(F.col("category")).alias("category_json"),
        "subset", count_value(F.col("num_text")).alias("num"), "pos", "place",
        score_value(F.col("score_text")).alias("score"),
        score_value(F.col("macro_text")).alias("macro_score"),
        F.coalesce(
            F.concat("place", F.lit(".score: "), score_problem(F.col("score_text"))),
            F.concat("place", F.lit(".macro_score: "), score_problem(F.col("macro_text"))),
            F.concat("place", F.lit(".num: "), count_problem(F.col("num_text"))),
            F.concat("place", F.lit(": "), F.col("shape_problem")),
        ).alias("score_problem"),
    )


def coerce_score(scores: DataFrame, raw: str = "score_text", where: str = "place") -> DataFrame:
    """Add ``score`` and ``score_error`` for a text score; NULL stays NULL and is no error."""
    value = F.col(raw)
    return scores.select(
        "*", score_value(value).alias("score"), F.concat(F.col(where), F.lit(": "), score_problem(value)).alias("score_error")
    )


def duplicate_metrics(metrics: DataFrame) -> DataFrame:
    """Rows of one run that share metric, category and subset, with their count."""
    return (
        metrics.groupBy("run_id", "metric_key", "category_key", "subset")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def duplicate_metric_check(metrics: DataFrame) -> DataFrame:
    """Runs whose report repeats a metric identity, with how many and how often."""
    return duplicate_metrics(metrics).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("repeated_identities"), F.sum(F.col("copies") - 1).alias("surplus_rows")
    )
