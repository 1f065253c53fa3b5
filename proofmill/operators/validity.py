"""Validity and comparability verdicts per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmill.functions.scalars import whole_number
from proofmill.operators.ordered import first_per_group

# Reasons spelled out in one text; ``comparability_reasons`` keeps all of them.


def is_formal(validity: Column, comparability: Column) -> Column:
    """Complete and verified: the one rule for the formal table."""
    return F.coalesce((validity == "complete") & (comparability == "verified"), F.lit(False))


def metric_facts(metrics: DataFrame) -> DataFrame:
    """Per run: how many metric rows of each kind, and the first primary row."""
    kind = F.col("semantics_kind")
    first_primary = F.struct("metric_name", "metric_key", "identity_valid", "semantics_kind", "score", "num")
    return metrics.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("metric_rows"),
        F.count_if(kind == "quality").alias("quality_rows"),
        F.count_if(kind.isNotNull() & (kind != "")).alias("semantic_rows"),
        F.min_by(first_primary, F.when(F.col("is_primary"), F.col("pos"))).alias("primary"),
    )


def _summary_columns(text: Column) -> dict[str, Column]:
    value = F.try_parse_json(text)
    kind = F.schema_of_variant(value)
    raw = {n: F.try_variant_get(value, f"$.{n}", "variant") for n in ("requested", "succeeded", "errored", "incomplete")}
    given = {n: v.isNotNull() & ~F.is_variant_null(v) for n, v in raw.items()}
    is_object = kind.startswith("OBJECT")
    type_name = (
        F.when(kind.startswith("ARRAY"), "list").when(kind == "BIGINT", "int").when(kind == "BOOLEAN", "bool")
        .when(kind.startswith("DECIMAL") | (kind == "DOUBLE"), "float").otherwise("str")
    )
    empty = (
        text.isNull() | text.isin("", "{}", "[]", "0", "false", "null", '""')
        | F.coalesce((is_object & (F.size(F.try_variant_get(value, "$", "map<string,variant>")) == 0)), F.lit(False))
        | F.coalesce((kind.startswith("ARRAY") & (F.size(F.try_variant_get(value, "$", "array<variant>")) == 0)), F.lit(False))
    )
    flag = raw["incomplete"]
    flag_kind = F.schema_of_variant(flag)
    flag_value = F.when(flag_kind == "BOOLEAN", F.try_variant_get(flag, "$", "boolean").cast("double")).when(
        flag_kind.rlike("^(BIGINT|DECIMAL|DOUBLE)"), F.try_variant_get(flag, "$", "double")
    )
    return {
        "es_missing": empty,
        "es_object": F.coalesce(is_object, F.lit(False)),
        "es_type": type_name,
        **{f"es_{n}": whole_number(raw[n]) for n in ("requested", "succeeded", "errored")},
        "es_not_whole": F.coalesce(
            (given["requested"] & whole_number(raw["requested"]).isNull())
            | (given["succeeded"] & whole_number(raw["succeeded"]).isNull())
            | (given["errored"] & whole_number(raw["errored"]).isNull()),
            F.lit(False),
        ),
        "es_bad_flag": F.coalesce(given["incomplete"] & ~F.coalesce(flag_value.isin(0.0, 1.0), F.lit(False)), F.lit(False)),
        "es_incomplete": F.coalesce(flag_value == 1.0, F.lit(False)),
    }


def assess_run(runs: DataFrame, metrics: DataFrame, manifest: DataFrame) -> DataFrame:
    """First rule that fires decides (execution_status, validity_status, status_reason).

    ``runs``: run_id, interrupted, task_error, report_error_kind, report_error,
    execution_summary (JSON text). ``metrics``: pos and the metric columns.
    ``manifest``: run_id, selected. A zero score is a valid result; a missing
    one is not usable.
    """
    selected = manifest.groupBy("run_id").agg(
        F.sum(F.coalesce("selected", F.lit(0))).alias("selected"), F.count(F.lit(1)).alias("manifest_rows")
    )
    facts = (
        runs.join(metric_facts(metrics), "run_id", "left")
        .join(selected, "run_id", "left")
        .withColumns(_summary_columns(F.col("execution_summary")))
    )
    c = F.col
    requested, succeeded = c("es_requested"), c("es_succeeded")
    errored = F.coalesce(c("es_errored"), F.lit(0))
    name = F.coalesce(c("primary.metric_name"), F.lit("None"))
    num = c("primary.num")

    def text(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    def number(value: Column) -> Column:
        return value.cast("string")

    blank = lambda col: col.isNull() | (col == "")
    rules: list[tuple[Column, str, Column]] = [
        (F.coalesce(c("report_error_kind"), F.lit("")) != "", "invalid",
         text("report_", c("report_error_kind"),
              F.when(F.coalesce(c("report_error"), F.lit("")) != "", text(": ", c("report_error"))).otherwise(F.lit("")))),
        (F.coalesce(c("metric_rows"), F.lit(0)) == 0, "invalid", text("no_metrics")),
        ((c("quality_rows") == 0) & (c("semantic_rows") > 0), "invalid",
         text("no_quality_metric: only diagnostic metrics were reported")),
        (c("quality_rows") == 0, "invalid", text("metric_semantics_missing")),
        (c("primary").isNull(), "unverified", text("missing_primary_metric: no primary metric identity in the report")),
        (~c("primary.semantics_kind").eqNullSafe("quality"), "invalid", text("primary_metric_not_quality: ", name)),
        (blank(c("primary.metric_name")) | blank(c("primary.metric_key")), "invalid", text("primary_metric_invalid_identity")),
        (c("primary.identity_valid").eqNullSafe(False), "invalid",
         text("primary_metric_invalid_identity: report identity has no name")),
        (c("primary.score").isNull(), "unverified", text("primary_metric_missing_score: ", name)),
        (num.isNull() | (num <= 0), "unverified",
         text("primary_metric_no_samples: ", F.coalesce(number(num), F.lit("None")))),
        (c("es_missing"), "unverified", text("missing_execution_summary")),
        (~c("es_object"), "unverified", text("invalid_execution_summary: ", c("es_type"))),
        (c("es_not_whole"), "unverified", text("invalid_execution_summary: counts must be integers")),
        (c("es_bad_flag"), "unverified", text("invalid_execution_summary: incomplete must be a boolean")),
        ((requested < 0) | (succeeded < 0) | (errored < 0), "unverified",
         text("inconsistent_execution_summary: negative counts")),
        (succeeded > requested, "unverified",
         text("inconsistent_execution_summary: succeeded=", number(succeeded), " > requested=", number(requested))),
        (errored > requested, "unverified",
         text("inconsistent_execution_summary: errored=", number(errored), " > requested=", number(requested))),
        (succeeded + errored > requested, "unverified",
         text("inconsistent_execution_summary: succeeded+errored=", number(succeeded + errored), " > requested=", number(requested))),
        (requested.isNull() | (requested <= 0), "unverified", text("no_requested_samples")),
        ((c("manifest_rows") > 0) & (requested > c("selected")), "unverified",
         text("requested_exceeds_manifest: requested=", number(requested), " selected=", number(c("selected")))),
        (succeeded.isNull(), "unverified", text("missing_succeeded_count")),
        (succeeded <= 0, "invalid", text("all_samples_failed: requested=", number(requested), " errored=", number(errored))),
        ((errored != 0) | (succeeded < requested), "partial",
         text("partial_completion: succeeded=", number(succeeded), "/", number(requested), " errored=", number(errored))),
        (c("es_incomplete"), "partial", text("upstream_marked_incomplete")),
        (num > succeeded, "unverified",
         text("primary_metric_count_exceeds_succeeded: metric_num=", number(num), " succeeded=", number(succeeded))),
    ]

    def verdict(execution: str, validity: str, reason: Column) -> Column:
        return F.struct(
            F.lit(execution).alias("execution_status"), F.lit(validity).alias("validity_status"), reason.alias("status_reason")
        )

    task_error = F.coalesce(c("task_error"), F.lit(""))
    ladder = F.when(F.coalesce(c("interrupted"), F.lit(False)), verdict("interrupted", "invalid", F.lit("interrupted by user")))
    ladder = ladder.when(task_error != "", verdict("failed", "invalid", text("task_error: ", task_error)))
    for condition, validity, reason in rules:
        ladder = ladder.when(condition, verdict("completed", validity, reason))
    ladder = ladder.otherwise(
        verdict("completed", "complete", text("complete: succeeded=", number(succeeded), "/", number(requested)))
    )
    return facts.select(
        *runs.columns,
        ladder.alias("__verdict"),
        requested.alias("num_requested"), succeeded.alias("num_succeeded"), c("es_errored").alias("num_errored"),
        c("es_incomplete").alias("incomplete"),
    ).select("*", "__verdict.*").drop("__verdict")


def _listed(keys: Column) -> Column:
    """Keys as a bracketed, quoted list."""
    return F.concat(F.lit("['"), F.array_join(keys, "', '"), F.lit("']"))


def comparability_reasons(
    manifest: DataFrame, gap_heads: DataFrame, unexpected: DataFrame, malformed: DataFrame
) -> DataFrame:
    """All reasons against comparability: (run_id, ord, subset, item, reason).

    ``manifest`` has its coverage columns (NULL in rows kept before coverage was
    stored); ``gap_heads`` are the first keys of each gap list; ``malformed`` is
    the summary per run.
    """
    c = F.col
    heads = gap_heads.groupBy("run_id", "subset").agg(
        *[
            F.max(F.when((c("kind") == kind) & (c("gap") == gap), _listed(c("keys")))).alias(f"{kind}_{gap}_keys")
            for kind in ("predicted", "reviewed") for gap in ("missing", "extra")
        ]
    )
    rows = manifest.join(heads, ["run_id", "subset"], "left")
    prefix = F.concat(c("subset"), F.lit(": "))
    blank = lambda col: col.isNull() | (col == "")
    has_diffs = F.coalesce("predicted_missing", "predicted_extra", "reviewed_missing", "reviewed_extra").isNotNull()
    selected = F.coalesce(c("selected"), F.lit(0))

    def when(condition: Column, *parts) -> Column:
        return F.when(condition, F.concat(prefix, *[p if isinstance(p, Column) else F.lit(p) for p in parts]))

    items = [
        when(blank(c("question_digest")) | blank(c("input_digest")), "missing content digest"),
        when(~F.coalesce(c("media_evidence"), F.lit(True)), "media content not verifiable"),
        when(~has_diffs & (c("predicted").isNull() | c("reviewed").isNull()), "coverage unknown"),
        when(~has_diffs & ((c("predicted") < selected) | (c("reviewed") < selected)),
             "coverage gap predicted=", c("predicted").cast("string"), " reviewed=", c("reviewed").cast("string"),
             "/", selected.cast("string")),
    ]
    for kind in ("predicted", "reviewed"):
        items += [
            when(c(f"{kind}_missing") > 0, f"{kind} missing evidence keys ", F.coalesce(c(f"{kind}_missing_keys"), F.lit("[]"))),
            when(c(f"{kind}_extra") > 0, f"{kind} unexpected evidence keys ", F.coalesce(c(f"{kind}_extra_keys"), F.lit("[]"))),
            when(c(f"{kind}_duplicates") > 0, f"{kind} duplicate evidence keys x", c(f"{kind}_duplicates").cast("string")),
        ]
    per_row = rows.select(
        "run_id", (c("subset_pos") + 2).alias("ord"), "subset", F.posexplode(F.array(*items)).alias("item", "reason")
    ).filter(c("reason").isNotNull())

    first_subsets = first_per_group(unexpected.select("run_id", "subset"), ["run_id"], ["subset"], 5)
    surprising = first_subsets.groupBy("run_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "subset"))), lambda r: r["subset"]).alias("names")
    )
    at_front = lambda ord_, reason: [
        c("run_id"), F.lit(ord_).cast("bigint").alias("ord"), F.lit("").alias("subset"), F.lit(0).alias("item"),
        reason.alias("reason"),
    ]
    return (
        per_row.unionByName(
            surprising.select(*at_front(0, F.concat(F.lit("unexpected evidence subsets: "), _listed(c("names")))))
        ).unionByName(
            malformed.filter(c("malformed_lines") > 0).select(
                *at_front(1, F.concat(c("malformed_lines").cast("string"), F.lit(" malformed evidence line(s)")))
            )
        )
    )


def assess_comparability(runs: DataFrame, manifest: DataFrame, reasons: DataFrame) -> DataFrame:
    """Per run: verified only with a manifest and without any reason against it. All reasons are told."""
    told = reasons.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_reasons"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("ord", "subset", "item", "reason"))), lambda r: r["reason"]), "; "
        ).alias("said"),
    )
    known = manifest.groupBy("run_id").agg(F.count(F.lit(1)).alias("manifest_rows"))
    joined = runs.select("run_id").join(known, "run_id", "left").join(told, "run_id", "left")
    n = F.coalesce(F.col("n_reasons"), F.lit(0))
    no_manifest = F.col("manifest_rows").isNull()
    return joined.select(
        "run_id",
        F.when(no_manifest | (n > 0), F.lit("unknown")).otherwise(F.lit("verified")).alias("comparability"),
        F.when(no_manifest, F.lit(1)).otherwise(n).cast("bigint").alias("n_reasons"),
        F.when(no_manifest, F.lit("no_sample_manifest"))
        .when(n > 0, F.col("said"))
        .otherwise(F.lit("content evidence complete"))
        .alias("comparability_reason"),
    )


def compose_reason(validity: Column, reason: Column, comparability: Column, comparability_reason: Column) -> Column:
    """A complete run that is not verified says why in its status reason."""
    said = F.coalesce(reason, F.lit(""))
    return F.when(
        (validity == "complete") & (comparability != "verified"),
        F.concat(said, F.when(said != "", F.lit("; ")).otherwise(F.lit("")), F.lit("comparability: "), comparability_reason),
    ).otherwise(said)


def batch_acceptance(groups: DataFrame, results: DataFrame, allow_partial: bool = False) -> DataFrame:
    """A batch is accepted when it has results and every one is stored, completed and valid."""
    accepted = ["complete", "partial"] if allow_partial else ["complete"]
    clean = F.coalesce(
        F.col("persisted") & (F.col("execution_status") == "completed") & F.col("validity_status").isin(accepted),
        F.lit(False),
    )
    verdicts = results.groupBy("run_group").agg(F.bool_and(clean).alias("__clean"), F.count(F.lit(1)).alias("__n"))
    return groups.select("run_group").join(verdicts, "run_group", "left").select(
        "run_group", F.coalesce("__n", F.lit(0)).alias("results"), F.coalesce("__clean", F.lit(False)).alias("accepted")
    )
