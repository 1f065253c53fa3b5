"""Report documents, metric rows, verdicts and the report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmill.functions.canonical import digest
from proofmill.functions.identity import metric_key as metric_key_column
from proofmill.operators import metrics, validity
from proofmill.plans import report as plans
from proofmill.session import work_path
from proofmill.sources import reports as report_source
from workload import bindings as b
from workload.registry import dealt, query, spread, table

# --- reports: one nested document per lineitem row -------------------------------

# Two metrics per document: the first has one category with one subset, the second none.
_FLAT_SQL = """
doc AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS run_id, l_linenumber AS n, *
  FROM lineitem),
named AS (
  SELECT *, '{"aggregation":"mean","dimensions":{"k":' || n || '},"name":"m' || n || '"}' AS id1,
         '{"aggregation":null,"dimensions":{},"name":null}' AS id2 FROM doc),
flat AS (
  SELECT run_id, sha256(id1) AS metric_key, 'm' || n AS metric_name, true AS identity_valid, n <> 3 AS is_primary,
         sha256('[]') AS category_key, '[]' AS category_json, '' AS subset, CAST(l_quantity AS BIGINT) AS num, l_discount AS score,
         '%' AS unit, 'quality' AS semantics_kind
  FROM named
  UNION ALL SELECT run_id, sha256(id1), 'm' || n, true, n <> 3, sha256('["' || l_returnflag || '","x"]'), '["' || l_returnflag || '","x"]', '',
         CAST(l_quantity AS BIGINT), l_tax, '%', 'quality' FROM named
  UNION ALL SELECT run_id, sha256(id1), 'm' || n, true, n <> 3, sha256('["' || l_returnflag || '","x"]'), '["' || l_returnflag || '","x"]', l_linestatus,
         1, CASE WHEN n <> 2 THEN l_tax END, '%', 'quality' FROM named
  UNION ALL SELECT run_id, sha256(id2), 'old' || n, false, false, sha256('[]'), '[]', '', 7, NULL, 'raw', NULL FROM named)
"""


def report_documents(spark, sf):
    """(run_id, document): the report of every lineitem row as JSON text."""
    n, q = F.col("l_linenumber"), F.col("l_quantity").cast("bigint")
    name = b.text_of("m", n)

    def member(key, value):
        return value.alias(key)

    none = F.lit(None).cast("string")
    subset = F.struct(
        member("name", F.col("l_linestatus")), member("score", F.when(n != 2, F.col("l_tax").cast("string"))),
        member("num", F.lit(1).cast("bigint")), member("is_aggregate", F.lit(False)),
    )
    category = F.struct(
        member("name", F.array(F.col("l_returnflag"), F.lit("x"))), member("num", q),
        member("score", F.col("l_tax").cast("string")), member("macro_score", none), member("subsets", F.array(subset)),
    )
    first = F.struct(
        member("identity", F.struct(member("name", name), member("aggregation", F.lit("mean")), member("dimensions", F.struct(n.alias("k"))))),
        member("legacy_name", none), member("num", q.cast("string")), member("score", F.col("l_discount").cast("string")),
        member("macro_score", F.col("l_discount").cast("string")), member("categories", F.array(category)),
        member("semantics", F.struct(member("kind", F.lit("quality")), member("display_unit", F.lit("%")), member("raw_unit", F.lit("raw")))),
    )
    second = F.struct(
        member("legacy_name", b.text_of("old", n)), member("num", F.lit(7.0)),
        member("semantics", F.struct(member("raw_unit", F.lit("raw")))),
    )
    primary = F.when(
        n != 3, F.struct(member("name", name), member("aggregation", F.lit("mean")), member("dimensions", F.struct(n.alias("k"))))
    )
    metrics_json = F.concat(F.lit('"metrics":['), F.to_json(first), F.lit(","), F.to_json(second), F.lit("]"))
    document = F.concat(
        F.lit('{"dataset_name":"set-'), F.col("l_returnflag"), F.lit('","model_name":"model-'), (F.col("l_suppkey") % 5).cast("string"),
        F.lit('",'), metrics_json,
        F.when(n != 3, F.concat(F.lit(',"primary_metric_identity":'), F.to_json(primary))).otherwise(F.lit("")),
        F.lit("}"),
    )
    run = b.text_of(F.col("l_orderkey"), "-", n, "-", F.col("l_partkey"), "-", F.col("l_suppkey"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = table(spark, sf, "lineitem").select(*keys, "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return spread(rows, *keys).select(
        run.alias("run_id"), document.alias("document"), "l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey"
    )


def flat_metrics(spark, sf):
    return metrics.metric_flatten(report_source.report_columns(report_documents(spark, sf).select("run_id", "document")))


_FLAT = ["run_id", "metric_key", "metric_name", "identity_valid", "is_primary", "category_key", "category_json", "subset", "num",
         "score", "unit", "semantics_kind"]


@query("metric_flatten", "WITH " + _FLAT_SQL + f"SELECT {', '.join(_FLAT)} FROM flat")
def metric_flatten(spark, sf):
    return flat_metrics(spark, sf).select(*_FLAT)


@query(
    "report_ownership",
    """
WITH docs AS (
  SELECT l_orderkey AS n, CASE WHEN l_linenumber = 6 THEN 'other' ELSE o_orderpriority END AS dataset_name,
         CASE WHEN l_linenumber % 2 = 1 THEN 'm' || (o_custkey % 20) ELSE 'm-foreign' END AS model_name,
         l_linenumber <> 7 AND l_linenumber <> 4 AS is_report, l_linenumber = 7 AS broken
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
counts AS (
  SELECT o_orderkey AS n,
         count(*) FILTER (WHERE is_report AND model_name = 'm' || (o_custkey % 20) AND dataset_name = o_orderpriority) AS matched,
         count(*) FILTER (WHERE is_report) AS reports, count(*) FILTER (WHERE broken) AS broken
  FROM orders LEFT JOIN docs ON n = o_orderkey GROUP BY o_orderkey)
SELECT CAST(n AS VARCHAR) AS run_id, matched, reports, broken,
  CASE WHEN matched = 1 THEN 'ok' WHEN matched > 1 THEN 'ambiguous' WHEN reports > 0 THEN 'mismatch' WHEN broken > 0 THEN 'parse_error' ELSE 'missing' END AS result
FROM counts""",
)
def report_ownership(spark, sf):
    runs = b.runs(spark, sf).select("run_id", "dataset", F.lit(None).cast("string").alias("pretty_name"), F.col("model_alias").alias("report_id"))
    line = F.col("l_linenumber")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("run_id"), "l_linenumber", "l_partkey")
    documents = dealt(lines, "run_id").join(
        runs.select("run_id", "dataset", "report_id"), "run_id"
    ).select(
        "run_id", b.text_of("/reports/", line, "-", F.col("l_partkey")).alias("path"),
        F.when(line == 6, F.lit("other")).otherwise(F.col("dataset")).alias("dataset_name"),
        F.when(line % 2 == 1, F.col("report_id")).otherwise(F.lit("m-foreign")).alias("model_name"),
        ((line != 7) & (line != 4)).alias("is_report"), (line == 7).alias("parse_error"),
    )
    return metrics.report_ownership(runs, documents).select("run_id", "matched", "reports", "broken", "result")


@query(
    "coerce_score",
    """
SELECT CAST(event_id AS VARCHAR) AS place,
  CASE event_id % 8 WHEN 0 THEN CAST(CAST(value AS VARCHAR) AS DOUBLE) WHEN 1 THEN NULL WHEN 6 THEN CAST(CAST(value AS VARCHAR) || 'E2' AS DOUBLE) WHEN 7 THEN -value END AS score,
  event_id || ': ' || CASE event_id % 8 WHEN 2 THEN 'boolean is not a score' WHEN 3 THEN 'non-finite score' WHEN 4 THEN 'non-numeric score'
    WHEN 5 THEN 'non-numeric score' END AS score_error
FROM events""",
)
def coerce_score(spark, sf):
    kind, value = F.col("event_id") % 8, F.col("value").cast("string")
    raw = (
        F.when(kind == 0, value).when(kind == 2, F.lit("true")).when(kind == 3, F.lit("NaN"))
        .when(kind == 4, F.lit("abc")).when(kind == 5, F.concat(value, F.lit("d"))).when(kind == 6, F.concat(F.lit(" "), value, F.lit("E2 ")))
        .when(kind == 7, F.concat(F.lit("-"), value))
    )
    scores = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("place"), raw.alias("score_text"))
    return metrics.coerce_score(scores).select("place", "score", "score_error")


@query(
    "metric_identity",
    """
SELECT CAST(event_id AS VARCHAR) AS place,
  sha256('{"aggregation":' || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE '"agg' || (event_id % 3) || '"' END || ',"dimensions":' ||
    CASE WHEN event_id % 4 = 0 THEN '{}' ELSE '{"k":' || json_extract_string(props, '$.k') || ',"z":"' || event_type || '"}' END || ',"name":' ||
    CASE event_id % 7 WHEN 0 THEN 'null' WHEN 1 THEN '"  "' ELSE '"' || event_type || '"' END || '}') AS metric_key,
  event_id % 7 > 1 AS identity_valid
FROM events""",
)
def metric_identity(spark, sf):
    i = F.col("event_id")
    name = F.when(i % 7 == 0, F.lit(None).cast("string")).when(i % 7 == 1, F.lit("  ")).otherwise(F.col("event_type"))
    aggregation = F.when(i % 5 != 0, b.text_of("agg", i % 3))
    dims = F.when(i % 4 != 0, b.text_of('{"z": "', F.col("event_type"), '", "k": ', F.get_json_object("props", "$.k"), "}"))
    return table(spark, sf, "events").select(
        i.cast("string").alias("place"),
        metric_key_column(name, aggregation, metrics.dimensions_json(dims)).alias("metric_key"),
        metrics.identity_is_valid(name).alias("identity_valid"),
    )


@query(
    "duplicate_metric_check",
    """
WITH copies AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1)
SELECT CAST(l_orderkey AS VARCHAR) AS run_id, count(*) AS repeated_identities, CAST(sum(n - 1) AS BIGINT) AS surplus_rows FROM copies GROUP BY l_orderkey
""",
)
def duplicate_metric_check(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("run_id"), digest(F.col("l_linenumber").cast("string")).alias("metric_key"),
        F.lit("c").alias("category_key"), F.lit("").alias("subset"),
    )
    return metrics.duplicate_metric_check(rows)


# --- verdicts -------------------------------------------------------------------

_ASSESS_SQL = """
WITH m AS (
  SELECT l_orderkey AS n, l_linenumber AS line, CAST(min(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL),
facts AS (
  SELECT n, count(*) AS metric_rows,
    count(*) FILTER (WHERE n % 17 <> 0 AND n % 19 <> 0 AND line % 4 <> 0) AS quality,
    count(*) FILTER (WHERE n % 17 <> 0) AS semantic,
    min(line) FILTER (WHERE line = 1 OR (line = 4 AND n % 5 = 0)) AS p,
    min(q) FILTER (WHERE line = 1) AS q1, min(q) FILTER (WHERE line = 4) AS q4
  FROM m GROUP BY n),
x AS (
  SELECT o_orderkey AS n, coalesce(metric_rows, 0) AS metric_rows, quality, semantic, p,
    CASE WHEN o_orderkey % 37 = 0 THEN 0 WHEN p = 1 THEN q1 ELSE q4 END AS num, o_orderkey % 50 + 10 AS q, o_orderkey % 26 AS f
  FROM orders LEFT JOIN facts ON n = o_orderkey),
y AS (
  SELECT *, CASE WHEN n % 3 <> 0 THEN n % 50 + 8 + n % 4 END AS selected,
    CASE f WHEN 8 THEN 0 ELSE q END AS req,
    CASE f WHEN 5 THEN q + 1 WHEN 7 THEN q WHEN 9 THEN NULL WHEN 10 THEN 0 WHEN 11 THEN q - 2 WHEN 8 THEN 0 WHEN 6 THEN 0 WHEN 4 THEN q ELSE q END AS suc,
    CASE f WHEN 4 THEN -1 WHEN 6 THEN q + 3 WHEN 7 THEN 1 WHEN 10 THEN q WHEN 11 THEN 1 ELSE 0 END AS err
  FROM x)
SELECT CAST(n AS VARCHAR) AS run_id, v[1] AS execution_status, v[2] AS validity_status, v[3] AS status_reason FROM (
SELECT n, CASE
  WHEN n % 101 = 0 THEN ['interrupted', 'invalid', 'interrupted by user']
  WHEN n % 97 = 0 THEN ['failed', 'invalid', 'task_error: boom ' || n]
  WHEN n % 89 = 0 THEN ['completed', 'invalid', 'report_mismatch: no report']
  WHEN n % 83 = 0 THEN ['completed', 'invalid', 'report_missing: no report']
  WHEN metric_rows = 0 THEN ['completed', 'invalid', 'no_metrics']
  WHEN quality = 0 AND semantic > 0 THEN ['completed', 'invalid', 'no_quality_metric: only diagnostic metrics were reported']
  WHEN quality = 0 THEN ['completed', 'invalid', 'metric_semantics_missing']
  WHEN p IS NULL THEN ['completed', 'unverified', 'missing_primary_metric: no primary metric identity in the report']
  WHEN p = 4 THEN ['completed', 'invalid', 'primary_metric_not_quality: m4']
  WHEN n % 29 = 0 THEN ['completed', 'invalid', 'primary_metric_invalid_identity']
  WHEN n % 23 = 0 THEN ['completed', 'invalid', 'primary_metric_invalid_identity: report identity has no name']
  WHEN n % 31 = 0 THEN ['completed', 'unverified', 'primary_metric_missing_score: m1']
  WHEN num <= 0 THEN ['completed', 'unverified', 'primary_metric_no_samples: ' || num]
  WHEN f = 0 THEN ['completed', 'unverified', 'missing_execution_summary']
  WHEN f = 1 THEN ['completed', 'unverified', 'invalid_execution_summary: list']
  WHEN f = 2 THEN ['completed', 'unverified', 'invalid_execution_summary: counts must be integers']
  WHEN f = 3 THEN ['completed', 'unverified', 'invalid_execution_summary: incomplete must be a boolean']
  WHEN f = 4 THEN ['completed', 'unverified', 'inconsistent_execution_summary: negative counts']
  WHEN f = 5 THEN ['completed', 'unverified', 'inconsistent_execution_summary: succeeded=' || suc || ' > requested=' || req]
  WHEN f = 6 THEN ['completed', 'unverified', 'inconsistent_execution_summary: errored=' || err || ' > requested=' || req]
  WHEN f = 7 THEN ['completed', 'unverified', 'inconsistent_execution_summary: succeeded+errored=' || (suc + err) || ' > requested=' || req]
  WHEN f = 8 THEN ['completed', 'unverified', 'no_requested_samples']
  WHEN selected IS NOT NULL AND req > selected THEN ['completed', 'unverified', 'requested_exceeds_manifest: requested=' || req || ' selected=' || selected]
  WHEN f = 9 THEN ['completed', 'unverified', 'missing_succeeded_count']
  WHEN f = 10 THEN ['completed', 'invalid', 'all_samples_failed: requested=' || req || ' errored=' || err]
  WHEN f = 11 THEN ['completed', 'partial', 'partial_completion: succeeded=' || suc || '/' || req || ' errored=' || err]
  WHEN f = 12 THEN ['completed', 'partial', 'upstream_marked_incomplete']
  WHEN num > suc THEN ['completed', 'unverified', 'primary_metric_count_exceeds_succeeded: metric_num=' || num || ' succeeded=' || suc]
  ELSE ['completed', 'complete', 'complete: succeeded=' || suc || '/' || req] END AS v
FROM y)
"""


@query("assess_run", _ASSESS_SQL)
def assess_run(spark, sf):
    n = F.col("o_orderkey")
    f, q = n % 26, n % 50 + 10

    def summary(requested, succeeded, errored, extra=""):
        parts = ['{"requested":', requested, ',"succeeded":', succeeded, ',"errored":', errored, extra + "}"]
        return b.text_of(*parts)

    zero = F.lit(0)
    execution = (
        F.when(f == 0, F.lit(None).cast("string")).when(f == 1, F.lit("[1, 2]"))
        .when(f == 2, F.lit('{"requested":"5","succeeded":5}'))
        .when(f == 3, summary(q, q, zero, ',"incomplete":"yes"')).when(f == 4, summary(q, q, F.lit(-1)))
        .when(f == 5, summary(q, q + 1, zero)).when(f == 6, summary(q, zero, q + 3)).when(f == 7, summary(q, q, F.lit(1)))
        .when(f == 8, summary(zero, zero, zero)).when(f == 9, b.text_of('{"requested":', q, ',"succeeded":null}'))
        .when(f == 10, summary(q, zero, q)).when(f == 11, summary(q, q - 2, F.lit(1)))
        .when(f == 12, summary(q, q, zero, ',"incomplete":true'))
        .otherwise(b.text_of('{"requested":', q, '.0,"succeeded":', q, ',"incomplete":0}'))
    )
    kind = F.when(n % 89 == 0, F.lit("mismatch")).when(n % 83 == 0, F.lit("missing"))
    runs = table(spark, sf, "orders").select(
        n.cast("string").alias("run_id"), (n % 101 == 0).alias("interrupted"),
        F.when(n % 97 == 0, b.text_of("boom ", n)).alias("task_error"), kind.alias("report_error_kind"),
        F.when(kind.isNotNull(), F.lit("no report")).alias("report_error"), execution.alias("execution_summary"),
    )
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").cast("bigint").alias("q")).select(
        key.cast("string").alias("run_id"), line.cast("bigint").alias("pos"), b.text_of("m", line).alias("metric_name"),
        F.when(key % 29 == 0, F.lit("")).otherwise(b.text_of("key", line)).alias("metric_key"),
        (key % 23 != 0).alias("identity_valid"),
        F.when(key % 17 == 0, F.lit(None)).when((key % 19 == 0) | (line % 4 == 0), F.lit("diagnostic")).otherwise(F.lit("quality")).alias("semantics_kind"),
        F.when(key % 31 != 0, F.lit(0.0)).alias("score"), F.when(key % 37 == 0, F.lit(0)).otherwise(F.col("q")).alias("num"),
        ((line == 1) | ((line == 4) & (key % 5 == 0))).alias("is_primary"),
    )
    manifest = table(spark, sf, "orders").filter(n % 3 != 0).select(
        n.cast("string").alias("run_id"), F.explode(F.array(n % 50, n % 4 + 8)).alias("selected")
    )
    verdicts = validity.assess_run(runs, rows, manifest)
    return verdicts.select("run_id", "execution_status", "validity_status", "status_reason")


@query(
    "compose_reason",
    "WITH " + b.RUNS_SQL + """
SELECT run_id, CASE WHEN validity_status = 'complete' AND comparability <> 'verified'
  THEN coalesce(status_reason, '') || CASE WHEN coalesce(status_reason, '') <> '' THEN '; ' ELSE '' END || 'comparability: ' || profile
  ELSE coalesce(status_reason, '') END AS told FROM runs""",
)
def compose_reason(spark, sf):
    told = validity.compose_reason(F.col("validity_status"), F.col("status_reason"), F.col("comparability"), F.col("profile"))
    return b.runs(spark, sf).select("run_id", told.alias("told"))


@query(
    "batch_acceptance",
    "WITH " + b.RUNS_SQL + """,
all_groups AS (SELECT DISTINCT run_group FROM runs UNION ALL SELECT DISTINCT 'empty-' || model_alias FROM runs)
SELECT g.run_group, count(r.run_id) AS results,
       count(r.run_id) > 0 AND coalesce(bool_and(n % 10 <> 9 AND coalesce(validity_status IN ('complete', 'partial'), false)), false) AS accepted
FROM all_groups g LEFT JOIN runs r USING (run_group) GROUP BY g.run_group""",
)
def batch_acceptance(spark, sf):
    runs = b.runs(spark, sf)
    number = F.col("run_id").cast("bigint")
    results = runs.withColumn("persisted", number % 10 != 9)
    groups = runs.select("run_group").distinct().unionByName(
        runs.select(F.concat(F.lit("empty-"), "model_alias").alias("run_group")).distinct()
    )
    return validity.batch_acceptance(groups, results, allow_partial=True)


# --- the report -----------------------------------------------------------------

_FORMAL = """
formal AS (
  SELECT r.*, m.metric_name, m.score, m.num AS metric_num, m.display_kind, m.unit FROM runs r JOIN metrics m ON m.run_id = r.run_id AND line = 1
  WHERE validity_status IN ('complete', 'partial') AND comparability = 'verified' AND profile <> 'smoke')
"""
_LATEST = _FORMAL + """,
latest AS (
  SELECT *, coalesce(protocol_identity, 'unknown') AS protocol, coalesce(sample_manifest_identity, 'unknown') AS samples,
         row_number() OVER (PARTITION BY coalesce(protocol_identity, 'unknown'), sample_manifest_identity,
                            coalesce(model_config_identity, model_alias), dataset, metric_name ORDER BY finished_at DESC, run_id DESC) AS rn
  FROM formal QUALIFY rn = 1)
"""
_R = "WITH " + b.RUNS_SQL + ","


def _score_sql(prefix: str = "") -> str:
    return f"""CASE WHEN {prefix}score IS NULL THEN 'N/A' WHEN {prefix}display_kind = 'percent' THEN printf('%.1f', {prefix}score * 100) || '%'
      WHEN {prefix}unit IS NOT NULL THEN printf('%.4f', {prefix}score) || ' ' || {prefix}unit ELSE printf('%.4f', {prefix}score) END"""


def formal(spark, sf):
    return plans.formal_rows(b.runs(spark, sf), b.metric_rows(spark, sf), include_partial=True)


@query(
    "formal_rows",
    _R + _FORMAL + """SELECT run_id, model_alias, dataset, profile, validity_status, strftime(finished_at, '%Y-%m-%d') AS finished_at, metric_name, score, metric_num FROM formal""",
)
def formal_rows(spark, sf):
    return formal(spark, sf).select(
        "run_id", "model_alias", "dataset", "profile", "validity_status", b.day("finished_at"), "metric_name", "score", "metric_num"
    )


@query(
    "latest_per_key",
    _R + _LATEST + "SELECT protocol, samples, model_alias, model_config_identity, dataset, metric_name, run_id, strftime(finished_at, '%Y-%m-%d') AS finished_at, score FROM latest",
)
def latest_per_key(spark, sf):
    return plans.latest_per_key(formal(spark, sf)).select(
        "protocol", "samples", "model_alias", "model_config_identity", "dataset", "metric_name", "run_id", b.day("finished_at"), "score"
    )


@query(
    "comparable_members",
    _R + _LATEST + f"""SELECT protocol, samples, substr(protocol, 1, 10) AS protocol_short, dataset, model_alias, coalesce(substr(model_config_identity, 1, 10), '') AS config_short,
       metric_name, {_score_sql()} AS score_text, metric_num, run_id FROM latest""",
)
def comparable_members(spark, sf):
    return plans.comparable_members(plans.latest_per_key(formal(spark, sf))).select(
        "protocol", "samples", "protocol_short", "dataset", "model_alias", "config_short", "metric_name", "score_text", "metric_num", "run_id"
    )


@query(
    "comparable_groups",
    _R + _LATEST + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY protocol, samples ORDER BY dataset, model_alias, run_id) AS place FROM latest)
SELECT protocol, samples, substr(protocol, 1, 10) AS protocol_short, substr(samples, 1, 10) AS samples_short, count(*) AS members,
  string_agg(dataset || '=' || metric_num, ', ' ORDER BY place) AS sample_sizes,
  strftime(max(finished_at), '%Y-%m-%d') AS newest
FROM placed GROUP BY protocol, samples""",
)
def comparable_groups(spark, sf):
    return plans.comparable_groups(plans.latest_per_key(formal(spark, sf))).withColumn("newest", b.day("newest"))


@query(
    "diagnostic_rows",
    _R + f"""
joined AS (
  SELECT r.*, m.metric_name, m.score, m.display_kind, m.unit FROM runs r LEFT JOIN metrics m ON m.run_id = r.run_id AND line = 1)
SELECT run_id, dataset, CASE WHEN profile = 'smoke' THEN 'diagnostic' ELSE profile END AS label, validity_status, comparability,
  coalesce(status_reason, '') AS reason,
  CASE WHEN metric_name IS NULL THEN 'N/A' ELSE {_score_sql()} END AS score_text, strftime(started_at, '%Y-%m-%d') AS started_at
FROM joined
WHERE validity_status IS DISTINCT FROM 'complete' OR comparability IS DISTINCT FROM 'verified' OR profile IS NULL OR profile = 'smoke' OR metric_name IS NULL""",
)
def diagnostic_rows(spark, sf):
    return plans.diagnostic_rows(b.runs(spark, sf), b.metric_rows(spark, sf)).select(
        "run_id", "dataset", "label", "validity_status", "comparability", "reason", "score_text", b.day("started_at")
    )


@query(
    "generation_table",
    _R + """
told AS (SELECT *, n % 11 AS calls FROM runs WHERE n % 7 <> 0)
SELECT run_id, dataset, calls AS generation_calls, calls // 2 AS truncated_calls, CASE WHEN n % 2 = 0 THEN CAST(n % 5 AS VARCHAR) ELSE 'unknown' END AS agent_steps_max,
       (n * 3) || '/' || (n * 2) AS tokens
FROM told WHERE n % 13 <> 0 AND calls > 0""",
)
def generation_table(spark, sf):
    return plans.generation_table(runs_with_diagnostics(spark, sf)).select(
        "run_id", "dataset", "generation_calls", "truncated_calls", "agent_steps_max", "tokens"
    )


def runs_with_diagnostics(spark, sf):
    n = F.col("run_id").cast("bigint")
    calls = n % 11
    steps = F.when(n % 2 == 0, b.text_of(',"agent_steps":{"max":', n % 5, "}")).otherwise(F.lit(""))
    told = b.text_of(
        '{"generation_calls":', calls, ',"truncated_calls":', F.floor(calls / 2), ',"usage_totals":{"input_tokens":', n * 3, '.0,"output_tokens":',
        n * 2, "}", steps, "}",
    )
    return b.runs(spark, sf).withColumn(
        "diagnostics_json", F.when(n % 7 == 0, F.lit(None)).when(n % 13 == 0, F.lit("{cut")).otherwise(told)
    )


@query(
    "summary_sink",
    _R + _LATEST + """
SELECT line FROM (SELECT '| ' || model_alias || ' | ' || coalesce(substr(model_config_identity, 1, 10), '') || ' | ' || dataset || ' | ' || metric_name || ' | ' ||
  """ + _score_sql() + """ || ' | ' || metric_num || ' | ' || profile || ' | ' || validity_status || ' | ' || strftime(finished_at, '%Y-%m-%d %H:%M:%S') || ' | ' || run_id || ' |' AS line FROM latest)""",
)
def summary_sink(spark, sf):
    """Write the report and read the member lines of its text back."""
    root = work_path(spark, "summary")
    plans.summary_sink(runs_with_diagnostics(spark, sf), b.metric_rows(spark, sf), root, include_partial=True)
    lines = spark.read.text(f"{root}/summary_md").select(F.col("value").alias("line"))
    return lines.filter(F.col("line").rlike(r"^\| m\d+ \| "))
