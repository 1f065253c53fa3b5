"""Evidence, coverage and diagnostics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmill.operators import coverage, diagnostics, evidence
from proofmill.plans.verdicts import coverage_verdicts
from proofmill.session import work_path
from proofmill.sources import lines as line_source
from workload import bindings as b
from workload.registry import query

W = "WITH " + b.EVENTS_SQL
C = "WITH " + b.COVERAGE_SQL


def facts(spark, sf):
    return evidence.typed_evidence(b.event_lines(spark, sf))


@query(
    "scan_evidence_lines",
    W + """
SELECT 'w' || (CAST(substr(run_id, 2) AS BIGINT) % 4) AS run_id, kind, subset, count(*) AS lines, count(*) FILTER (WHERE problem IS NULL) AS usable,
       count(DISTINCT sample_id) AS samples
FROM facts GROUP BY ALL""",
)
def scan_evidence_lines(spark, sf):
    """Write the lines in the partitioned layout, scan them back and parse."""
    root = work_path(spark, "lines")
    worker = F.concat(F.lit("w"), (F.substring("run_id", 2, 20).cast("bigint") % 4).cast("string"))
    line_source.write_partitioned_lines(
        b.event_lines(spark, sf).withColumns({"run_id": worker, "report_id": F.lit("model-a")}), root
    )
    scanned = evidence.evidence_key(line_source.scan_partitioned_lines(spark, root))
    return scanned.groupBy("run_id", "kind", "subset").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("problem").isNull()).alias("usable"),
        F.countDistinct("sample_id").alias("samples"),
    )


@query(
    "evidence_key",
    W + "SELECT run_id, kind, subset, sample_id, repeat, problem, count(*) AS lines FROM facts GROUP BY ALL",
)
def evidence_key(spark, sf):
    keyed = evidence.evidence_key(b.event_lines(spark, sf))
    return keyed.groupBy("run_id", "kind", "subset", "sample_id", "repeat", "problem").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "generation_calls",
    W + """
SELECT run_id, subset, call, stop_reason, count(*) AS calls, CAST(sum(steps) AS BIGINT) AS steps FROM (
  SELECT run_id, subset, 0 AS call, r1 AS stop_reason, steps FROM predicted
  UNION ALL SELECT run_id, subset, 1, r2, steps FROM predicted WHERE r2 IS NOT NULL) GROUP BY ALL""",
)
def generation_calls(spark, sf):
    return evidence.generation_calls(facts(spark, sf)).groupBy("run_id", "subset", "call", "stop_reason").agg(
        F.count(F.lit(1)).alias("calls"), F.sum("steps").alias("steps")
    )


_TOKENS_SQL = ", ".join(f"CAST(sum({t}) AS BIGINT) AS {t}" for t in diagnostics.TOKEN_SUMS)


def _whole_tokens(df):
    return df.withColumns({t: F.col(t).cast("bigint") for t in diagnostics.TOKEN_SUMS})


@query(
    "usage_totals",
    W + f"""
SELECT run_id, subset, {_TOKENS_SQL}, count(*) FILTER (WHERE has_usage) AS usage_samples, count(*) FILTER (WHERE NOT has_usage) AS missing_usage
FROM predicted GROUP BY run_id, subset""",
)
def usage_totals(spark, sf):
    return _whole_tokens(diagnostics.usage_totals(facts(spark, sf)))


@query(
    "stop_reason_histogram",
    W + """
SELECT run_id, subset, stop_reason, count(*) AS calls FROM (
  SELECT run_id, subset, unnest(CASE WHEN r2 IS NULL THEN [r1] ELSE [r1, r2] END) AS stop_reason FROM predicted) GROUP BY ALL""",
)
def stop_reason_histogram(spark, sf):
    return diagnostics.stop_reason_histogram(facts(spark, sf))


def _reason_count(names: str) -> str:
    return f"CAST(sum(CAST(r1 IN ({names}) AS INTEGER) + CAST(coalesce(r2 IN ({names}), false) AS INTEGER)) FILTER (WHERE ok) AS BIGINT)"


_SUBSET_SQL = b.EVENTS_SQL + f""",
marked AS (SELECT *, kind = 'predicted' AND problem IS NULL AS ok FROM facts),
per_subset AS (
  SELECT run_id, subset,
    count(DISTINCT source) FILTER (WHERE kind = 'predicted') AS predicted_sources,
    count(DISTINCT source) FILTER (WHERE kind = 'reviewed') AS reviewed_sources,
    count(*) FILTER (WHERE ok) AS predicted_lines,
    count(*) FILTER (WHERE kind = 'reviewed' AND problem IS NULL) AS reviewed_lines,
    count(r1) FILTER (WHERE ok) + count(r2) FILTER (WHERE ok) AS generation_calls,
    coalesce({_reason_count("'max_tokens', 'model_length'")}, 0) AS truncated_calls,
    coalesce({_reason_count("'content_filter'")}, 0) AS content_filter_calls,
    coalesce({_reason_count("'unknown'")}, 0) AS unknown_stop_reason_calls,
    count(*) FILTER (WHERE ok AND r1 = 'unknown' AND coalesce(r2, 'unknown') = 'unknown') AS missing_stop_reason,
    count(*) FILTER (WHERE ok AND has_usage) AS usage_samples, count(*) FILTER (WHERE ok AND NOT has_usage) AS missing_usage,
    count(*) FILTER (WHERE problem IS NOT NULL) AS malformed_lines,
    count(*) FILTER (WHERE ok AND steps > 0) AS agent_samples,
    CAST(coalesce(sum(steps) FILTER (WHERE ok), 0) AS BIGINT) AS agent_steps,
    CAST(max(steps) FILTER (WHERE ok) AS BIGINT) AS agent_steps_max,
    CAST(coalesce(sum(input_tokens) FILTER (WHERE ok), 0) AS BIGINT) AS input_tokens,
    CAST(coalesce(sum(output_tokens) FILTER (WHERE ok), 0) AS BIGINT) AS output_tokens,
    CAST(coalesce(sum(total_tokens) FILTER (WHERE ok), 0) AS BIGINT) AS total_tokens
  FROM marked GROUP BY run_id, subset)
"""


@query("subset_evidence", "WITH " + _SUBSET_SQL + "SELECT * FROM per_subset")
def subset_evidence(spark, sf):
    return _whole_tokens(diagnostics.subset_evidence(facts(spark, sf)))


@query(
    "run_diagnostics",
    "WITH " + _SUBSET_SQL + """
SELECT run_id, CAST(sum(generation_calls) AS BIGINT) AS generation_calls, CAST(sum(truncated_calls) AS BIGINT) AS truncated_calls,
  CAST(sum(content_filter_calls) AS BIGINT) AS content_filter_calls, CAST(sum(unknown_stop_reason_calls) AS BIGINT) AS unknown_stop_reason_calls,
  CAST(sum(missing_stop_reason) AS BIGINT) AS samples_without_stop_reason, CAST(sum(missing_usage) AS BIGINT) AS samples_without_usage,
  CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens, CAST(sum(malformed_lines) AS BIGINT) AS malformed_lines,
  CAST(sum(agent_samples) AS BIGINT) AS agent_samples, CAST(sum(agent_steps) AS BIGINT) AS agent_steps,
  CASE WHEN sum(agent_samples) > 0 THEN max(agent_steps_max) END AS agent_steps_max,
  CASE WHEN sum(agent_samples) > 0 THEN floor((sum(agent_steps) * 200 + sum(agent_samples)) / (sum(agent_samples) * 2)) / 100.0 END AS agent_steps_mean
FROM per_subset GROUP BY run_id""",
)
def run_diagnostics(spark, sf):
    return _whole_tokens(diagnostics.run_diagnostics(diagnostics.subset_evidence(facts(spark, sf))))


@query(
    "agent_step_stats",
    W + """
SELECT run_id, count(*) AS samples, CAST(sum(steps) AS BIGINT) AS total_steps, CAST(max(steps) AS BIGINT) AS max_steps,
       floor((sum(steps) * 200 + count(*)) / (count(*) * 2)) / 100.0 AS mean_steps
FROM predicted WHERE steps > 0 GROUP BY run_id""",
)
def agent_step_stats(spark, sf):
    return diagnostics.agent_step_stats(facts(spark, sf))


@query(
    "stop_reason_counts",
    W + """
SELECT run_id, '{' || string_agg('"' || reason || '":' || n, ',' ORDER BY reason) || '}' AS stop_reason_counts
FROM (
  SELECT run_id, reason, count(*) AS n FROM (SELECT run_id, unnest(CASE WHEN r2 IS NULL THEN [r1] ELSE [r1, r2] END) AS reason FROM predicted) GROUP BY ALL)
GROUP BY run_id""",
)
def stop_reason_counts(spark, sf):
    return diagnostics.stop_reason_counts(facts(spark, sf))


@query(
    "malformed_summary",
    W + """
SELECT run_id, count(*) AS malformed_lines, count(*) FILTER (WHERE problem = 'no sample id') AS without_sample_id,
       count(*) FILTER (WHERE problem <> 'no sample id') AS unparsable
FROM facts WHERE problem IS NOT NULL GROUP BY run_id""",
)
def malformed_summary(spark, sf):
    return evidence.malformed_summary(facts(spark, sf))


_PREDICTED = """
pred AS (
  SELECT coalesce(s.run_id, p.run_id) AS run_id, coalesce(s.subset, p.subset) AS subset,
         count(s.sample_id) AS expected, count(p.sample_id) AS n_bases,
         count(*) FILTER (WHERE s.sample_id IS NOT NULL AND p.sample_id IS NOT NULL) AS covered,
         count(*) FILTER (WHERE p.sample_id IS NULL) AS predicted_missing,
         count(*) FILTER (WHERE s.sample_id IS NULL) AS predicted_extra
  FROM cov_samples s FULL OUTER JOIN bases p ON s.run_id = p.run_id AND s.subset = p.subset AND s.sample_id = p.sample_id
  GROUP BY 1, 2),
lines AS (
  SELECT run_id, subset, count(*) FILTER (WHERE kind = 'predicted') AS predicted_total, count(*) FILTER (WHERE kind = 'reviewed') AS reviewed_total
  FROM usable GROUP BY ALL),
rev AS (
  SELECT run_id, subset, count(*) FILTER (WHERE np > 0 AND nr > 0) AS reviewed, count(*) FILTER (WHERE np > 0 AND nr = 0) AS reviewed_missing,
         count(*) FILTER (WHERE np = 0) AS reviewed_extra, CAST(sum(greatest(np - 1, 0)) AS BIGINT) AS predicted_duplicates,
         CAST(sum(greatest(nr - 1, 0)) AS BIGINT) AS reviewed_duplicates
  FROM keys GROUP BY ALL)
"""


@query(
    "coverage_predicted",
    C + "," + _PREDICTED + """
SELECT pred.run_id, pred.subset, CASE WHEN expected = 0 THEN n_bases ELSE covered END AS predicted,
       coalesce(predicted_total, 0) AS predicted_total, predicted_missing, predicted_extra
FROM pred LEFT JOIN lines USING (run_id, subset)""",
)
def coverage_predicted(spark, sf):
    return coverage.coverage_predicted(b.coverage_samples(spark, sf), b.coverage_evidence(spark, sf))


@query(
    "coverage_reviewed",
    C + "," + _PREDICTED + "SELECT run_id, subset, reviewed, reviewed_total, reviewed_missing, reviewed_extra FROM rev JOIN lines USING (run_id, subset)",
)
def coverage_reviewed(spark, sf):
    return coverage.coverage_reviewed(b.coverage_evidence(spark, sf))


@query("duplicate_evidence", C + "," + _PREDICTED + "SELECT run_id, subset, predicted_duplicates, reviewed_duplicates FROM rev")
def duplicate_evidence(spark, sf):
    return coverage.duplicate_evidence(b.coverage_evidence(spark, sf))


_GAPS = """
gaps AS (
  SELECT run_id, subset, 'predicted' AS kind, 'missing' AS gap, sample_id AS key FROM cov_samples s
  WHERE NOT EXISTS (SELECT 1 FROM bases p WHERE p.run_id = s.run_id AND p.subset = s.subset AND p.sample_id = s.sample_id)
  UNION ALL
  SELECT run_id, subset, 'predicted', 'extra', sample_id FROM bases p
  WHERE NOT EXISTS (SELECT 1 FROM cov_samples s WHERE p.run_id = s.run_id AND p.subset = s.subset AND p.sample_id = s.sample_id)
  UNION ALL SELECT run_id, subset, 'reviewed', 'missing', sample_id || '#r' || repeat FROM keys WHERE np > 0 AND nr = 0
  UNION ALL SELECT run_id, subset, 'reviewed', 'extra', sample_id || '#r' || repeat FROM keys WHERE np = 0)
"""


@query("coverage_gaps", C + "," + _GAPS + "SELECT * FROM gaps")
def coverage_gaps(spark, sf):
    counts = coverage.key_counts(b.coverage_evidence(spark, sf))
    return coverage.coverage_gaps(coverage.sample_counts(b.coverage_samples(spark, sf), counts), counts)


_MERGED = _PREDICTED + """,
merged AS (
  SELECT m.*, coalesce(CASE WHEN pred.expected = 0 THEN n_bases ELSE covered END, 0) AS predicted, coalesce(predicted_total, 0) AS predicted_total,
         coalesce(pred.predicted_missing, 0) AS predicted_missing, coalesce(pred.predicted_extra, 0) AS predicted_extra,
         coalesce(predicted_duplicates, 0) AS predicted_duplicates, coalesce(reviewed, 0) AS reviewed,
         coalesce(reviewed_total, 0) AS reviewed_total, coalesce(reviewed_missing, 0) AS reviewed_missing,
         coalesce(reviewed_extra, 0) AS reviewed_extra, coalesce(reviewed_duplicates, 0) AS reviewed_duplicates
  FROM cov_manifest m LEFT JOIN pred USING (run_id, subset) LEFT JOIN lines USING (run_id, subset) LEFT JOIN rev USING (run_id, subset))
"""


@query("coverage_merge", C + "," + _MERGED + "SELECT * FROM merged")
def coverage_merge(spark, sf):
    counts = coverage.key_counts(b.coverage_evidence(spark, sf))
    per_sample = coverage.sample_counts(b.coverage_samples(spark, sf), counts)
    return coverage.coverage_merge(b.coverage_manifest(spark, sf), coverage.subset_coverage(per_sample))


@query(
    "unexpected_subsets",
    C + "SELECT DISTINCT run_id, subset FROM cov_ev e WHERE NOT EXISTS (SELECT 1 FROM cov_manifest m WHERE m.run_id = e.run_id AND m.subset = e.subset)",
)
def unexpected_subsets(spark, sf):
    return coverage.unexpected_subsets(b.coverage_manifest(spark, sf), b.coverage_evidence(spark, sf))


def _head(kind: str, gap: str) -> str:
    return f"max(keys) FILTER (WHERE kind = '{kind}' AND gap = '{gap}') AS {kind[0]}_{gap}"


def _kind_reasons(kind: str, start: int) -> str:
    head = kind[0]
    return f"""
  UNION ALL SELECT run_id, subset_pos + 2, {start}, subset || ': {kind} missing evidence keys ' || {head}_missing FROM wide WHERE {kind}_missing > 0
  UNION ALL SELECT run_id, subset_pos + 2, {start + 1}, subset || ': {kind} unexpected evidence keys ' || {head}_extra FROM wide WHERE {kind}_extra > 0
  UNION ALL SELECT run_id, subset_pos + 2, {start + 2}, subset || ': {kind} duplicate evidence keys x' || {kind}_duplicates FROM wide WHERE {kind}_duplicates > 0"""


@query(
    "assess_comparability",
    C + "," + _MERGED + "," + _GAPS + f""",
ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id, subset, kind, gap ORDER BY key) AS rn FROM gaps),
heads AS (
  SELECT run_id, subset, kind, gap, '[''' || string_agg(key, ''', ''' ORDER BY rn) || ''']' AS keys FROM ranked WHERE rn <= 5 GROUP BY ALL),
wide AS (
  SELECT m.*, p_missing, p_extra, r_missing, r_extra FROM merged m LEFT JOIN (
    SELECT run_id, subset, {_head('predicted', 'missing')}, {_head('predicted', 'extra')}, {_head('reviewed', 'missing')}, {_head('reviewed', 'extra')}
    FROM heads GROUP BY run_id, subset) USING (run_id, subset)),
odd AS (
  SELECT run_id, subset, row_number() OVER (PARTITION BY run_id ORDER BY subset) AS rn FROM (
    SELECT DISTINCT run_id, subset FROM cov_ev e
    WHERE NOT EXISTS (SELECT 1 FROM cov_manifest m WHERE m.run_id = e.run_id AND m.subset = e.subset))),
reasons AS (
  SELECT run_id, 0 AS ord, 0 AS item, 'unexpected evidence subsets: [''' || string_agg(subset, ''', ''' ORDER BY rn) || ''']' AS reason
  FROM odd WHERE rn <= 5 GROUP BY run_id
  UNION ALL SELECT run_id, 1, 0, count(*) || ' malformed evidence line(s)' FROM cov_ev WHERE problem IS NOT NULL GROUP BY run_id
  UNION ALL SELECT run_id, subset_pos + 2, 0, subset || ': missing content digest' FROM wide WHERE question_digest IS NULL
  UNION ALL SELECT run_id, subset_pos + 2, 1, subset || ': media content not verifiable' FROM wide WHERE NOT media_evidence
  {_kind_reasons('predicted', 4)}
  {_kind_reasons('reviewed', 7)}),
verdicts AS (SELECT run_id, count(*) AS n_reasons, string_agg(reason, '; ' ORDER BY ord, item) AS reason FROM reasons GROUP BY run_id)
SELECT r.run_id, CASE WHEN v.run_id IS NULL THEN 'verified' ELSE 'unknown' END AS comparability, coalesce(n_reasons, 0) AS n_reasons,
       coalesce(reason, 'content evidence complete') AS comparability_reason
FROM (SELECT DISTINCT run_id FROM cov_manifest) r LEFT JOIN verdicts v USING (run_id)""",
)
def assess_comparability(spark, sf):
    manifest = b.coverage_manifest(spark, sf)
    return coverage_verdicts(
        manifest.select("run_id").distinct(), b.coverage_samples(spark, sf), manifest, b.coverage_evidence(spark, sf)
    )
