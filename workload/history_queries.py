"""Run history, imports, published tables and old formats."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from proofmill.operators import history, imports
from proofmill.schemas import RUNS
from proofmill.session import work_path
from proofmill.sources import outcomes as outcome_sink
from proofmill.sources import tables as store
from workload import bindings as b
from workload.registry import query, table

# Orders are in the history, in the batch to import, or in both: each in at least one, and every remainder of six in both.
HISTORY, BATCH = "o_orderkey % 5 <> 0", "o_orderkey % 5 <> 1"

_HISTORY_SQL = """
o AS (SELECT o_orderkey AS n, o_custkey AS c, o_orderstatus AS s, o_orderdate AS d, o_orderpriority AS prio FROM orders),
every_run AS (
  SELECT n, CAST(n AS VARCHAR) AS run_id, 'g' || (c % 9) AS run_group, prio AS dataset, 'suite' || (c % 3) AS suite,
         CASE WHEN n % 11 = 0 THEN '  ' ELSE 'model-' || (c % 20) END AS model_id,
         CASE WHEN n % 13 <> 0 THEN 'cfg' || (c % 40) END AS model_config_identity, 'p' || (c % 3) AS protocol_identity,
         CASE WHEN n % 17 = 0 THEN '' ELSE 'q' || (n % 6) END AS sample_manifest_identity,
         CASE s WHEN 'F' THEN 'complete' WHEN 'O' THEN 'partial' ELSE 'unverified' END AS validity_status,
         CASE WHEN n % 4 = 0 THEN 'unknown' ELSE 'verified' END AS comparability, 'old' AS status_reason,
         CASE WHEN n % 7 <> 0 THEN d END AS finished_at, n % 50 AS num_requested
  FROM o),
history AS (SELECT * FROM every_run WHERE n % 5 <> 0),
artifacts AS (
  SELECT n, CAST(n AS VARCHAR) AS run_id, CASE WHEN n % 53 = 0 THEN 'other' ELSE prio END AS dataset, 'suite' || (c % 3) AS suite,
         CASE WHEN n % 19 <> 0 THEN 'model-' || (c % 20 + CAST(n % 29 = 0 AS INTEGER)) END AS model_id, 'model-' || (c % 20) AS report_id,
         CASE WHEN n % 59 = 0 THEN ' ' ELSE 'cfg' || (c % 40) END AS model_config_identity, 'p' || (c % 3) AS protocol_identity,
         CASE WHEN n % 23 <> 0 THEN 'q' || (n % 6) END AS declared_identity,
         CASE WHEN n % 31 = 0 THEN NULL WHEN n % 37 = 0 THEN 'zz' ELSE 'q' || (n % 6) END AS computed_identity,
         CASE WHEN n % 41 = 0 THEN 'ReportError: no report' END AS parse_failure,
         CASE n % 8 WHEN 0 THEN 'partial' WHEN 2 THEN 'unverified' ELSE 'complete' END AS raw_validity,
         'reason ' || n AS raw_reason, CASE WHEN n % 7 = 0 THEN 'unknown' ELSE 'verified' END AS comparability, d + INTERVAL 3 DAY AS created_at
  FROM o),
missing AS (
  SELECT *, concat_ws('; ', CASE WHEN model_id IS NULL THEN 'model_id: <missing>' END,
      CASE WHEN trim(model_config_identity) = '' THEN 'model_config_identity: <missing>' END,
      CASE WHEN declared_identity IS NULL AND computed_identity IS NULL THEN 'sample_manifest_identity: <missing>'
           WHEN declared_identity IS NOT NULL AND computed_identity IS NULL THEN 'sample_manifest_identity: declared without manifest content' END) AS gone
  FROM artifacts),
checked AS (
  SELECT *, coalesce(declared_identity, computed_identity) AS sample_manifest_identity,
         coalesce(declared_identity <> computed_identity, false) AS identity_inconsistent,
         CASE WHEN gone <> '' THEN 'unverified' ELSE raw_validity END AS validity_status,
         CASE WHEN gone <> '' THEN raw_reason || '; import_identity_unverifiable: ' || gone ELSE raw_reason END AS status_reason
  FROM missing),
batch AS (SELECT * FROM checked WHERE n % 5 <> 1),
pairs AS (
  SELECT a.*, h.run_id IS NOT NULL AS stored, h.validity_status AS old_validity, h.comparability AS old_comparability, h.finished_at,
    concat_ws('; ',
      CASE WHEN h.dataset <> a.dataset THEN 'dataset: db=' || h.dataset || ' manifest=' || a.dataset END,
      CASE WHEN trim(h.model_id) <> '' AND h.model_id <> coalesce(a.model_id, a.report_id) THEN 'model_id: db=' || h.model_id || ' manifest=' || coalesce(a.model_id, a.report_id) END,
      CASE WHEN h.model_config_identity IS NOT NULL AND trim(a.model_config_identity) = '' THEN 'model_config_identity: db=' || h.model_config_identity || ' manifest=<missing>' END,
      CASE WHEN h.sample_manifest_identity <> '' AND a.sample_manifest_identity IS NULL THEN 'sample_manifest_identity: db=' || h.sample_manifest_identity || ' manifest=<missing>'
           WHEN h.sample_manifest_identity <> '' AND h.sample_manifest_identity <> a.sample_manifest_identity
           THEN 'sample_manifest_identity: db=' || h.sample_manifest_identity || ' manifest=' || a.sample_manifest_identity END) AS conflicts,
    h.run_id IS NOT NULL AND ((h.validity_status IN ('complete', 'partial') AND a.validity_status <> 'complete')
      OR (h.validity_status = 'complete' AND h.comparability = 'verified' AND NOT (a.validity_status = 'complete' AND a.comparability = 'verified'))) AS downgraded
  FROM batch a LEFT JOIN history h ON h.run_id = a.run_id)
"""
W = "WITH " + _HISTORY_SQL


def stored_runs(spark, sf, which=HISTORY):
    n, c, s = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    return table(spark, sf, "orders").filter(which).select(
        n.cast("string").alias("run_id"), b.text_of("g", c % 9).alias("run_group"), F.col("o_orderpriority").alias("dataset"),
        b.text_of("suite", c % 3).alias("suite"),
        F.when(n % 11 == 0, F.lit("  ")).otherwise(b.text_of("model-", c % 20)).alias("model_id"),
        F.when(n % 13 != 0, b.text_of("cfg", c % 40)).alias("model_config_identity"),
        b.text_of("p", c % 3).alias("protocol_identity"),
        F.when(n % 17 == 0, F.lit("")).otherwise(b.text_of("q", n % 6)).alias("sample_manifest_identity"),
        F.when(s == "F", F.lit("complete")).when(s == "O", F.lit("partial")).otherwise(F.lit("unverified")).alias("validity_status"),
        F.when(n % 4 == 0, F.lit("unknown")).otherwise(F.lit("verified")).alias("comparability"),
        F.lit("old").alias("status_reason"), F.when(n % 7 != 0, F.col("o_orderdate")).alias("finished_at"),
        (n % 50).alias("num_requested"),
    )


def artifacts(spark, sf, which=BATCH):
    n, c = F.col("o_orderkey"), F.col("o_custkey")
    return table(spark, sf, "orders").filter(which).select(
        n.cast("string").alias("run_id"),
        F.when(n % 53 == 0, F.lit("other")).otherwise(F.col("o_orderpriority")).alias("dataset"), b.text_of("suite", c % 3).alias("suite"),
        F.when(n % 19 != 0, b.text_of("model-", c % 20 + (n % 29 == 0).cast("int"))).alias("model_id"),
        b.text_of("model-", c % 20).alias("report_id"),
        F.when(n % 59 == 0, F.lit(" ")).otherwise(b.text_of("cfg", c % 40)).alias("model_config_identity"),
        b.text_of("p", c % 3).alias("protocol_identity"),
        F.when(n % 23 != 0, b.text_of("q", n % 6)).alias("declared_identity"),
        F.when(n % 31 == 0, F.lit(None)).when(n % 37 == 0, F.lit("zz")).otherwise(b.text_of("q", n % 6)).alias("computed_identity"),
        F.when(n % 41 == 0, F.lit("ReportError: no report")).alias("parse_failure"),
        F.when(n % 8 == 0, F.lit("partial")).when(n % 8 == 2, F.lit("unverified")).otherwise(F.lit("complete")).alias("validity_status"),
        b.text_of("reason ", n).alias("status_reason"),
        F.when(n % 7 == 0, F.lit("unknown")).otherwise(F.lit("verified")).alias("comparability"),
        (F.col("o_orderdate") + F.expr("INTERVAL 3 DAY")).alias("created_at"),
    )


@query(
    "artifact_selfcheck",
    W + "SELECT run_id, sample_manifest_identity, identity_inconsistent, validity_status, status_reason FROM checked",
    also="artifact_selfcheck_whole",
)
def artifact_selfcheck(spark, sf):
    return imports.artifact_selfcheck(artifacts(spark, sf, "true")).select(
        "run_id", "sample_manifest_identity", "identity_inconsistent", "validity_status", "status_reason"
    )


@query("identity_conflicts", W + "SELECT run_id, conflicts FROM pairs WHERE stored AND conflicts <> ''", also="identity_conflicts_whole")
def identity_conflicts(spark, sf):
    found = imports.identity_conflicts(imports.artifact_selfcheck(artifacts(spark, sf)), stored_runs(spark, sf))
    return found.withColumn("conflicts", F.array_join("conflicts", "; "))


@query(
    "downgrade_guard",
    W + """SELECT run_id, old_validity AS kept_validity, old_comparability AS kept_comparability, validity_status AS new_validity,
       comparability AS new_comparability FROM pairs WHERE downgraded""",
    also="downgrade_guard_whole",
)
def downgrade_guard(spark, sf):
    return imports.downgrade_guard(imports.artifact_selfcheck(artifacts(spark, sf)), stored_runs(spark, sf))


_DECIDED = """,
decided AS (
  SELECT *, CASE WHEN parse_failure IS NOT NULL THEN 'failed' WHEN identity_inconsistent THEN 'rejected_selfcheck'
      WHEN stored AND conflicts <> '' THEN 'rejected_conflict' WHEN downgraded THEN 'rejected_downgrade'
      WHEN stored THEN 'committed_update' ELSE 'committed_new' END AS decision FROM pairs),
kept AS (SELECT l_orderkey AS n, count(*) AS metric_rows FROM lineitem GROUP BY l_orderkey),
told AS (
SELECT run_id, decision,
  CASE decision WHEN 'failed' THEN parse_failure WHEN 'rejected_selfcheck' THEN 'identity_conflict: sample_manifest_identity: declared=' || declared_identity || ' computed=' || computed_identity
    WHEN 'rejected_conflict' THEN 'identity_conflict: ' || conflicts ELSE status_reason END AS reason,
  CASE WHEN decision = 'failed' THEN NULL WHEN decision LIKE 'committed%' THEN validity_status ELSE old_validity END AS validity_status,
  CASE WHEN decision = 'failed' THEN NULL WHEN decision LIKE 'committed%' THEN comparability ELSE old_comparability END AS comparability,
  CASE WHEN decision LIKE 'rejected%' AND stored THEN coalesce(metric_rows, 0) END AS metrics_kept,
  CASE WHEN decision LIKE 'committed%' THEN strftime(coalesce(finished_at, created_at), '%Y-%m-%d') END AS finished_at
FROM decided LEFT JOIN kept USING (n))
"""


@query("import_decision", W + _DECIDED + "SELECT * FROM told", also="import_decision_whole")
def import_decision(spark, sf):
    metrics = table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("run_id"))
    decided = imports.import_decision(artifacts(spark, sf), stored_runs(spark, sf), metrics)
    return decided.select("run_id", "decision", "reason", "validity_status", "comparability", "metrics_kept", b.day("finished_at"))


@query("import_audit", W + _DECIDED + "SELECT run_id, decision, reason FROM told WHERE decision NOT LIKE 'committed%' UNION ALL SELECT run_id, 'document', json_object('comparability', comparability, 'finished_at', finished_at, 'run_id', run_id, 'status_reason', reason, 'validity_status', validity_status)::VARCHAR FROM told WHERE decision LIKE 'committed%'", also="import_audit_whole")
def import_audit(spark, sf):
    """Write outcome documents and audit rows, read both back."""
    root = work_path(spark, "evidence")
    told = import_decision(spark, sf)
    outcome = told.select("run_id", "validity_status", "comparability", "finished_at", F.col("reason").alias("status_reason"))
    outcome_sink.write_evidence_json(outcome, told, root)
    audit = spark.read.parquet(f"{root}/import_audit").select("run_id", "decision", "reason")
    documents = spark.read.parquet(f"{root}/outcomes").select("run_id", F.lit("document").alias("decision"), F.col("document").alias("reason"))
    return audit.unionByName(documents)


@query(
    "perf_long",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 'latency' AS measure, 'mean' AS statistic, o_orderkey % 100 / 4.0 AS value FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'latency', 'p99', o_orderkey % 7 FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'tps', NULL, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END FROM orders""",
)
def perf_long(spark, sf):
    """Performance blocks of reports, carried to the runs and unfolded."""
    n = F.col("o_orderkey")
    block = b.text_of('{"latency":{"mean":', n % 100 / 4, ',"p99":', n % 7, '},"tps":', F.when(n % 5 == 0, F.lit('"unknown"')).otherwise(F.col("o_custkey").cast("string")), "}")
    reports = table(spark, sf, "orders").select(n.cast("string").alias("run_id"), block.alias("perf_metrics"))
    return outcome_sink.performance_values(outcome_sink.carry_performance(reports.select("run_id"), reports))


def outcomes(spark, sf):
    checked = imports.artifact_selfcheck(artifacts(spark, sf))
    n = F.col("run_id").cast("bigint")
    return checked.select(
        "run_id", "dataset", "suite", "model_id", "model_config_identity", "protocol_identity", "sample_manifest_identity",
        "validity_status", "comparability", "status_reason", F.when(n % 2 == 0, F.col("created_at")).alias("finished_at"),
        (n % 50 + 1).alias("num_requested"),
    )


@query(
    "upsert_outcome",
    W + """,
news AS (SELECT *, CASE WHEN n % 2 = 0 THEN created_at END AS done, n % 50 + 1 AS req FROM batch)
SELECT coalesce(h.run_id, a.run_id) AS run_id, CASE WHEN h.run_id IS NOT NULL THEN h.run_group END AS run_group,
  CASE WHEN a.run_id IS NOT NULL THEN a.validity_status ELSE h.validity_status END AS validity_status,
  CASE WHEN a.run_id IS NOT NULL THEN a.status_reason ELSE h.status_reason END AS status_reason,
  CASE WHEN a.run_id IS NOT NULL THEN req ELSE h.num_requested END AS num_requested,
  CASE WHEN h.run_id IS NOT NULL THEN h.dataset ELSE a.dataset END AS dataset,
  CASE WHEN a.run_id IS NULL THEN h.model_id ELSE coalesce(CASE WHEN trim(h.model_id) <> '' THEN h.model_id END, a.model_id) END AS model_id,
  CASE WHEN a.run_id IS NULL THEN h.model_config_identity ELSE coalesce(h.model_config_identity, CASE WHEN trim(a.model_config_identity) <> '' THEN a.model_config_identity END) END AS model_config_identity,
  CASE WHEN a.run_id IS NULL THEN h.sample_manifest_identity ELSE coalesce(CASE WHEN h.sample_manifest_identity <> '' THEN h.sample_manifest_identity END, a.sample_manifest_identity) END AS sample_manifest_identity,
  strftime(coalesce(done, h.finished_at), '%Y-%m-%d') AS finished_at
FROM history h FULL OUTER JOIN news a ON h.run_id = a.run_id""",
    also="upsert_outcome_whole",
)
def upsert_outcome(spark, sf):
    return history.upsert_outcome(stored_runs(spark, sf), outcomes(spark, sf)).select(
        "run_id", "run_group", "validity_status", "status_reason", "num_requested", "dataset", "model_id", "model_config_identity",
        "sample_manifest_identity", b.day("finished_at"),
    )


@query(
    "insert_attempts",
    W + """
SELECT CAST(o.n AS VARCHAR) AS run_id, CAST(0 AS BIGINT) AS attempt, h.run_id IS NULL AS inserted,
       1 + CAST(o.n % 7 = 0 AS BIGINT) - CAST(h.run_id IS NULL AS BIGINT) AS rejected_rows
FROM o LEFT JOIN history h ON h.n = o.n""",
)
def insert_attempts(spark, sf):
    n = F.col("o_orderkey")
    copies = F.when(n % 7 == 0, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(0))).cast("array<bigint>")
    new = table(spark, sf, "orders").select(
        n.cast("string").alias("run_id"), F.explode(copies).alias("attempt"), F.col("o_orderdate").alias("started_at")
    )
    return history.insert_attempts(stored_runs(spark, sf), new, ["attempt"]).select("run_id", "attempt", "inserted", "rejected_rows")


@query(
    "add_columns",
    W + "SELECT run_id, dataset, num_requested, CAST(NULL AS BIGINT) AS num_errored, CAST(NULL AS VARCHAR) AS imported_at, validity_status FROM every_run",
    also="add_columns_whole",
)
def add_columns(spark, sf):
    upgraded = history.add_columns(history.add_columns(stored_runs(spark, sf, "true"), RUNS), RUNS)
    return upgraded.select(
        "run_id", "dataset", "num_requested", "num_errored", F.col("imported_at").cast("string").alias("imported_at"), "validity_status"
    )


@query(
    "migrate_v1",
    W + """
SELECT CAST(n AS VARCHAR) AS run_id, 'm' || (c % 20) AS model_alias,
  CASE s WHEN 'F' THEN 'completed' WHEN 'O' THEN 'failed' ELSE 'interrupted' END AS execution_status,
  CASE s WHEN 'F' THEN 'legacy' ELSE 'invalid' END AS validity_status, 'migrated from v1' AS status_reason, 'legacy' AS comparability, '0.1.0' AS tool_version
FROM o WHERE n NOT IN (SELECT n FROM history)""",
)
def migrate_v1(spark, sf):
    status, c = F.col("o_orderstatus"), F.col("o_custkey")
    none = F.lit(None).cast("string")
    number = F.lit(None).cast("bigint")
    old = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), b.text_of("g", c % 9).alias("run_group"), b.text_of("m", c % 20).alias("model"),
        F.lit("s").alias("suite"), F.lit("lite").alias("profile"), F.col("o_orderpriority").alias("dataset"),
        F.when(status == "F", F.lit("success")).when(status == "O", F.lit("failed")).otherwise(F.lit("interrupted")).alias("status"),
        F.col("o_orderdate").alias("started_at"), F.col("o_orderdate").alias("finished_at"), number.alias("num_requested"),
        number.alias("num_succeeded"), number.alias("num_errored"), F.lit(False).alias("incomplete"), none.alias("version"),
        none.alias("git_commit"), none.alias("output_dir"), none.alias("config_json"), none.alias("error"),
    )
    return history.migrate_runs_v1(old, stored_runs(spark, sf)).select(
        "run_id", "model_alias", "execution_status", "validity_status", "status_reason", "comparability", "tool_version"
    )


@query(
    "migrate_v1_metrics",
    """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_returnflag, l_linestatus ORDER BY l_partkey, l_suppkey, l_discount) AS rn FROM lineitem)
SELECT CAST(l_orderkey AS VARCHAR) AS run_id, 'legacy:m' || l_linenumber AS metric_key, 'legacy:' || l_returnflag AS category_key,
       '["' || l_returnflag || '"]' AS category_json, l_linestatus AS subset, l_discount AS score
FROM ranked WHERE rn = 1 AND NOT (l_orderkey % 2 = 0 AND l_linenumber = 1 AND l_returnflag = 'A')""",
)
def migrate_v1_metrics(spark, sf):
    items = table(spark, sf, "lineitem")
    old = items.select(
        F.col("l_orderkey").cast("string").alias("run_id"), b.text_of("m", F.col("l_linenumber")).alias("metric"),
        F.col("l_returnflag").alias("category"), F.col("l_linestatus").alias("subset"), F.lit(1).cast("bigint").alias("num"),
        F.col("l_discount").alias("score"), F.col("l_tax").alias("macro_score"),
        F.struct("l_partkey", "l_suppkey", "l_discount").alias("pos"),
    )
    stored = items.filter((F.col("l_orderkey") % 2 == 0) & (F.col("l_linenumber") == 1) & (F.col("l_returnflag") == "A")).select(
        F.col("l_orderkey").cast("string").alias("run_id"), F.lit("legacy:m1").alias("metric_key"), F.lit("legacy:A").alias("category_key"),
        F.explode(F.array(F.lit("O"), F.lit("F"))).alias("subset"),
    )
    return history.migrate_metrics_v1(old, stored).select("run_id", "metric_key", "category_key", "category_json", "subset", "score")


@query(
    "migrate_v1_samples",
    W + """
SELECT CAST(n AS VARCHAR) AS run_id, 'legacy' AS subset, CASE n % 4 WHEN 1 THEN n % 5 WHEN 3 THEN CASE WHEN n % 3 = 0 THEN 3 END END AS selected, false AS media_evidence
FROM o WHERE n NOT IN (SELECT n FROM history)""",
)
def migrate_v1_samples(spark, sf):
    n = F.col("o_orderkey")
    ids = F.to_json(F.transform(F.filter(F.sequence(F.lit(1), F.lit(5)), lambda x: x <= n % 5), lambda x: x.cast("string")))
    text = (
        F.when(n % 4 == 1, ids).when((n % 4 == 3) & (n % 3 == 0), F.lit('{"a":["1"],"b":["2","3"]}')).when(n % 4 == 3, F.lit("broken["))
    )
    old = table(spark, sf, "orders").select(n.cast("string").alias("run_id"), F.lit("d").alias("dataset"), text.alias("sample_ids"))
    stored = stored_runs(spark, sf).select("run_id", F.lit("legacy").alias("subset"))
    return history.migrate_samples_v1(old, stored).select("run_id", "subset", "selected", "media_evidence")


@query(
    "sink_tables",
    "WITH " + b.RUNS_SQL + """
SELECT run_id, metric_name, score FROM metrics WHERE CAST(run_id AS BIGINT) % 3 <> 0
UNION ALL SELECT run_id, 'replaced', 0.5 FROM runs WHERE n % 3 = 0""",
)
def sink_tables(spark, sf):
    """Publish runs and metrics by key bucket, import a second batch into the touched buckets, read the current version."""
    root = work_path(spark, "history")
    runs = b.runs(spark, sf).select("run_id", "dataset", "validity_status", "status_reason")
    added = {"runs": lambda old, new: new, "metrics": lambda old, new: new}
    first = store.merge(spark, root, {"runs": runs, "metrics": b.metric_rows(spark, sf)}, "run_id", added, buckets=16)
    changed = store.read_table(spark, root, "runs").filter(F.col("run_id").cast("bigint") % 3 == 0).withColumn("status_reason", F.lit("imported"))
    new = changed.select("run_id", F.lit("replaced").alias("metric_name"), F.lit(0.5).alias("score"))
    how = {"runs": history.upsert_outcome, "metrics": lambda old, rows: history.replace_children(old, rows, changed)}
    store.merge(spark, root, {"runs": changed, "metrics": new}, "run_id", how, buckets=16, after=first)
    return store.read_table(spark, root, "metrics").select("run_id", "metric_name", "score")


@query(
    "get_attempt",
    "WITH " + b.RUNS_SQL + """,
top AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)
SELECT run_id, dataset, validity_status, subset, selected, row_number() OVER (ORDER BY subset) AS place
FROM runs JOIN top USING (run_id) JOIN (
  SELECT CAST(l_orderkey AS VARCHAR) AS run_id, 's' || l_linenumber AS subset, CAST(sum(l_quantity) AS BIGINT) AS selected FROM lineitem GROUP BY ALL) USING (run_id)""",
)
def get_attempt(spark, sf):
    """Publish every run and its manifest rows by bucket, then look up the run of the largest order: its row and its subsets in order."""
    root = work_path(spark, "lookup")
    key = F.col("l_orderkey").cast("string")
    rows = table(spark, sf, "lineitem").groupBy(key.alias("run_id"), b.text_of("s", F.col("l_linenumber")).alias("subset")).agg(
        F.sum("l_quantity").cast("bigint").alias("selected")
    )
    runs = b.runs(spark, sf).select("run_id", "dataset", "validity_status")
    fresh = lambda old, new: new
    store.merge(spark, root, {"runs": runs, "sample_manifest": rows}, "run_id", {"runs": fresh, "sample_manifest": fresh})
    top = table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select(F.col("o_orderkey").cast("string")).first()[0]
    extra = history.latest_extra(spark, root, top).withColumn("place", F.row_number().over(Window.partitionBy("run_id").orderBy("subset")))
    return history.get_attempt(spark, root, top).join(extra, "run_id").select("run_id", "dataset", "validity_status", "subset", "selected", F.col("place").cast("bigint").alias("place"))
