"""Attempt folders to verdicts to import decisions, through files."""

import hashlib
import json

from pyspark.sql import functions as F

from proofmill.operators import evidence, metrics
from proofmill.plans import verdicts
from proofmill.sources import lines, manifests, reports

RUN = "r1"


def sha(doc):
    return hashlib.sha256(json.dumps(doc, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def attempt(root, reviewed):
    identity = {"name": "acc", "aggregation": "mean", "dimensions": {}}
    report = {
        "dataset_name": "set", "model_name": "model-a", "primary_metric_identity": identity,
        "metrics": [{"identity": identity, "num": 2, "score": 0, "macro_score": 0, "semantics": {"kind": "quality"}, "categories": []}],
        "execution_summary": {"requested": 2, "succeeded": 2, "errored": 0, "incomplete": False}, "perf_metrics": {"latency": {"mean": 1.5}},
    }
    row = {
        "subset": "default", "selected": 2, "sample_ids": ["0", "1"], "question_digest": sha(["a", "b"]), "media_digest": sha([sha({"media": []})] * 2),
        "input_digest": sha(["c", "d"]), "media_evidence": True,
    }
    manifest = {
        "attempt_id": RUN, "dataset": "set", "suite": "s", "model_id": "m", "report_id": "model-a", "model_config_identity": "cfg", "protocol_identity": "p",
        "sample_manifest": [row], "sample_manifest_identity": sha([row]), "created_at": "2026-01-01T00:00:00+08:00", "task_config": {"api_key": "***"},
    }
    doc = {"model_output": {"choices": [{"stop_reason": "stop"}], "usage": {"input_tokens": 1}}}
    files = {
        "reports/model-a/set.json": json.dumps(report), "run_manifest.json": json.dumps(manifest, indent=2),
        "predictions/model-a/set_default.jsonl": "\n".join(json.dumps({**doc, "index": i}) for i in range(2)),
        "reviews/model-a/set_default.jsonl": "\n".join(json.dumps({**doc, "index": i}) for i in range(reviewed)),
    }
    for name, text in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


def decide(spark, root):
    scanned = manifests.scan_run_manifests(spark, str(root))
    documents = reports.scan_reports(spark, f"{root}/reports").withColumn("run_id", F.lit(RUN))
    asked = scanned.select("run_id", "dataset", F.lit(None).cast("string").alias("pretty_name"), "report_id")
    owned = metrics.report_ownership(asked, documents)
    matched = documents.join(owned.filter(F.col("result") == "ok").select("run_id", F.col("report_path").alias("path")), ["run_id", "path"])
    rows = manifests.manifest_rows(scanned)
    runs = owned.join(matched.select("run_id", "execution_summary"), "run_id", "left").select(
        "run_id", F.lit(False).alias("interrupted"), F.lit(None).cast("string").alias("task_error"),
        F.when(F.col("result") != "ok", F.col("result")).alias("report_error_kind"), F.lit(None).cast("string").alias("report_error"), "execution_summary",
    )
    samples = rows.select("run_id", "subset", F.explode(F.from_json("sample_ids_json", "array<string>")).alias("sample_id"))
    facts = evidence.typed_evidence(lines.scan_attempt_lines(spark, str(root), RUN, "set", "model-a"))
    told = verdicts.outcomes(runs, samples, rows, facts, metrics.metric_flatten(matched))
    assessed = told.withColumn("parse_failure", F.lit(None).cast("string"))
    history = spark.createDataFrame([], "run_id string, dataset string, suite string, model_id string, model_config_identity string, protocol_identity string, sample_manifest_identity string, validity_status string, comparability string, finished_at timestamp")
    stored = spark.createDataFrame([], "run_id string")
    return told.first(), verdicts.import_batch(scanned, assessed, history, stored).first()


def test_a_zero_score_is_a_complete_verified_run(spark, tmp_path):
    attempt(tmp_path, reviewed=2)
    told, decision = decide(spark, tmp_path)
    assert (told.execution_status, told.validity_status, told.comparability) == ("completed", "complete", "verified")
    assert told.status_reason == "complete: succeeded=2/2" and told.num_requested == 2
    counted = json.loads(told.diagnostics_json)
    assert counted["generation_calls"] == 2 and counted["usage_totals"]["input_tokens"] == 2.0
    assert (decision.decision, decision.validity_status) == ("committed_new", "complete")
    assert str(decision.finished_at) == "2025-12-31 16:00:00"


def test_a_missing_review_keeps_the_run_out_of_the_formal_list(spark, tmp_path):
    attempt(tmp_path, reviewed=1)
    told, decision = decide(spark, tmp_path)
    assert (told.validity_status, told.comparability) == ("complete", "unknown")
    assert told.status_reason == "complete: succeeded=2/2; comparability: default: reviewed missing evidence keys ['1#r0']"
    assert decision.decision == "committed_new" and decision.comparability == "unknown"


def manifest_row(subset, ids):
    return {
        "subset": subset, "selected": len(ids), "sample_ids": ids, "question_digest": sha(["q"]), "media_digest": sha(["m"]), "input_digest": sha(["i"]),
        "media_evidence": True,
    }


def test_declared_identities_are_checked_in_their_own_row(spark):
    """Many subsets, numeric ids, nested extras and odd characters; detail only; a wrong declaration."""
    many = [manifest_row(f"s{i}", [str(i)]) for i in range(513)]
    numeric = [manifest_row("n", [1, 2, 3]) | {"note\u000b": {"a": [{"b": "\u001f\\u001F"}]}}]
    samples = [{"id": str(i), "question_digest": f"q{i}", "media_digest": f"m{i}", "input_digest": f"i{i}", "media_evidence": True} for i in range(3)]
    built = [
        {"subset": "d", "selected": 3, "sample_ids": ["0", "1", "2"], "media_evidence": True, "question_digest": sha(["q0", "q1", "q2"]),
         "media_digest": sha(["m0", "m1", "m2"]), "input_digest": sha(["i0", "i1", "i2"])}
    ]
    ids = {"model_id": "m", "model_config_identity": "c", "protocol_identity": "p", "dataset": "d", "suite": "s", "created_at": "2026-01-01T00:00:00Z"}
    documents = {
        "many": {"sample_manifest": many, "sample_manifest_identity": sha(many)}, "numeric": {"sample_manifest": numeric, "sample_manifest_identity": sha(numeric)},
        "detail": {"sample_manifest_detail": {"d": samples}, "sample_manifest_identity": sha(built)},
        "wrong": {"sample_manifest": many, "sample_manifest_identity": sha(numeric)},
    }
    rows = [(name, json.dumps({"attempt_id": name, **ids, **doc})) for name, doc in documents.items()] + [("broken", "[1")]
    parsed = manifests.parse_run_manifests(spark.createDataFrame(rows, "path string, document string"))
    assert {r.path: r.parse_failure is not None for r in parsed.collect()} == {"many": False, "numeric": False, "detail": False, "wrong": False, "broken": True}
    told = parsed.where("run_id IS NOT NULL")
    assessed = told.select("run_id", F.lit("complete").alias("validity_status"), F.lit("ok").alias("status_reason"), F.lit("verified").alias("comparability"), "parse_failure")
    history = spark.createDataFrame([], "run_id string, dataset string, suite string, model_id string, model_config_identity string, protocol_identity string, sample_manifest_identity string, validity_status string, comparability string, finished_at timestamp")
    decided = verdicts.import_batch(told.drop("parse_failure"), assessed, history, spark.createDataFrame([], "run_id string"))
    assert {r.run_id: r.decision for r in decided.collect()} == {"many": "committed_new", "numeric": "committed_new", "detail": "committed_new", "wrong": "rejected_selfcheck"}
