import json

import pytest
from pyspark.sql import functions as F

from proofmill.operators import metrics, validity
from proofmill.sources import reports as source

QUALITY = {"kind": "quality", "display_kind": "percent", "direction": "higher_is_better", "display_unit": "%"}


def metric(name, aggregation="mean", dimensions=None, score=0.5, **extra):
    return {
        "identity": {"name": name, "aggregation": aggregation, "dimensions": dimensions or {}}, "num": 5, "score": score, "macro_score": score,
        "categories": [{"name": ["c", "é"], "num": 5, "score": score, "macro_score": None, "subsets": [{"name": "d", "score": score, "num": 2}]}],
        "semantics": QUALITY, **extra,
    }


def report(all_metrics, primary=None, dataset="set", model="m"):
    return {"dataset_name": dataset, "model_name": model, "metrics": all_metrics, "primary_metric_identity": primary}


def test_scan_keeps_broken_and_foreign_documents_apart(spark, tmp_path):
    (tmp_path / "reports" / "m").mkdir(parents=True)
    texts = {
        "good": json.dumps(report([metric("acc")])), "broken": "{not json", "tail": '{"metrics": []} x', "other": json.dumps({"metrics": {}, "dataset_name": "x"}),
        "list": "[1]", "noname": json.dumps({"metrics": []}), "nan": '{"dataset_name": null, "metrics": [{"score": NaN}]}',
    }
    for name, text in texts.items():
        (tmp_path / "reports" / "m" / f"{name}.json").write_text(text)
    rows = {r.path.rsplit("/", 1)[1][:-5]: r for r in source.scan_reports(spark, str(tmp_path / "reports")).collect()}
    assert {n for n, r in rows.items() if r.is_report} == {"good", "nan"}
    assert {n for n, r in rows.items() if r.parse_error} == {"broken", "tail"}
    assert rows["good"].dataset_name == "set" and rows["nan"].metrics[0].score == "NaN"


def test_ownership(spark):
    runs = spark.createDataFrame([(r, "set", "Pretty", "m") for r in ("one", "pretty", "two", "foreign", "broken", "both", "none")], "run_id string, dataset string, pretty_name string, report_id string")
    docs = [
        ("one", "a", "set", "m", True, False), ("one", "b", "other", "m", True, False), ("pretty", "a", "Pretty", "m", True, False),
        ("two", "a", "set", "m", True, False), ("two", "b", "set", "m", True, False), ("foreign", "a", "set", "x", True, False),
        ("broken", "a", None, None, False, True), ("both", "a", "set", "x", True, False), ("both", "b", None, None, False, True),
    ]
    documents = spark.createDataFrame(docs, "run_id string, path string, dataset_name string, model_name string, is_report boolean, parse_error boolean")
    got = {r.run_id: (r.result, r.report_path) for r in metrics.report_ownership(runs, documents).collect()}
    assert got == {
        "one": ("ok", "a"), "pretty": ("ok", "a"), "two": ("ambiguous", None), "foreign": ("mismatch", None), "broken": ("parse_error", None),
        "both": ("mismatch", None), "none": ("missing", None),
    }


@pytest.fixture(scope="module")
def flat(spark):
    named = {"name": "pass", "aggregation": "pass_at_k", "dimensions": {"k": 3}}
    documents = {
        "r": report([metric("pass", "pass_at_k", {"k": 5}), metric("pass", "pass_at_k", {"k": 3}, score=0), metric("pass")], named),
        "twice": report([metric("acc"), metric("acc")]),
        "unnamed": report([{"identity": None, "legacy_name": "old", "score": None}, {"identity": {"name": " "}, "score": float("nan")}, {"score": True}]),
    }
    rows = spark.createDataFrame([(k, json.dumps(d)) for k, d in documents.items()], "run_id string, document string")
    return metrics.metric_flatten(source.report_columns(rows))


def test_flatten_three_levels_with_one_primary(flat):
    rows = sorted((r for r in flat.collect() if r.run_id == "r"), key=lambda r: r.pos)
    assert len(rows) == 9 and len({r.metric_key for r in rows}) == 3
    primary = [r for r in rows if r.is_primary]
    assert [(r.category_json, r.subset, r.score, r.macro_score, r.num) for r in primary] == [
        ("[]", "", 0.0, 0.0, 5), ('["c","é"]', "", 0.0, None, 5), ('["c","é"]', "d", 0.0, None, 2)
    ]
    assert {r.dimensions_json for r in rows} == {'{"k":5}', '{"k":3}', "{}"}
    assert all(r.unit == "%" and r.identity_valid for r in rows)


def test_unnamed_metrics_keep_a_display_name_but_no_identity(flat):
    rows = sorted((r for r in flat.collect() if r.run_id == "unnamed"), key=lambda r: r.pos)
    assert [(r.metric_name, r.identity_valid, r.is_primary, r.score, r.score_problem) for r in rows] == [
        ("old", False, False, None, None),
        (" ", False, False, None, "metrics[1].score: non-finite score"),
        ("metric", False, False, None, "metrics[2].score: boolean is not a score"),
    ]


def test_repeated_identity_is_found(flat):
    told = {r.run_id: (r.repeated_identities, r.surplus_rows) for r in metrics.duplicate_metric_check(flat).collect()}
    # the whole metric repeats with its category and subset; two metrics without a name share one identity
    assert told == {"twice": (3, 3), "unnamed": (1, 1)}


def primary_row(run, **change):
    row = {"run_id": run, "pos": 0, "metric_name": "acc", "metric_key": "k", "identity_valid": True, "semantics_kind": "quality", "score": 0.0, "num": 5, "is_primary": True}
    return {**row, **change}


LADDER = [
    # run, run changes, metric rows, selected, (execution, validity), start of the reason
    ("ok", {}, [{}], 5, ("completed", "complete"), "complete: succeeded=5/5"),
    ("no_manifest", {}, [{}], None, ("completed", "complete"), "complete"),
    ("interrupted", {"interrupted": True, "task_error": "x"}, [], None, ("interrupted", "invalid"), "interrupted by user"),
    ("task", {"task_error": "boom"}, [], None, ("failed", "invalid"), "task_error: boom"),
    ("report", {"report_error_kind": "ambiguous", "report_error": "many"}, [{}], 5, ("completed", "invalid"), "report_ambiguous: many"),
    ("nothing", {}, [], 5, ("completed", "invalid"), "no_metrics"),
    ("diagnostic", {}, [{"semantics_kind": "diagnostic"}], 5, ("completed", "invalid"), "no_quality_metric"),
    ("plain", {}, [{"semantics_kind": None}], 5, ("completed", "invalid"), "metric_semantics_missing"),
    ("no_primary", {}, [{"is_primary": False}], 5, ("completed", "unverified"), "missing_primary_metric"),
    ("second", {}, [{"semantics_kind": "diagnostic"}, {"pos": 1, "is_primary": False}], 5, ("completed", "invalid"), "primary_metric_not_quality: acc"),
    ("first_wins", {}, [{"pos": 3, "score": None}, {"pos": 1}], 5, ("completed", "complete"), "complete"),
    ("no_key", {}, [{"metric_key": ""}], 5, ("completed", "invalid"), "primary_metric_invalid_identity"),
    ("unnamed", {}, [{"identity_valid": False}], 5, ("completed", "invalid"), "primary_metric_invalid_identity: report identity has no name"),
    ("null_score", {}, [{"score": None}], 5, ("completed", "unverified"), "primary_metric_missing_score: acc"),
    ("no_num", {}, [{"num": None}], 5, ("completed", "unverified"), "primary_metric_no_samples: None"),
    ("no_summary", {"execution_summary": "{}"}, [{}], 5, ("completed", "unverified"), "missing_execution_summary"),
    ("list", {"execution_summary": "[5]"}, [{}], 5, ("completed", "unverified"), "invalid_execution_summary: list"),
    ("text_count", {"execution_summary": '{"requested":"5","succeeded":5}'}, [{}], 5, ("completed", "unverified"), "invalid_execution_summary: counts must be integers"),
    ("half", {"execution_summary": '{"requested":5.5,"succeeded":5}'}, [{}], 5, ("completed", "unverified"), "invalid_execution_summary: counts must be integers"),
    ("bool_count", {"execution_summary": '{"requested":5,"succeeded":true}'}, [{}], 5, ("completed", "unverified"), "invalid_execution_summary: counts must be integers"),
    ("float_ok", {"execution_summary": '{"requested":5.0,"succeeded":5,"incomplete":0}'}, [{}], 5, ("completed", "complete"), "complete: succeeded=5/5"),
    ("bad_flag", {"execution_summary": '{"requested":5,"succeeded":5,"incomplete":"no"}'}, [{}], 5, ("completed", "unverified"), "invalid_execution_summary: incomplete"),
    ("negative", {"execution_summary": '{"requested":5,"succeeded":5,"errored":-1}'}, [{}], 5, ("completed", "unverified"), "inconsistent_execution_summary: negative"),
    ("over", {"execution_summary": '{"requested":5,"succeeded":6}'}, [{}], 9, ("completed", "unverified"), "inconsistent_execution_summary: succeeded=6 > requested=5"),
    ("errors", {"execution_summary": '{"requested":5,"succeeded":0,"errored":6}'}, [{}], 9, ("completed", "unverified"), "inconsistent_execution_summary: errored=6"),
    ("sum", {"execution_summary": '{"requested":5,"succeeded":4,"errored":2}'}, [{}], 9, ("completed", "unverified"), "inconsistent_execution_summary: succeeded+errored=6"),
    ("zero", {"execution_summary": '{"requested":0,"succeeded":0}'}, [{}], 9, ("completed", "unverified"), "no_requested_samples"),
    ("beyond", {}, [{}], 4, ("completed", "unverified"), "requested_exceeds_manifest: requested=5 selected=4"),
    ("unknown", {"execution_summary": '{"requested":5}'}, [{}], 5, ("completed", "unverified"), "missing_succeeded_count"),
    ("all_failed", {"execution_summary": '{"requested":5,"succeeded":0,"errored":5}'}, [{}], 5, ("completed", "invalid"), "all_samples_failed: requested=5 errored=5"),
    ("partial", {"execution_summary": '{"requested":5,"succeeded":4,"errored":1}'}, [{}], 5, ("completed", "partial"), "partial_completion: succeeded=4/5 errored=1"),
    ("cut", {"execution_summary": '{"requested":5,"succeeded":5,"incomplete":true}'}, [{}], 5, ("completed", "partial"), "upstream_marked_incomplete"),
    ("too_many", {}, [{"num": 6}], 5, ("completed", "unverified"), "primary_metric_count_exceeds_succeeded: metric_num=6 succeeded=5"),
]


def test_every_rule_of_the_ladder(spark):
    base = {"interrupted": False, "task_error": None, "report_error_kind": None, "report_error": None, "execution_summary": '{"requested":5,"succeeded":5,"errored":0,"incomplete":false}'}
    runs = spark.createDataFrame(
        [{"run_id": run, **base, **change} for run, change, *_ in LADDER],
        "run_id string, interrupted boolean, task_error string, report_error_kind string, report_error string, execution_summary string",
    )
    rows = spark.createDataFrame(
        [primary_row(run, **change) for run, _, changes, *_ in LADDER for change in changes],
        "run_id string, pos bigint, metric_name string, metric_key string, identity_valid boolean, semantics_kind string, score double, num bigint, is_primary boolean",
    )
    manifest = spark.createDataFrame([(c[0], c[3]) for c in LADDER if c[3] is not None], "run_id string, selected bigint")
    got = {r.run_id: r for r in validity.assess_run(runs, rows, manifest).collect()}
    assert len(got) == len(LADDER)
    for run, _, _, _, statuses, reason in LADDER:
        assert (got[run].execution_status, got[run].validity_status) == statuses, run
        assert got[run].status_reason.startswith(reason), (run, got[run].status_reason)


def test_reason_names_missing_comparability(value):
    told = validity.compose_reason(F.lit("complete"), F.lit("complete: succeeded=1/1"), F.lit("unknown"), F.lit("why"))
    assert value(told) == "complete: succeeded=1/1; comparability: why"
    assert value(validity.compose_reason(F.lit("partial"), F.lit("r"), F.lit("unknown"), F.lit("why"))) == "r"


def test_batch_needs_results_and_only_accepted_ones(spark):
    rows = [("good", True, "completed", "complete"), ("part", True, "completed", "partial"), ("lost", False, "completed", "complete"), ("bad", True, "failed", "invalid"), ("bad", True, "completed", "complete")]
    results = spark.createDataFrame(rows, "run_group string, persisted boolean, execution_status string, validity_status string")
    groups = spark.createDataFrame([(g,) for g in ("good", "part", "lost", "bad", "empty")], "run_group string")
    accepted = lambda partial: {r.run_group for r in validity.batch_acceptance(groups, results, partial).collect() if r.accepted}
    assert accepted(False) == {"good"} and accepted(True) == {"good", "part"}


def test_counts_and_misshapen_metrics_are_named_not_lost(spark):
    good = {"identity": {"name": "acc"}, "num": 5, "score": 1}
    members = [good, good | {"num": 5.0}, good | {"num": "5"}, good | {"num": 5.5}, good | {"num": True}, 7, None, good | {"categories": {"no": "list"}}, good | {"num": None}]
    document = json.dumps({"dataset_name": "d", "model_name": "m", "metrics": members})
    rows = source.parse_reports(spark.createDataFrame([("r", "p", document)], "run_id string, path string, document string"))
    assert rows.first().is_report and len(rows.first().metrics) == len(members)
    got = {r.pos.metric: (r.num, r.score_problem) for r in metrics.metric_flatten(rows).collect()}
    whole, shape = "count is not a whole number", "metric does not have the shape of one"
    assert got == {
        0: (5, None), 1: (5, None), 2: (5, None), 3: (None, f"metrics[3].num: {whole}"), 4: (None, f"metrics[4].num: {whole}"),
        5: (None, f"metrics[5]: {shape}"), 6: (None, f"metrics[6]: {shape}"), 7: (5, f"metrics[7]: {shape}"), 8: (None, None),
    }
