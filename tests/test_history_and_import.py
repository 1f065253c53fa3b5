import datetime as dt

import pytest
from pyspark.sql import functions as F

from proofmill.operators import history, imports
from proofmill.plans import report
from proofmill.schemas import SAMPLE_MANIFEST
from proofmill.sources import tables

RUN = "run_id string, dataset string, suite string, model_id string, model_config_identity string, protocol_identity string, sample_manifest_identity string, validity_status string, comparability string, status_reason string, finished_at timestamp"
DAY = dt.datetime(2026, 1, 1)


def test_outcomes_fill_only_unknown_identities_and_keep_times(spark):
    stored = spark.createDataFrame(
        [("a", "d", "s", "  ", "cfg", "p", "q", "complete", "verified", "old", DAY), ("b", "d", "s", "m", None, "p", "q", "partial", "unknown", "old", DAY)], RUN
    )
    new = spark.createDataFrame(
        [("a", "x", "x", "m2", "cfg2", "p2", "", "unverified", "unknown", "new", None), ("c", "d", "s", " ", "cfg", "p", "q", "complete", "verified", "new", DAY)], RUN
    )
    got = {r.run_id: r for r in history.upsert_outcome(stored, new).collect()}
    assert set(got) == {"a", "b", "c"}
    a = got["a"]
    assert (a.dataset, a.model_id, a.model_config_identity, a.sample_manifest_identity) == ("d", "m2", "cfg", "q")
    assert (a.validity_status, a.status_reason, a.finished_at) == ("unverified", "new", DAY)
    assert got["b"].status_reason == "old" and got["c"].model_id is None and got["c"].dataset == "d"


def test_a_known_run_is_never_replaced(spark):
    existing = spark.createDataFrame([("a",)], "run_id string")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1), ("c", 1)], "run_id string, n bigint")
    got = {r.run_id: (r.n, r.inserted, r.rejected_rows) for r in history.insert_attempts(existing, new, ["n"]).collect()}
    assert got == {"a": (1, False, 1), "b": (1, True, 1), "c": (1, True, 0)}


def test_children_of_rewritten_runs_are_replaced(spark):
    old = spark.createDataFrame([("a", "m1"), ("a", "m2"), ("b", "m1")], "run_id string, m string")
    new = spark.createDataFrame([("a", "m9")], "run_id string, m string")
    outcomes = spark.createDataFrame([("a",), ("z",)], "run_id string")
    assert sorted(tuple(r) for r in history.replace_children(old, new, outcomes).collect()) == [("a", "m9"), ("b", "m1")]


def test_adding_columns_twice_changes_nothing(spark):
    old = spark.createDataFrame([("a", "s", 3, "kept")], "run_id string, subset string, selected int, extra string")
    once = history.add_columns(old, SAMPLE_MANIFEST)
    twice = history.add_columns(once, SAMPLE_MANIFEST)
    assert once.columns == twice.columns and once.columns[-1] == "extra" and dict(once.dtypes)["selected"] == "bigint"
    assert twice.first().asDict() == once.first().asDict() and once.first().reviewed_extra is None


def test_version_one_samples(spark):
    old = spark.createDataFrame(
        [("a", "d", '["1","2"]'), ("b", "d", '{"x":["1"],"y":["2","3"]}'), ("c", "d", "{cut"), ("d", "d", None), ("kept", "d", "[]")],
        "run_id string, dataset string, sample_ids string",
    )
    stored = spark.createDataFrame([("kept", "legacy")], "run_id string, subset string")
    got = {r.run_id: (r.selected, r.media_evidence) for r in history.migrate_samples_v1(old, stored).collect()}
    assert got == {"a": (2, False), "b": (3, False), "c": (None, False), "d": (None, False)}


def test_readers_see_only_published_versions(spark, tmp_path):
    root = str(tmp_path / "store")
    first = spark.createDataFrame([("a", 1)], "run_id string, v int")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, root, "runs")
    tables.publish(spark, root, {"runs": first})
    tables.stage(spark, root, {"runs": first.withColumn("v", F.lit(9))})  # never activated
    assert tables.read_table(spark, root, "runs").first().v == 1
    tables.publish(spark, root, {"runs": first.withColumn("v", F.lit(2))}, cluster_by="run_id")
    assert tables.read_table(spark, root, "runs").first().v == 2


def test_a_stale_writer_fails_instead_of_undoing(spark, tmp_path):
    root = str(tmp_path / "store")
    first = spark.createDataFrame([("a", 1)], "run_id string, v int")
    tables.publish(spark, root, {"runs": first})
    read = tables.current_number(spark, root)
    tables.publish(spark, root, {"runs": first.withColumn("v", F.lit(2))}, after=read)
    with pytest.raises(tables.StaleVersionError):
        tables.publish(spark, root, {"runs": first.withColumn("v", F.lit(3))}, after=read)
    assert tables.read_table(spark, root, "runs").first().v == 2


def test_only_touched_buckets_are_written_again(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = spark.createDataFrame([(f"r{i}", i) for i in range(40)], "run_id string, v int")
    how = {"runs": lambda old, new: old.join(new.select("run_id"), "run_id", "left_anti").unionByName(new, allowMissingColumns=True).select("run_id", "v")}
    number = tables.merge(spark, root, {"runs": rows}, "run_id", how, buckets=8)
    before = {r.bucket: r.folder for r in tables.bucket_folders(spark, root).collect()}
    change = spark.createDataFrame([("r1", 100), ("new", 7)], "run_id string, v int")
    tables.merge(spark, root, {"runs": change}, "run_id", how, buckets=8, after=number)
    after = {r.bucket: r.folder for r in tables.bucket_folders(spark, root).collect()}
    touched = {r.b for r in change.select(tables.bucket_of(F.col("run_id"), 8).alias("b")).collect()}
    assert {b for b in after if before.get(b) != after[b]} == touched
    want = {f"r{i}": i for i in range(40)} | {"r1": 100, "new": 7}
    assert {r.run_id: r.v for r in tables.read_table(spark, root, "runs").collect()} == want
    with pytest.raises(tables.StaleVersionError):
        tables.merge(spark, root, {"runs": change}, "run_id", how, buckets=8, after=number)


def test_a_merge_starts_again_from_a_version_that_came_between(spark, tmp_path):
    root = str(tmp_path / "store")
    frame = lambda rows: spark.createDataFrame(rows, "run_id string, v int")
    add = {"runs": lambda old, new: old.unionByName(new)}
    tables.merge(spark, root, {"runs": frame([("a", 1)])}, "run_id", add, buckets=2)
    calls = []

    def slow(old, new):
        calls.append(old.count())
        if len(calls) == 1:  # another import is published meanwhile
            tables.merge(spark, root, {"runs": frame([("a", 2), ("b", 2)])}, "run_id", add, buckets=2)
        return old.unionByName(new)

    assert tables.merge(spark, root, {"runs": frame([("a", 3), ("b", 3)])}, "run_id", {"runs": slow}, buckets=2) == 3
    assert len(calls) == 2
    assert sorted(map(tuple, tables.read_table(spark, root, "runs").collect())) == [("a", 1), ("a", 2), ("a", 3), ("b", 2), ("b", 3)]


def test_lookups_read_one_bucket(spark, tmp_path):
    root = str(tmp_path / "store")
    runs = spark.createDataFrame([(f"r{i}", i) for i in range(50)], "run_id string, v int")
    rows = spark.createDataFrame([(f"r{i}", s, i) for i in range(50) for s in ("c", "a", "b")], "run_id string, subset string, selected int")
    fresh = lambda old, new: new
    tables.merge(spark, root, {"runs": runs, "sample_manifest": rows}, "run_id", {"runs": fresh, "sample_manifest": fresh}, buckets=8)
    found = history.get_attempt(spark, root, "r7", 8)
    assert [tuple(r) for r in found.collect()] == [("r7", 7)]
    assert {f.split("/")[-2] for f in found.inputFiles()} == {f"key_bucket={spark.range(1).select(tables.bucket_of(F.lit('r7'), 8)).first()[0]}"}
    assert [r.subset for r in history.latest_extra(spark, root, "r7", 8).collect()] == ["a", "b", "c"]
    assert history.get_attempt(spark, root, "absent", 8).count() == 0 and history.latest_extra(spark, root, "absent", 8).count() == 0


def test_a_bucket_may_become_empty(spark, tmp_path):
    root = str(tmp_path / "store")
    runs = spark.createDataFrame([("a", 1), ("b", 2)], "run_id string, v int")
    tables.merge(spark, root, {"runs": runs}, "run_id", {"runs": lambda old, new: new}, buckets=64)
    gone = {"runs": lambda old, new: old.join(new.select("run_id"), "run_id", "left_anti")}
    tables.merge(spark, root, {"runs": runs.where("run_id = 'a'")}, "run_id", gone, buckets=64)
    assert [tuple(r) for r in tables.read_table(spark, root, "runs").collect()] == [("b", 2)]


ARTIFACT = "run_id string, dataset string, suite string, model_id string, report_id string, model_config_identity string, protocol_identity string, declared_identity string, computed_identity string, parse_failure string, validity_status string, status_reason string, comparability string, created_at timestamp"


def artifact(run, **change):
    base = {
        "run_id": run, "dataset": "d", "suite": "s", "model_id": "m", "report_id": "m", "model_config_identity": "cfg", "protocol_identity": "p",
        "declared_identity": "q", "computed_identity": "q", "parse_failure": None, "validity_status": "complete", "status_reason": "complete", "comparability": "verified", "created_at": DAY,
    }
    return {**base, **change}


def stored(run, **change):
    base = {
        "run_id": run, "dataset": "d", "suite": "s", "model_id": "m", "model_config_identity": "cfg", "protocol_identity": "p", "sample_manifest_identity": "q",
        "validity_status": "complete", "comparability": "verified", "status_reason": "old", "finished_at": dt.datetime(2025, 5, 5),
    }
    return {**base, **change}


IMPORTS = [
    # artifact, stored row, decision, part of the reason
    (artifact("new"), None, "committed_new", "complete"),
    (artifact("again"), stored("again"), "committed_update", "complete"),
    (artifact("failed", parse_failure="ReportError: none"), stored("failed"), "failed", "ReportError"),
    (artifact("selfcheck", computed_identity="zz"), None, "rejected_selfcheck", "declared=q computed=zz"),
    (artifact("model", model_id="other", report_id="other"), stored("model"), "rejected_conflict", "model_id: db=m manifest=other"),
    (artifact("recovered", model_id=None), stored("recovered", validity_status="unverified"), "committed_update", "import_identity_unverifiable: model_id: <missing>"),
    (artifact("lost", model_config_identity=" "), stored("lost", validity_status="unverified"), "rejected_conflict", "model_config_identity: db=cfg manifest=<missing>"),
    (artifact("open", protocol_identity="p9"), stored("open", protocol_identity=" "), "committed_update", "complete"),
    (artifact("lower", validity_status="partial", status_reason="partial_completion"), stored("lower"), "rejected_downgrade", "partial_completion"),
    (artifact("same_partial", validity_status="partial"), stored("same_partial", validity_status="partial", comparability="unknown"), "rejected_downgrade", ""),
    (artifact("unproven", comparability="unknown"), stored("unproven"), "rejected_downgrade", ""),
    (artifact("blank", declared_identity=None, computed_identity=None), None, "committed_new", "sample_manifest_identity: <missing>"),
    (artifact("hollow", computed_identity=None), None, "committed_new", "declared without manifest content"),
]


def test_import_decisions(spark):
    artifacts = spark.createDataFrame([a for a, *_ in IMPORTS], ARTIFACT)
    kept = spark.createDataFrame([s for _, s, *_ in IMPORTS if s], RUN)
    metrics = spark.createDataFrame([("lower",), ("lower",)], "run_id string")
    got = {r.run_id: r for r in imports.import_decision(artifacts, kept, metrics).collect()}
    for case, old, decision, reason in IMPORTS:
        row = got[case["run_id"]]
        assert row.decision == decision and reason in row.reason, row
        if decision == "committed_update":
            assert row.finished_at == old["finished_at"]
    assert got["new"].finished_at == DAY and got["new"].sample_manifest_identity == "q"
    assert got["recovered"].validity_status == got["blank"].validity_status == "unverified"
    assert (got["lower"].metrics_kept, got["same_partial"].metrics_kept, got["lower"].validity_status) == (2, 0, "complete")
    committed, audit = imports.split_decisions(imports.import_decision(artifacts, kept, metrics))
    assert committed.count() + audit.count() == len(IMPORTS)


RUNS = "run_id string, model_alias string, model_config_identity string, dataset string, profile string, execution_status string, validity_status string, comparability string, status_reason string, started_at timestamp, finished_at timestamp, protocol_identity string, sample_manifest_identity string, harness_version string, diagnostics_json string"


def run(run_id, day=1, **change):
    base = {
        "run_id": run_id, "model_alias": "m", "model_config_identity": "cfg", "dataset": "d", "profile": "lite", "execution_status": "completed", "validity_status": "complete",
        "comparability": "verified", "status_reason": "a|b\nc" + "x" * 200, "started_at": dt.datetime(2026, 1, day), "finished_at": dt.datetime(2026, 1, day),
        "protocol_identity": "p", "sample_manifest_identity": "q", "harness_version": "1", "diagnostics_json": None,
    }
    return {**base, **change}


def metric(run_id, score=0.5, **change):
    base = {
        "run_id": run_id, "metric_name": "acc", "aggregation": "mean", "dimensions_json": "{}", "score": score, "macro_score": score, "num": 5, "display_kind": "percent", "unit": "%",
        "direction": "up", "is_primary": True, "category_key": report.TOP_CATEGORY_KEY, "subset": "",
    }
    return {**base, **change}


METRICS = "run_id string, metric_name string, aggregation string, dimensions_json string, score double, macro_score double, num bigint, display_kind string, unit string, direction string, is_primary boolean, category_key string, subset string"


@pytest.fixture(scope="module")
def seed(spark):
    runs = [
        run("old"), run("new", 2), run("tie1", 3, dataset="e"), run("tie2", 3, dataset="e"), run("smoke", profile="smoke"), run("partial", validity_status="partial", dataset="f"),
        run("other_cfg", model_config_identity="cfg2"), run("other_model", model_alias="n", model_config_identity=None), run("other_protocol", protocol_identity=None),
        run("no_metric"), run("null_score", dataset="g"), run("no_profile", profile=None), run("legacy", validity_status="legacy", comparability="legacy"),
        run("told", 4, validity_status="partial", comparability="unknown", diagnostics_json='{"generation_calls":3,"usage_totals":{"input_tokens":10.0},"agent_steps":{"max":2}}'),
        run("silent", 5, validity_status="partial", comparability="unknown", diagnostics_json='{"generation_calls":0}'),
    ]
    metrics = [metric(r["run_id"]) for r in runs if r["run_id"] not in ("no_metric", "null_score")] + [metric("null_score", None), metric("new", 0.1, subset="s"), metric("no_metric", is_primary=False)]
    return spark.createDataFrame(runs, RUNS), spark.createDataFrame(metrics, METRICS)


def test_formal_list_and_latest(seed):
    rows = report.formal_rows(*seed)
    formal = {"old", "new", "tie1", "tie2", "other_cfg", "other_model", "other_protocol", "null_score"}
    assert sorted(r.run_id for r in rows.collect()) == sorted(formal)
    assert {r.run_id for r in report.formal_rows(*seed, include_partial=True).collect()} == formal | {"partial"}
    latest = report.latest_per_key(rows)
    assert {r.run_id for r in latest.collect()} == formal - {"old", "tie1"}
    groups = {r.protocol: r for r in report.comparable_groups(latest).collect()}
    assert set(groups) == {"p", "unknown"} and groups["p"].sample_sizes == "d=5, d=5, d=5, e=5, g=5"
    members = {r.run_id: r.score_text for r in report.comparable_members(latest).collect()}
    assert members["new"] == "50.0%" and members["null_score"] == "N/A"


def test_every_run_is_in_exactly_one_list(seed):
    runs, _ = seed
    others = {r.run_id: r for r in report.diagnostic_rows(*seed).collect()}
    formal = {r.run_id for r in report.formal_rows(*seed).collect()}
    assert set(others) | formal == {r.run_id for r in runs.collect()} and not set(others) & formal
    assert others["smoke"].label == "diagnostic" and others["no_metric"].score_text == "N/A"
    assert others["legacy"].reason.startswith("a|b\nc") and len(others["legacy"].reason) > 140


def test_generation_table_is_whole_and_the_text_is_cut(seed):
    runs, _ = seed
    assert [(r.run_id, r.agent_steps_max, r.tokens) for r in report.generation_table(runs).collect()] == [("told", "2", "10/0")]
    whole = report.diagnostic_rows(*seed)
    assert report.newest(whole, 1).count() == 1 < whole.count()


def test_scores_are_printed_by_kind(spark):
    rows = spark.createDataFrame([(0.8, "percent", None), (0.5, None, "%"), (1.5, None, "pts"), (0.25, None, None), (0.0, "x", ""), (None, "percent", None)], "s double, k string, u string")
    got = [r.x for r in rows.select(report.format_score(F.col("s"), F.col("k"), F.col("u")).alias("x")).collect()]
    assert got == ["80.0%", "50.0%", "1.5000 pts", "0.2500", "0.0000", "N/A"]
