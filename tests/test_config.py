import json

import random

import pytest
from pyspark.sql import functions as F

from proofmill.operators import images, pinned, planning, redact, text_distance
from proofmill.sources.tables import current_version

DATASETS = "suite string, dataset string, dataset_pos int, core boolean, pinned boolean, full_limit int, batch_size int, sandbox string"


@pytest.fixture(scope="module")
def config(spark):
    selection = spark.createDataFrame([("a", 0, "s1"), ("a", 0, "s1"), ("b", 1, "s1"), ("a", 0, "s2")], "model_alias string, model_pos int, suite string")
    suites = spark.createDataFrame([("s1", 0, None, "shared"), ("s2", 1, 1, None)], "suite string, suite_pos int, batch_size int, sandbox string")
    datasets = spark.createDataFrame(
        [("s1", "core", 0, True, False, 100, None, None), ("s1", "extra", 1, False, False, None, 8, "own"), ("s2", "pin", 0, True, True, 50, None, None), ("s3", "x", 0, True, False, 1, 1, None)], DATASETS
    )
    return selection, suites, datasets


def plan_of(config, **change):
    rows = planning.expand_plan(*config, **{"profile": "lite", "profile_limit": 20, **change}).collect()
    return {(r.model_alias, r.dataset): (r.sample_limit, r.batch_size, r.sandbox) for r in rows}


def test_plan_expands_selected_models_by_suite(config):
    assert plan_of(config) == {("a", "core"): (20, 4, "shared"), ("b", "core"): (20, 4, "shared"), ("a", "pin"): (1, 1, None)}
    full = plan_of(config, profile="full", include_extensions=True)
    assert full["a", "core"][0] == 100 and full["b", "extra"] == (None, 8, "own") and full["a", "pin"][0] == 1
    assert plan_of(config, cli_limit=3, cli_batch=2)["a", "pin"] == (3, 2, None)


def test_named_datasets_override_the_core_filter(spark, config):
    explicit = spark.createDataFrame([("extra",)], "dataset string")
    assert set(plan_of(config, explicit=explicit)) == {("a", "extra"), ("b", "extra")}


def test_plan_coverage_counts_acceptable_runs(spark, config):
    runs = spark.createDataFrame([("a", "core", "completed", "complete"), ("a", "core", "failed", "invalid"), ("b", "core", "completed", "partial")], "model_alias string, dataset string, execution_status string, validity_status string")
    plan = planning.expand_plan(*config, profile="lite", profile_limit=20)
    got = {(r.model_alias, r.dataset): (r.attempts, r.covered) for r in planning.plan_coverage(plan, runs).collect()}
    assert got == {("a", "core"): (2, True), ("b", "core"): (1, False), ("a", "pin"): (0, False)}


def test_pinned_rows_are_checked_before_use(spark, tmp_path):
    table = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "id bigint, t string")
    wanted, root = spark.createDataFrame([(3,), (7,), (7,)], "id bigint"), str(tmp_path / "pin")
    assert pinned.pin_verify(spark, root, wanted, "id").first().reason.startswith("pinned dataset missing")
    assert pinned.pin_extract(spark, table, wanted, "id", root)["status"] == "created"
    assert pinned.pin_extract(spark, table, wanted, "id", root)["status"] == "exists"
    assert pinned.pin_verify(spark, root, wanted, "id").first().ok
    assert "provenance ids differ" in pinned.pin_verify(spark, root, spark.createDataFrame([(3,)], "id bigint"), "id").first().reason
    with pytest.raises(ValueError, match="expected exactly 1 rows"):
        pinned.pin_extract(spark, table, spark.createDataFrame([(99,)], "id bigint"), "id", root)
    part = next((tmp_path / "pin" / current_version(spark, root) / "data").glob("part-*.parquet"))
    data = part.read_bytes()
    spark.createDataFrame([(3, "changed"), (7, "t7")], "id bigint, t string").coalesce(1).write.parquet(str(tmp_path / "fake"))
    part.write_bytes(next((tmp_path / "fake").glob("part-*.parquet")).read_bytes())
    part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    assert data != part.read_bytes()
    assert "checksum mismatch" in pinned.pin_verify(spark, root, wanted, "id").first().reason


def test_nested_secrets_are_masked_and_counters_survive(spark):
    doc = {"api_key": "x", "max_tokens": 5, "n": {"X-Token": {"deep": [1]}, "l": ["sk-abcdefgh1", "https://u:p@h", None, {"password": 1, "k": 1.5}]}}
    rows = spark.createDataFrame([(json.dumps(doc),), ("not json sk-abcdefgh1",)], "c string")
    masked = [r.c for r in redact.redact_by_key(rows, "c").collect()]
    assert json.loads(masked[0]) == {
        "api_key": "***", "max_tokens": 5, "n": {"X-Token": "***", "l": ["***", "https://***@h", None, {"password": "***", "k": 1.5}]}
    }
    assert json.loads(masked[1]) == "not json ***"


def test_any_depth_is_followed_and_ordinary_data_stays(spark):
    deep = {"note": "plain", "password": "p", "n": [1, 2.5, None, True], "text": "sk-abcdefgh1 \\u000B \u000b"}
    want = {"note": "plain", "password": "***", "n": [1, 2.5, None, True], "text": "*** \\u000B \u000b"}
    for i in range(60):
        deep, want = ({"k": deep}, {"k": want}) if i % 2 else ([deep, "{"], [want, "{"])
    masked = redact.redact_by_key(spark.createDataFrame([(json.dumps(deep),)], "c string"), "c").first().c
    assert json.loads(masked) == want


def test_known_secrets_come_from_the_config_of_the_run(spark):
    configs = spark.createDataFrame([("a", '{"api_key":"k1","token":"EMPTY","secret":"***","password":"pw"}'), ("b", "{}")], "run_id string, config_json string")
    secrets = redact.collect_secrets(configs)
    assert {r.run_id: r.secrets for r in secrets.collect()} == {"a": ["k1", "pw"], "b": []}
    rows = spark.createDataFrame([("a", "k1 and pw"), ("b", "k1"), ("c", "k1")], "run_id string, t string")
    assert {r.run_id: r.t for r in redact.redact_known(rows, secrets, "t").collect()} == {"a": "*** and ***", "b": "k1", "c": "k1"}


def test_image_times(spark):
    texts = ["2026-01-01T05:00:00.5-05:00", "2026-01-01T10:00:00.123456789Z", "2026-01-01T12:00:00+02:00", "2026-01-01T10:00:00", "2026-01-01T10:00:00.5+01:00", "2026-01-01T05:00:00-05:00", "", None, "soon"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.unix_micros(images.image_time(F.col("t"))).alias("x"))
    ten = 1767261600_000000
    assert [r.x for r in rows.collect()] == [ten + 500000, ten + 123456, ten, ten, ten - 3600_000000 + 500000, ten, None, None, None]


def test_ownership(spark):
    references = spark.createDataFrame([(r, i) for i, rs in {"x": "abc", "y": "ad", "z": "ea"}.items() for r in rs], "run_id string, image string")
    attempts = spark.createDataFrame(
        [("a", 0, "2026-01-05T00:00:00Z", False), ("b", 1, None, True), ("c", 2, "2026-01-02T00:00:00Z", True), ("d", 3, None, True), ("e", 4, "2026-01-01T00:00:00Z", False)],
        "run_id string, run_pos int, attempt_start string, has_baseline boolean",
    )
    candidates = images.ownership_candidates(references, attempts)
    assert {r.image: r.run_id for r in candidates.collect()} == {"x": "c", "y": "d", "z": "a"}
    one = lambda *names: spark.createDataFrame([(n,) for n in names], "image string")
    start_only = spark.createDataFrame([("w", "a", "2026-01-01T00:00:00Z", None)], "image string, run_id string, attempt_start string, has_baseline boolean")
    created = spark.createDataFrame([(i, "2026-01-03T00:00:00.9Z", None) for i in "xyzw"], "image string, created_at string, inspect_error string")
    baseline = spark.createDataFrame([("b", "x")], "run_id string, image string")
    got = {r.image: (r["class"], r.reason) for r in images.ownership_classify(candidates.unionByName(start_only), one("x", "y", "z", "w"), one("q"), created, baseline).collect()}
    assert got["x"] == ("owned", None) and got["w"] == ("owned", None)
    assert got["y"] == ("unproven", "created=2026-01-03T00:00:00.9Z attempt_start=unknown")
    assert got["z"] == ("unproven", "no pre-run image inventory was recorded")
    kept = images.ownership_classify(candidates, one("x", "y"), one("y"), created, spark.createDataFrame([("c", "x")], "run_id string, image string"))
    assert {r.image: r["class"] for r in kept.collect()} == {"x": "unproven", "y": "in_use", "z": "absent"}


def test_edit_distance(spark):
    long = "ab" * 1250
    pairs = [("kitten", "sitting", 3), ("", "abc", 3), ("abc", "", 3), ("中文字", "中字", 1), ("é", "e", 1), ("ab", "ba", 2), (long, long[1:] + "z", 2)]
    rows = [(i, p, r) for i, (p, r, _) in enumerate(pairs)]
    predictions = spark.createDataFrame([(i, p) for i, p, _ in rows], "id int, prediction string")
    references = spark.createDataFrame([(i, r) for i, _, r in rows], "id int, reference string")
    got = {r.id: r.distance for r in text_distance.edit_distance_scores(predictions, references, "id").collect()}
    assert [got[i] for i in range(len(pairs))] == [d for *_, d in pairs]
    assert {r.distance for r in text_distance.edit_distance_scores(predictions, references, "id", 2).collect()} == {-1, 1, 2}


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, start=1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, start=1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_banded_distance_is_exact(spark):
    rng = random.Random(8)
    pairs = [("", ""), ("", "abc"), ("abc", ""), (None, "a"), ("a", None), ("same", "same"), ("ab", "ba"), ("aaaa", "aa"), ("中😀é", "é中")]
    for size in (1, 5, 40, 200):
        for _ in range(12):
            a = "".join(rng.choice("abcé😀") for _ in range(size))
            b = list(a)
            for _ in range(rng.choice([0, 1, 2, 5, size])):
                at = rng.randrange(len(b) + 1)
                b[at : at + rng.randrange(3)] = rng.choice(["", "x", "yz"])
            pairs.append((a, "".join(b)))
            pairs.append((a, "".join(rng.choice("abcé😀") for _ in range(rng.randrange(2 * size)))))
    left = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "id long, prediction string")
    right = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(pairs)], "id long, reference string")
    told = {r.id: r.distance for r in text_distance.edit_distance_scores(left, right, "id").collect()}
    assert told == {i: None if None in p else _distance(*p) for i, p in enumerate(pairs)}
    prefix = spark.createDataFrame([("abcd", "abxd"), ("", "a"), ("a" * 1000, "a" * 1023), ("😀b", "😀c")], "l string, r string")
    assert [r.n for r in prefix.select(text_distance.common_prefix(F.col("l"), F.col("r")).alias("n")).collect()] == [2, 0, 1000, 1]


def _masked_in_turn(text, secrets):
    for s in secrets:
        text = text.replace(s, "***") if s else text
    return text


def test_one_pass_masks_as_replacing_in_turn():
    rng = random.Random(9)
    for _ in range(600):
        secrets = ["".join(rng.choice("abc*" if rng.random() < 0.1 else "abc") for _ in range(rng.randrange(5))) for _ in range(rng.randrange(6))]
        text = "".join(rng.choice("abcd") for _ in range(rng.randrange(40)))
        assert redact.KnownSecrets(secrets).mask(text) == _masked_in_turn(text, secrets), (secrets, text)


def test_a_thousand_secrets_and_a_run_with_most_texts(spark):
    rng = random.Random(10)
    secrets = {run: [f"<{run}{i}>" for i in range(1000)] + ["", None, "<"] for run in ("hot", "b", "c")}
    secrets["none"] = None
    rows = [(i, rng.choice(["hot"] * 20 + ["b", "c", "none", "absent", None]), "".join(f"{rng.choice(['<hot', '<b', '<<c'])}{rng.randrange(1100)}> " for _ in range(3))) for i in range(3000)]
    rows.append((-1, "hot", None))
    frame = spark.createDataFrame([(i, run, {"k": i}, t) for i, run, t in rows], "id long, run_id string, extra map<string,long>, t string")
    known = spark.createDataFrame(list(secrets.items()), "run_id string, secrets array<string>")
    done = redact.redact_known(frame, known, "t")
    assert done.columns == frame.columns and [f.dataType for f in done.schema] == [f.dataType for f in frame.schema]
    expected = {i: None if t is None else _masked_in_turn(t, [s for s in secrets.get(run) or [] if s]) for i, run, t in rows}
    assert {r.id: r.t for r in done.collect()} == expected and all(r.extra == {"k": r.id} for r in done.collect())
    spread = frame.select("run_id", redact._spread(frame).alias("n")).distinct().collect()
    assert max(r.n for r in spread if r.run_id == "hot") > 500
    assert redact.redact_known(frame.limit(0), known, "t").count() == 0


def test_unlike_texts_cost_a_step_a_letter_of_the_shorter():
    """Distances by bits equal the table's, and two long texts are compared."""
    rng = random.Random(12)
    for _ in range(400):
        a, b = ("".join(rng.choice("abé😀") for _ in range(rng.randrange(60))) for _ in range(2))
        assert text_distance.bit_distance(a, b) == _distance(a, b)
        assert text_distance.bit_distance("xy" + a + "z", "xy" + b + "z") == _distance(a, b)
    assert text_distance.bit_distance("ab" * 100_000, "cd" * 1_500) == 200_000
    assert text_distance.bit_distance("", "") == 0
