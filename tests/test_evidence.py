import json
import random
import re

import pytest
from pyspark.sql import functions as F

from proofmill.functions.scalars import plain_integer
from proofmill.operators import coverage, diagnostics, evidence
from proofmill.plans.verdicts import coverage_verdicts
from proofmill.sources import attempts
from proofmill.sources import lines as source
from workload import campaign_queries

LINES = "run_id string, kind string, subset string, source string, line string"


def lines_of(run, predicted, reviewed, subset="default"):
    rows = [(run, "predicted", subset, "p", x if isinstance(x, str) else json.dumps(x)) for x in predicted]
    return rows + [(run, "reviewed", subset, "v", x if isinstance(x, str) else json.dumps(x)) for x in reviewed]


def facts(spark, predicted, reviewed=()):
    return evidence.typed_evidence(spark.createDataFrame(lines_of("r", predicted, reviewed), LINES))


def line(i, repeat=None, stop="stop"):
    doc = {"index": i, "model_output": {"choices": [{"stop_reason": stop}], "usage": {"input_tokens": 10, "output_tokens": 5}}}
    return doc if repeat is None else {**doc, "repeat_id": repeat}


# Coverage cases, one run each: selected ids, predicted lines, reviewed lines.
CASES = {
    "matched": (["0", "1"], [line(0), line(1)], [line(0), line(1)]),
    "missing_review": (["0", "1"], [line(0), line(1)], [line(0)]),
    "disjoint": (["0", "1"], [line(100), line(101)], [line(100), line(101)]),
    "duplicate": (["0"], [line(0), line(0)], [line(0)]),
    "repeats": (["0"], [line(0, 0), line(0, 1)], [line(0, 0), line(0, 1)]),
    "other_repeat": (["0"], [line(0, 0)], [line(0, 1)]),
    "half_reviewed": (["0"], [line(0, 0), line(0, 1)], [line(0, 0)]),
    "broken": (["0"], [line(0), "{broken"], [line(0)]),
    "many_missing": ([str(i) for i in range(9)], [], []),
}


@pytest.fixture(scope="module")
def verdicts(spark):
    """All cases in one batch: merged coverage rows, gap lists and verdicts by run."""
    table = None
    for run, (_, predicted, reviewed) in CASES.items():
        if predicted or reviewed:
            part = lines_of(run, predicted, reviewed)
            table = part if table is None else table + part
    table += lines_of("matched_other", [line(0)], [line(0)]) + lines_of("matched_other", [line(0)], (), "other")
    evidence_table = evidence.typed_evidence(spark.createDataFrame(table, LINES))
    ids = {**{run: c[0] for run, c in CASES.items()}, "matched_other": ["0"]}
    samples = spark.createDataFrame([(r, "default", i) for r, own in ids.items() for i in own], "run_id string, subset string, sample_id string")
    manifest = spark.createDataFrame(
        [(r, "default", 0, len(own), "q", "i", True) for r, own in ids.items()],
        "run_id string, subset string, subset_pos bigint, selected bigint, question_digest string, input_digest string, media_evidence boolean",
    )
    runs = spark.createDataFrame([(r,) for r in [*ids, "no_manifest"]], "run_id string")
    counts = coverage.key_counts(evidence_table)
    per_sample = coverage.sample_counts(samples, counts)
    merged = coverage.coverage_merge(manifest, coverage.subset_coverage(per_sample)).collect()
    gaps = coverage.coverage_gaps(per_sample, counts).collect()
    told = coverage_verdicts(runs, samples, manifest, evidence_table).collect()
    return (
        {r.run_id: r for r in merged},
        {run: {(g.kind, g.gap, g.key) for g in gaps if g.run_id == run} for run in ids},
        {r.run_id: r for r in told},
    )


def test_keys(spark):
    cases = [
        ({"sample_id": 3}, "3", 0), ({"index": 4, "repeat": 2}, "4", 2), ({"sample_id": None, "index": 4}, None, 0),
        ({"sample_id": None, "sample_score": {"sample_id": 9}}, "9", 0), ({"index": 1, "repeat_id": "7"}, "1", 7),
        ({"index": 1, "repeat_id": "x"}, "1", 0), ({"index": 1, "repeat_id": 1.9}, "1", 1), ({"index": 1, "repeat_id": True}, "1", 1),
        ({"index": 1, "repeat_id": None, "repeat": 5}, "1", 0), ({"sample_id": "a#r1"}, "a#r1", 0), ({"x": 1}, None, 0),
        ({"sample_id": 1, "model_output": "text", "sample_score": 5}, "1", 0),
    ]
    rows = [("r", "predicted", str(n).zfill(2), "p", json.dumps(doc)) for n, (doc, _, _) in enumerate(cases)]
    got = evidence.evidence_key(spark.createDataFrame(rows, LINES)).orderBy("subset").collect()
    for row, (doc, sample_id, repeat) in zip(got, cases, strict=True):
        assert (row.sample_id, row.repeat) == (sample_id, repeat), doc
        assert row.problem == (None if sample_id else "no sample id"), doc


def test_lines_that_are_no_objects_are_quarantined(spark):
    bad = ["{broken", "5", "[1]", '"text"', '{"index": 1} tail', "null"]
    table = facts(spark, [line(0), *bad])
    assert evidence.malformed_summary(table).first().asDict() == {
        "run_id": "r", "malformed_lines": len(bad), "without_sample_id": 0, "unparsable": len(bad)
    }
    lines = spark.createDataFrame([("r", "predicted", "s", "p", x) for x in bad], LINES)
    kept = evidence.malformed_lines(lines).collect()
    assert sorted(r.line for r in kept) == sorted(bad) and {r.problem for r in kept} == {"not a JSON object"}


def test_coverage_counts(verdicts):
    rows, _, _ = verdicts
    pick = lambda run, *names: tuple(rows[run][n] for n in names)
    assert pick("matched", "predicted", "reviewed", "predicted_missing", "reviewed_extra") == (2, 2, 0, 0)
    assert pick("missing_review", "predicted", "reviewed", "reviewed_missing") == (2, 1, 1)
    assert pick("disjoint", "predicted", "predicted_missing", "predicted_extra") == (0, 2, 2)
    assert pick("duplicate", "predicted_duplicates", "reviewed_duplicates") == (1, 0)
    assert pick("repeats", "predicted", "predicted_total", "predicted_duplicates", "reviewed") == (1, 2, 0, 2)
    assert pick("many_missing", "predicted", "predicted_total", "predicted_missing") == (0, 0, 9)


def test_gap_lists_name_every_key(verdicts):
    _, gaps, _ = verdicts
    assert gaps["matched"] == gaps["repeats"] == gaps["broken"] == set()
    assert gaps["missing_review"] == {("reviewed", "missing", "1#r0")}
    assert {g for g in gaps["disjoint"]} == {
        ("predicted", "missing", "0"), ("predicted", "missing", "1"), ("predicted", "extra", "100"), ("predicted", "extra", "101")
    }
    assert gaps["other_repeat"] == {("reviewed", "missing", "0#r0"), ("reviewed", "extra", "0#r1")}
    assert gaps["half_reviewed"] == {("reviewed", "missing", "0#r1")}
    assert len(gaps["many_missing"]) == 9


def test_verdicts_and_their_reasons(verdicts):
    _, _, told = verdicts
    assert {r for r in told if told[r].comparability == "verified"} == {"matched", "repeats"}
    assert told["matched"].comparability_reason == "content evidence complete"
    assert told["missing_review"].comparability_reason == "default: reviewed missing evidence keys ['1#r0']"
    assert "default: predicted duplicate evidence keys x1" in told["duplicate"].comparability_reason
    assert told["broken"].comparability_reason == "1 malformed evidence line(s)"
    assert told["matched_other"].comparability_reason == "unexpected evidence subsets: ['other']"
    assert told["no_manifest"].comparability_reason == "no_sample_manifest"
    # five keys are quoted, the count of the row stays whole
    assert told["many_missing"].comparability_reason == "default: predicted missing evidence keys ['0', '1', '2', '3', '4']"


def test_without_selected_samples_every_prediction_is_extra(spark):
    samples = spark.createDataFrame([], "run_id string, subset string, sample_id string")
    row = coverage.subset_coverage(coverage.sample_counts(samples, coverage.key_counts(facts(spark, [line(0), line(1)])))).first()
    assert (row.predicted, row.predicted_missing, row.predicted_extra) == (2, 0, 2)


def test_counts_add_up_under_heavy_skew(spark):
    lines = [line(i % 50) for i in range(300)] + [line(7)] * 900
    samples = spark.createDataFrame([("r", "default", str(i)) for i in range(60)], "run_id string, subset string, sample_id string")
    row = coverage.subset_coverage(coverage.sample_counts(samples, coverage.key_counts(facts(spark, lines)))).first()
    assert row.predicted + row.predicted_missing == row.expected == 60
    assert row.predicted_total == 1200 == 50 + row.predicted_duplicates


def test_diagnostics_of_plain_and_agent_lines(spark):
    lines = [line(i, stop="max_tokens" if i == 0 else "stop") for i in range(10)]
    lines.append(
        {
            "index": 10, "model_output": {"choices": [{"stop_reason": "tool_calls"}], "usage": {}},
            "agent_trace": {
                "events": [{"type": "model_generate", "payload": {"stop_reason": "tool_calls"}}, {"type": "tool_result"}, {"type": "model_generate"}],
                "total_usage": {"input": 3, "output": 4, "total": 7, "input_tokens": 1},
            },
        }
    )
    lines += [{"index": 11}, {"index": 12, "model_output": {"choices": [{"stop_reason": ""}], "usage": {"input_tokens": True, "output_tokens": "5"}}}]
    told = diagnostics.run_diagnostics(diagnostics.subset_evidence(facts(spark, lines))).first()
    assert (told.generation_calls, told.truncated_calls, told.content_filter_calls, told.unknown_stop_reason_calls) == (14, 1, 0, 3)
    assert (told.samples_without_stop_reason, told.samples_without_usage) == (2, 1)
    assert (int(told.input_tokens), int(told.output_tokens), int(told.total_tokens)) == (104, 54, 7)
    assert (told.agent_samples, told.agent_steps, told.agent_steps_max, told.agent_steps_mean) == (1, 2, 2, 2.0)


def test_mean_rounds_half_up(value):
    assert value(diagnostics.mean_to_cents(F.lit(8), F.lit(3))) == 2.67
    assert value(diagnostics.mean_to_cents(F.lit(1), F.lit(8))) == 0.13


def write(root, folder, model, name, docs):
    path = root / folder / model
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("".join((d if isinstance(d, str) else json.dumps(d)) + "\n" for d in docs))


def test_attempt_folder_reads_only_the_own_model(spark, tmp_path):
    write(tmp_path, "predictions", "model-a", "set_default.jsonl", [line(0), "", "  ", line(1)])
    write(tmp_path, "predictions", "model-a", "stray.jsonl", [line(2)])
    write(tmp_path, "predictions", "model-b", "set_default.jsonl", [line(5)])
    write(tmp_path, "reviews", "model-a", "set_default.jsonl", [line(0)])
    own = source.scan_attempt_lines(spark, str(tmp_path), "r", "set", "model-a")
    assert sorted((r.kind, r.subset, r.report_id) for r in own.collect()) == [
        ("predicted", "default", "model-a"), ("predicted", "default", "model-a"), ("predicted", "stray", "model-a"), ("reviewed", "default", "model-a")
    ]
    assert source.scan_attempt_lines(spark, str(tmp_path), "r", "set").count() == 5
    assert source.scan_attempt_lines(spark, str(tmp_path), "r", "set", "model-c").count() == 0


def test_partitioned_layout_prunes_by_owner(spark, tmp_path):
    rows = [("predicted", "r1", "a", "s", json.dumps(line(0))), ("predicted", "r1", "b", "s", json.dumps(line(1))), ("reviewed", "r2", "a", "s", json.dumps(line(0)))]
    source.write_partitioned_lines(spark.createDataFrame(rows, "kind string, run_id string, report_id string, subset string, line string"), str(tmp_path / "l"))
    owners = spark.createDataFrame([("r1", "a"), ("r2", "a")], "run_id string, report_id string")
    kept = source.scan_partitioned_lines(spark, str(tmp_path / "l"), owners).collect()
    assert sorted((r.run_id, r.kind) for r in kept) == [("r1", "predicted"), ("r2", "reviewed")]


def test_line_numbers_across_splits(spark, tmp_path):
    """Files of many blocks, with blank lines, against plain reading; every split size gives the same numbers."""
    rng = random.Random(1)
    expected = set()
    for name in ("set_a.jsonl", "set_b.jsonl", "set_empty.jsonl"):
        docs = [] if "empty" in name else [rng.choice(["", "  ", "{cut", json.dumps(line(i)), json.dumps({"x": "y" * rng.randrange(300)})]) for i in range(900)]
        write(tmp_path / "a1", "predictions", "model-a", name, docs)
        for number, text in enumerate(docs, start=1):
            if text.strip() and (text == "{cut" or '"x"' in text):
                expected.add((name[4:-6], number, text))
    owners = spark.createDataFrame([("a1", "r", "set", "model-a")], "attempt string, run_id string, dataset string, report_id string")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700", "4096", "100000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            scanned = attempts.scan_attempt_folders(spark, str(tmp_path), owners, numbered=True)
            told = evidence.malformed_lines(scanned)
            assert scanned.select("block_start").distinct().count() > (10 if size == "700" else 0)
            assert {(r.subset, r.line_no, r.line) for r in told.collect()} == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_paths_of_plain_and_partitioned_attempts(spark, tmp_path):
    plain, parted = tmp_path / "plain", tmp_path / "parted"
    for i in range(3):
        write(plain / f"x{i}", "predictions", f"m{i % 2}", "set_s_1.jsonl", [line(0)])
        write(plain / f"x{i}", "predictions", "foreign", "set_s_1.jsonl", [line(0)])
        folder = parted / f"attempt=x{i}" / "kind=predictions" / f"report_id=m{i % 2}" / "file=set_s_1.jsonl"
        folder.mkdir(parents=True)
        (folder / "part-0.txt").write_text(json.dumps(line(0)) + "\n")
    owners = spark.createDataFrame([(f"x{i}", f"r{i}", "set", f"m{i % 2}") for i in range(3)], "attempt string, run_id string, dataset string, report_id string")
    expected = [(f"r{i}", "predicted", f"m{i % 2}", "s_1") for i in range(3)]
    for root, pattern in ((plain, "*.jsonl"), (parted, "part-*")):
        rows = attempts.scan_attempt_folders(spark, str(root), owners, pattern).collect()
        assert sorted((r.run_id, r.kind, r.report_id, r.subset) for r in rows) == expected
    for i in range(2):
        (plain / f"x{i}" / "reports").mkdir()
        (plain / f"x{i}" / "reports" / "r.json").write_text('{"dataset_name":"set","metrics":[]}')
        (plain / f"x{i}" / "run_manifest.json").write_text(json.dumps({"attempt_id": f"r{i}"}) if i else "{broken")
    assert sorted((r.attempt, r.is_report) for r in attempts.scan_attempt_reports(spark, str(plain)).collect()) == [("x0", True), ("x1", True)]
    told = {r.attempt: r for r in attempts.scan_attempt_manifests(spark, str(plain)).collect()}
    assert (told["x0"].run_id, told["x1"].run_id) == ("x0", "r1") and told["x0"].parse_failure and not told["x1"].parse_failure


def test_an_archive_is_read_like_its_folders(spark, tmp_path):
    """The same attempts as files and as rows of blocks: manifests, reports, lines and line numbers agree, and other files stay out."""
    rng, tree, archive = random.Random(3), tmp_path / "tree", str(tmp_path / "archive")
    for i in range(3):
        for model in (f"m{i}", "foreign"):
            docs = [rng.choice(["", " ", "{cut", json.dumps(line(j))]) for j in range(40)]
            write(tree / f"x{i}", "predictions", model, "set_s_1.jsonl", docs)
        (tree / f"x{i}" / "reports" / "m").mkdir(parents=True)
        (tree / f"x{i}" / "reports" / "m" / "r.json").write_text('{"dataset_name":"set","metrics":[]}' if i else "{broken")
        (tree / f"x{i}" / "run_manifest.json").write_text(json.dumps({"attempt_id": f"r{i}"}) if i else "{broken")
        (tree / f"x{i}" / "notes.txt").write_text("none of these")
    files = []
    for path in sorted(p for p in tree.rglob("*") if p.is_file()):
        text = path.read_text()
        pieces = text.splitlines(keepends=True) if path.suffix == ".jsonl" else [text]
        step = 7 if path.suffix == ".jsonl" else 1
        files += [(str(path.relative_to(tree)), at, "".join(pieces[at : at + step])) for at in range(0, len(pieces), step)]
    attempts.write_archive(spark.createDataFrame(files, "path string, block_start long, value string"), archive)
    owners = spark.createDataFrame([(f"x{i}", f"r{i}", "set", f"m{i}") for i in range(3)], "attempt string, run_id string, dataset string, report_id string")

    def told(root, held):
        manifests = attempts.scan_attempt_manifests(spark, root, archive=held).select("attempt", "run_id", "path", "parse_failure")
        reports = attempts.scan_attempt_reports(spark, root, archive=held).select("attempt", "path", "is_report", "parse_error")
        plain = attempts.scan_attempt_folders(spark, root, owners, archive=held).select("run_id", "kind", "report_id", "subset", "line")
        numbered = evidence.malformed_lines(attempts.scan_attempt_folders(spark, root, owners, numbered=True, archive=held))
        return [sorted(map(repr, f.collect())) for f in (manifests, reports, plain, numbered.select("run_id", "kind", "subset", "line_no", "problem", "line"))]

    assert told(archive, True) == told(str(tree), False)


def test_a_campaign_of_many_attempts_is_few_files(spark, tmp_path):
    """The files of the campaign queries grow with its bytes: no file per attempt or document."""
    lineitem = spark.range(4000).selectExpr("cast(id % 400 as int) as l_suppkey", "id as l_orderkey")
    lineitem.write.parquet(str(tmp_path / "lineitem.parquet"))
    for writer in (campaign_queries.write_manifests, campaign_queries.write_reports, campaign_queries.write_lines):
        writer(spark, str(tmp_path), str(tmp_path / "campaign"))
    written = [p for p in (tmp_path / "campaign").rglob("part-*")]
    assert 0 < len(written) <= 40
    held = spark.read.parquet(str(tmp_path / "campaign")).groupBy("content").agg(F.countDistinct("path").alias("n")).collect()
    assert {r.content: r.n for r in held} == {"manifests": 400, "reports": 1200, "lines": 1200}


def test_blocks_are_cut_at_any_line_end(spark):
    texts = ["", "\n", "\r", "\r\n", "\n\r", "a", "a\n", "a\n\n", "a\r\nb\rc\n\n \nd", "\r\n\r\n", "é\r\r\n\u0085x y\n", "\x01\n\t\x0b\x0c\n!"]
    blocks = spark.createDataFrame(list(enumerate(texts)), "at long, value string")
    told = source.block_lines(blocks, numbered=True).orderBy("at", "seq").collect()
    cut = [re.split(r"\r\n|\r|\n", re.sub(r"(\r\n|\r|\n)\Z", "", t)) for t in texts]
    assert [(r.at, r.seq, r.line) for r in told] == [(at, i, piece) for at, pieces in enumerate(cut) for i, piece in enumerate(pieces)]
    plain = [(r.at, r.line) for r in source.block_lines(blocks).orderBy("at").collect()]
    assert sorted(plain) == sorted((at, piece) for at, pieces in enumerate(cut) for piece in pieces if re.search(r"[^ \t\n\x0b\f\r]", piece))


def test_plain_whole_numbers_are_read_without_a_cast(spark):
    """The short way of ids and token counts gives what the cast gives, or leaves it to the cast."""
    numbers = ["0", "-0", "17", "-17", "5.0", "500.0", "-500.00", "0.0", "5.50", "1e3", "00", "999999999999999", "1234567890123456", "1" * 39]
    values = [*numbers, '"12"', '"a"', '""', "true", "null", "[1]", '{"a":1}']
    frame = spark.createDataFrame([(v,) for v in values], "text string").withColumn("v", F.try_parse_json("text"))
    short, text, tokens = plain_integer(F.col("v")), F.try_variant_get("v", "$", "string"), F.try_variant_get("v", "$", evidence.TOKENS)
    rows = frame.select("text", short.alias("short"), text.alias("cast"), short.try_cast(evidence.TOKENS).alias("tokens"), tokens.alias("as_tokens")).collect()
    assert {r.text for r in rows if r.short is not None} == set(numbers) - {"5.50", "1e3", "00", "1234567890123456", "1" * 39}
    assert all(r.short in (None, r.cast) and r.tokens in (None, r.as_tokens) for r in rows)
    read = facts(spark, [f'{{"sample_id":{v},"model_output":{{"usage":{{"input_tokens":{v}}}}}}}' for v in ("5.0", '"5.0"', "17", "1e3", "true")]).collect()
    assert sorted((r.sample_id, float(r.input_tokens)) for r in read) == [("1000.0", 1000.0), ("17", 17.0), ("5", 5.0), ("5.0", 0.0), ("true", 0.0)]
