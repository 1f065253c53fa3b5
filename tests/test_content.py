import base64
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from proofmill.operators import content, manifest
from proofmill.operators.ordered import Digest, Rollup, dense_positions, first_per_group, plain_digests, tree_digests


def sha_text(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sha(doc):
    return sha_text(json.dumps(doc, sort_keys=True, separators=(",", ":"), ensure_ascii=False))


MESSAGE = "array<struct<role:string,text:string,parts:array<struct<type:string,text:string,image:string,url:string,video:string,audio:string>>>>"
SAMPLES = f"run_id string, subset string, sample_id string, input_text string, messages {MESSAGE}"


def part(kind, **values):
    return {"type": kind, **{k: values.get(k) for k in ("text", "image", "url", "video", "audio")}}


def sample(sample_id, text=None, messages=None):
    return ("r", "default", sample_id, text, messages)


def fingerprints(spark, processed, raw=None, files=None):
    frame = spark.createDataFrame(processed, SAMPLES)
    ids = frame.select("run_id", "subset", "sample_id", F.col("sample_id").cast("bigint").alias("pos"))
    raw_parts = None if raw is None else content.content_parts(spark.createDataFrame(raw, SAMPLES))
    return content.sample_fingerprints(ids, content.media_fingerprint(content.content_parts(frame), files), raw_parts)


def test_parts_keep_order_and_role(spark):
    messages = [
        {"role": "system", "text": "s", "parts": None},
        {"role": "user", "text": None, "parts": [part("text", text="a"), part("image", image="i.png"), part("audio", url="", audio="c"), part("text")]},
    ]
    rows = content.content_parts(spark.createDataFrame([sample("0", messages=messages), sample("1", "plain")], SAMPLES)).orderBy("sample_id", "turn", "part").collect()
    assert [(r.turn, r.part, r.role, r.kind, r.text, r.media) for r in rows] == [
        (0, 0, "system", "text", "s", None), (1, 0, "user", "text", "a", None), (1, 1, "user", "media", None, "i.png"),
        (1, 2, "user", "media", None, "c"), (1, 3, "user", "text", "", None), (0, 0, None, "text", "plain", None),
    ]


def test_template_changes_input_but_not_question(spark):
    raw = [sample("0", "What is 2+2?"), sample("1", "What is 3+3?")]

    def rows(prefix):
        done = fingerprints(spark, [sample(i, f"{prefix}\n{t}") for _, _, i, t, _ in raw], raw)
        return {r.sample_id: r for r in done.collect()}

    first, second = rows("Answer."), rows("Reply.")
    assert first["0"].question_digest == second["0"].question_digest == sha({"question_text": ["What is 2+2?"]})
    assert first["0"].input_digest != second["0"].input_digest
    assert first["0"].input_digest == sha({"input_messages": [{"role": None, "kind": "text", "text": "Answer.\nWhat is 2+2?"}]})
    assert first["0"].media_digest == sha({"media": []}) and first["0"].media_evidence


def test_media_evidence_needs_content(spark, tmp_path):
    proof = tmp_path / "pic.png"
    proof.write_bytes(b"pixels")
    data = "data:image/png;base64," + base64.b64encode(b"image-a").decode()
    bad = "data:image/png;base64,abcde"
    refs = {"0": data, "1": "https://example.com/a.png", "2": f"file:{proof}", "3": "nowhere.png", "4": bad, "5": None}
    rows = [sample(k, messages=[{"role": "user", "text": None, "parts": [part("image", image=v)]}]) for k, v in refs.items()]
    done = {r.sample_id: r for r in fingerprints(spark, rows, files=content.file_digests(spark, str(tmp_path))).collect()}
    expected = {
        "0": (sha({"media_sha256": b"image-a".hex()}), True), "1": (sha({"media_url": refs["1"]}), False),
        "2": (hashlib.sha256(b"pixels").hexdigest(), True), "3": (sha({"media_ref": "nowhere.png"}), False),
        "4": (sha({"media": bad}), False), "5": (None, False),
    }
    for key, (print_, evidence) in expected.items():
        assert done[key].media_digest == sha({"media": [print_]}), key
        assert done[key].media_evidence is evidence
        assert done[key].input_digest == sha({"input_messages": [{"role": "user", "kind": "media", "fingerprint": print_}]})


def test_manifest_row_and_identity_match_hashing_in_python(spark):
    texts = {"0": "q0", "1": "q1", "2": "é\n"}
    rows = [sample(k, v) for k, v in texts.items()]
    prints = fingerprints(spark, rows)
    rolled = manifest.manifest_rollup(prints)
    row = rolled.first()
    question = [sha({"question_text": [t]}) for t in texts.values()]
    inputs = [sha({"input_messages": [{"role": None, "kind": "text", "text": t}]}) for t in texts.values()]
    media = [sha({"media": []})] * 3
    def quoted(texts):
        return [f'"{t}"' for t in texts]

    expected = {
        "subset": "default", "selected": 3, "sample_ids_digest": tree(quoted("012"), 8192), "question_digest": tree(quoted(question), 8192),
        "media_digest": tree(quoted(media), 8192), "input_digest": tree(quoted(inputs), 8192), "media_evidence": True,
    }
    assert {k: row[k] for k in expected} == expected
    told = {("sample_ids" if k == "sample_ids_digest" else k): v for k, v in expected.items()}
    node = sha_text("[" + json.dumps(told, sort_keys=True, separators=(",", ":")) + "]")
    assert manifest.manifest_identity(rolled).first().manifest_digest == sha_text(f'["{node}"]')


def tree(elements, fanout, prefix="", suffix=""):
    """Brute force: every chunk of positions is a node, the nodes give the root, at any size."""
    nodes = [sha_text("[" + ",".join(elements[i : i + fanout]) + "]") for i in range(0, len(elements), fanout)]
    return sha_text(prefix + "[" + ",".join(f'"{n}"' for n in nodes) + "]" + suffix)


@pytest.mark.parametrize("size", [1, 4, 5, 17, 70])
def test_one_digest_rule_at_every_size_and_partitioning(spark, size):
    rows = [("hot", i, f"e{i}") for i in range(size)] + [("small", 0, "x")]
    random.Random(size).shuffle(rows)
    spec = {"d": Digest(F.concat(F.lit('"'), "e", F.lit('"')), '{"k":', "}")}
    counted = {"n": Rollup(F.count(F.lit(1)), F.sum)}
    for parts in (3,) if size < 70 else (1, 3):
        frame = spark.createDataFrame(rows, "g string, pos bigint, e string").repartition(parts)
        done = {r.g: r for r in tree_digests(frame, ["g"], F.floor(F.col("pos") / 4), ["pos"], spec, counted).collect()}
        assert done["hot"].d == tree([f'"e{i}"' for i in range(size)], 4, '{"k":', "}") and done["hot"].n == size
        assert done["small"].d == tree(['"x"'], 4, '{"k":', "}")
        plain = {r.g: r for r in plain_digests(frame, ["g"], ["pos"], spec, counted).collect()}
        assert plain["hot"].d == sha_text('{"k":[' + ",".join(f'"e{i}"' for i in range(size)) + "]}") and plain["hot"].n == size


def test_elements_that_are_null_are_left_out(spark):
    frame = spark.createDataFrame([("g", 0, '"a"'), ("g", 1, None), ("g", 2, '"b"')], "g string, pos bigint, e string")
    assert plain_digests(frame, ["g"], ["pos"], {"d": Digest(F.col("e"))}).first().d == sha(["a", "b"])


def test_dense_positions_equal_a_plain_rank(spark):
    rng = random.Random(3)
    rows = [("hot", v) for v in rng.sample(range(5000), 400)] + [("b", v) for v in rng.sample(range(50), 7)]
    frame = spark.createDataFrame(rows, "g string, v bigint")
    got = {(r.g, r.v): r.pos for r in dense_positions(frame, ["g"], "v", width=64).collect()}
    for name in ("hot", "b"):
        for rank, v in enumerate(sorted(v for g, v in rows if g == name)):
            assert got[name, v] == rank


def test_first_per_group_and_first_n(spark):
    frame = spark.createDataFrame([("a", i, f"s{i}", i) for i in range(9)] + [("b", i, f"t{i}", i) for i in range(3)], "run_id string, v int, sample_id string, pos bigint")
    assert first_per_group(frame, ["run_id"], ["v"], 2).count() == 4
    limits = spark.createDataFrame([("a", 5), ("b", None)], "run_id string, sample_limit bigint")
    kept = manifest.first_n_per_subset(frame, limits).groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in kept} == {"a": 5, "b": 3}
