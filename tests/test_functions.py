import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from proofmill.functions import canonical, identity, redaction, scalars


def compact(doc):
    return json.dumps(doc, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def sha(doc):
    return hashlib.sha256(compact(doc).encode()).hexdigest()


def one(frame, column):
    return [r["x"] for r in frame.select(column.alias("x")).collect()]


def test_json_text_equals_canonical_json(spark):
    texts = ["", 'q"\\b', "é中😀/", "a\nb\tc\r\b\f", "\x01\x0b\x1f", "\\u001f literal \x1f", "\x7f", "plain", "{}", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert one(frame, canonical.json_text(F.col("t"))) == [compact(t) for t in texts]


def test_canonical_variant_at_any_depth(spark):
    doc = {"b": [1, {"z": None, "a": "x\u001fy \\u001F \\\u000b\u000b"}], "a": {"k": 2.5, "t": True}, "c": [], "d": {}, "e\u000e": "\u001a"}
    for _ in range(30):
        doc = {"deep": [doc, "\u001b"]}
    frame = spark.createDataFrame([(json.dumps(doc),), (None,)], "t string")
    assert one(frame, canonical.canonical_variant(F.try_parse_json("t"))) == [compact(doc), None]


def test_top_category_key_is_digest_of_empty_path(value):
    assert value(canonical.digest(F.lit("[]"))) == identity.TOP_CATEGORY_KEY == sha([])


def test_metric_key_keeps_name_aggregation_and_dimensions_apart(spark):
    frame = spark.createDataFrame(
        [("acc", "mean", "{}"), ("acc", "pass_at_k", '{"k":5}'), ("acc", "pass_at_k", '{"k":3}'), (None, None, None)],
        "n string, a string, d string",
    )
    keys = one(frame, identity.metric_key(F.col("n"), F.col("a"), F.col("d")))
    assert keys == [
        sha({"name": "acc", "aggregation": "mean", "dimensions": {}}),
        sha({"name": "acc", "aggregation": "pass_at_k", "dimensions": {"k": 5}}),
        sha({"name": "acc", "aggregation": "pass_at_k", "dimensions": {"k": 3}}),
        sha({"name": None, "aggregation": None, "dimensions": {}}),
    ]


def test_clean_identity_treats_blank_as_unknown_and_keeps_values(spark):
    frame = spark.createDataFrame([("",), ("  \t\n",), ("\u00a0",), (None,), (" a ",)], "v string")
    assert one(frame, identity.clean_identity(F.col("v"))) == [None, None, None, None, " a "]


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://user:pw@Host.Example:8443/v1/?k=1#f", "https://host.example:8443/v1"),
        ("http://h/v1/", "http://h/v1"),
        ("HTTPS://H:0/x", "https://h/x"),
        ("", "https:"),
        (None, "https:"),
        ("h/v1", "https:h/v1"),
    ],
)
def test_endpoint_identity(value, url, expected):
    assert value(identity.endpoint_identity(F.lit(url).cast("string"))) == expected


def test_model_config_identity(value):
    got = value(identity.model_config_identity(F.lit("a"), F.lit(None).cast("string"), F.lit("https://h/v1?x=1"), F.lit(None).cast("string")))
    assert got == sha({"alias": "a", "model_id": "", "endpoint": "https://h/v1", "deployment_version": "unknown"})


def test_protocol_identity_ignores_model_storage_and_sampling(spark):
    base = {"seed": 42, "dataset_args": {"d": {"k": [1, 2], "local_path": "/a"}}, "generation_config": {"t": 0.5}}
    moved = {**base, "model": "m", "limit": 5, "work_dir": "/w", "api_key": "k", "dataset_args": {"d": {"local_path": "/b", "k": [1, 2]}}}
    changed = {**base, "generation_config": {"t": 0.7}}
    frame = spark.createDataFrame([(json.dumps(d),) for d in (base, moved, changed)], "c string")
    a, b, c = one(frame, identity.protocol_identity(F.col("c")))
    assert a == b != c
    assert a == sha({"seed": 42, "dataset_args": {"d": {"k": [1, 2]}}, "generation_config": {"t": 0.5}})


@pytest.mark.parametrize(
    "raw, score, problem",
    [
        (None, None, None), ("0", 0.0, None), ("0.5", 0.5, None), (" 1e3 ", 1000.0, None), (".5", 0.5, None), ("1_0", 10.0, None),
        ("true", None, "boolean is not a score"), ("NaN", None, "non-finite score"), ("-inf", None, "non-finite score"),
        ("1e999", None, "non-finite score"), ("secret-text", None, "non-numeric score"), ("0.5d", None, "non-numeric score"),
    ],
)
def test_score_reading(spark, raw, score, problem):
    row = spark.createDataFrame([(raw,)], "r string").select(
        scalars.score_value(F.col("r")).alias("s"), scalars.score_problem(F.col("r")).alias("p")
    ).first()
    assert (row["s"], row["p"]) == (score, problem)


def test_base64_follows_the_lenient_decoder(spark):
    payloads = ["aGk=", "aGk", "aG k=", "aGk=zz", "aG==", "a", "", "====", "aGkh", "aGkh=", "a*Gkh!"]
    frame = spark.createDataFrame([(p,) for p in payloads], "p string")
    ok, cleaned = scalars.decodable_base64(F.col("p"))
    got = [r["x"] for r in frame.select(F.when(ok, F.unbase64(cleaned)).alias("x")).collect()]

    def lenient(text):
        try:
            return base64.b64decode(text)
        except ValueError:
            return None

    assert [None if g is None else bytes(g) for g in got] == [lenient(p) for p in payloads]


def test_redact_text_masks_each_kind_of_secret(value):
    token = ".".join(["eyJabcdefgh1", "abcdefgh1", "abcdefgh1"])
    text = f"go https://u:p@h/x then sk-abcdefgh12, KEY1, {token} and ftp2://a@b"
    assert value(redaction.redact_text(F.lit(text), F.array(F.lit("KEY1")))) == "go https://***@h/x then ***, ***, *** and ftp2://***@b"
    assert value(redaction.redact_text(F.lit(None).cast("string"))) == ""
    assert value(redaction.redact_text(F.lit("sk-ab max_tokens=5 mail a@b"))) == "sk-ab max_tokens=5 mail a@b"


def test_url_masking_equals_the_plain_pattern(spark):
    import re

    plain = re.compile(r"([a-zA-Z][a-zA-Z0-9+.-]*://)[^/@\s]+@")
    texts = ["1http://u@h", "x://y:p+http://z@", "http://a@http://b@c", "é://u@h", "a.b-c+d://u:p@h://q@", "://u@h", "9://u@h", "http://u p@h", "http://@h"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert one(frame, redaction.mask_url_credentials(F.col("t"))) == [plain.sub(r"\1***@", t) for t in texts]


def test_secret_keys_are_exact_names_or_known_endings(spark):
    names = ["API-Key", "my token", " Password ", "x_secret", "max_tokens", "input_tokens", "tokenizer", "authorization"]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    assert one(frame, redaction.is_secret_key(F.col("n"))) == [True, True, True, True, False, False, False, True]


def test_numbers_of_identities_count_as_written(spark):
    import hashlib
    import json

    settings = [
        {"seed": 42, "temperature": 5.0, "top_p": 5, "big": 10**25, "tiny": 1e-30, "neg": -0.5, "zero": 0, "list": [1, 1.0, "1.0", {"a": -7.25}]},
        {"note": 'a "quoted 5.0" \\ 3 \\\\"', "empty": "", "5": "5", "n": None, "t": True, "u": "中 5.0", "esc": "\u0001\u001f"}, {}, {"x" * 20_000: "7" * 20_000, "y": 1.5},
    ]
    frame = spark.createDataFrame([(i, json.dumps(s), json.dumps(s, indent=3)) for i, s in enumerate(settings)], "i long, c string, d string")
    rows = frame.select("i", identity.protocol_identity(F.col("c")).alias("c"), identity.protocol_identity(F.col("d")).alias("d")).collect()
    for r in rows:
        text = json.dumps(settings[r.i], sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert r.c == r.d == hashlib.sha256(text.encode()).hexdigest(), settings[r.i]
    broken = spark.createDataFrame([("{cut",), ('{"a":01}',), ('{"a":5.}',), (None,)], "c string")
    assert len({r.x for r in broken.select(identity.protocol_identity(F.col("c")).alias("x")).collect()}) == 1
