"""Plans, identities, pinned data, redaction, image ownership and edit distance."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmill.functions import identity
from proofmill.operators import images, pinned, planning, redact, text_distance
from proofmill.session import work_path
from workload import bindings as b
from workload.evidence_queries import facts
from workload.registry import query, spread, table

# --- plan -----------------------------------------------------------------------

_PLAN_SQL = """
brands AS (
  SELECT p_brand AS dataset, CAST(substr(p_brand, 7) AS BIGINT) AS no, min(p_size) AS size FROM part GROUP BY p_brand),
plan AS (
  SELECT n_name AS model_alias, r_name AS suite, dataset, no, r_regionkey,
    CASE WHEN no % 7 = 0 THEN 1 WHEN no % 4 = 0 THEN NULL ELSE no * 10 END AS sample_limit,
    coalesce(CASE WHEN no % 5 = 1 THEN 2 END, CASE WHEN r_regionkey % 2 = 1 THEN 1 END, 4) AS batch_size,
    coalesce(CASE WHEN no % 6 = 0 THEN 'own' END, 'policy-' || r_name) AS sandbox, no % 7 = 0 AS pinned
  FROM brands JOIN region ON r_regionkey = no % 5 JOIN nation ON n_regionkey = r_regionkey
  WHERE no % 3 <> 0)
"""


def plan(spark, sf):
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    no = F.substring("p_brand", 7, 10).cast("bigint")
    brands = table(spark, sf, "part").groupBy("p_brand").agg(F.min("p_size").alias("size")).withColumn("no", no)
    datasets = brands.join(region, F.col("r_regionkey") == F.col("no") % 5).select(
        F.col("r_name").alias("suite"), F.col("p_brand").alias("dataset"), F.col("no").alias("dataset_pos"),
        (F.col("no") % 3 != 0).alias("core"), (F.col("no") % 7 == 0).alias("pinned"),
        F.when(F.col("no") % 4 != 0, F.col("no") * 10).alias("full_limit"), F.when(F.col("no") % 5 == 1, 2).alias("batch_size"),
        F.when(F.col("no") % 6 == 0, F.lit("own")).alias("sandbox"),
    )
    suites = region.select(
        F.col("r_name").alias("suite"), F.col("r_regionkey").alias("suite_pos"), F.when(F.col("r_regionkey") % 2 == 1, 1).alias("batch_size"),
        F.concat(F.lit("policy-"), "r_name").alias("sandbox"),
    )
    selection = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("model_alias"), F.col("n_nationkey").alias("model_pos"), F.col("r_name").alias("suite")
    )
    return planning.expand_plan(selection.unionByName(selection), suites, datasets, profile="full", profile_limit=20)


@query(
    "expand_plan",
    "WITH " + _PLAN_SQL + "SELECT model_alias, suite, dataset, sample_limit, CAST(batch_size AS BIGINT) AS batch_size, sandbox, pinned FROM plan",
)
def expand_plan(spark, sf):
    return plan(spark, sf).select("model_alias", "suite", "dataset", "sample_limit", "batch_size", "sandbox", "pinned")


@query(
    "plan_coverage",
    "WITH " + _PLAN_SQL + """,
seen AS (
  SELECT n_name AS model_alias, 'Brand#' || (o_orderkey % 25) AS dataset, count(*) AS attempts,
         count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderkey % 10 <> 3) AS good
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)
SELECT model_alias, suite, dataset, coalesce(attempts, 0) AS attempts, coalesce(good, 0) AS acceptable_runs, coalesce(good, 0) > 0 AS covered
FROM plan LEFT JOIN seen USING (model_alias, dataset)""",
)
def plan_coverage(spark, sf):
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    runs = orders.join(customer, F.col("c_custkey") == F.col("o_custkey")).join(nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("n_name").alias("model_alias"), b.text_of("Brand#", F.col("o_orderkey") % 25).alias("dataset"),
        F.when(F.col("o_orderkey") % 10 == 3, F.lit("failed")).otherwise(F.lit("completed")).alias("execution_status"),
        F.when(F.col("o_orderstatus") == "F", F.lit("complete")).otherwise(F.lit("partial")).alias("validity_status"),
    )
    return planning.plan_coverage(plan(spark, sf), runs)


@query(
    "model_config_identity",
    """
WITH p AS (SELECT page_id, rtrim(regexp_replace(url, '[?#].*$', ''), '/') AS base FROM pages),
e AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN regexp_replace(base, '^(https?://[^/]+)', '\\1:8443') ELSE base END AS endpoint FROM p)
SELECT page_id, endpoint, sha256('{"alias":"a' || (page_id % 9) || '","deployment_version":"' || CASE WHEN page_id % 2 = 0 THEN 'unknown' ELSE 'v' || page_id END ||
  '","endpoint":"' || endpoint || '","model_id":"' || CASE WHEN page_id % 5 = 0 THEN '' ELSE 'm' || page_id END || '"}') AS model_config_identity
FROM e""",
)
def model_config_identity(spark, sf):
    page = F.col("page_id")
    shouted = F.regexp_replace("url", "^(https?://[^/]*)example", "$1EXAMPLE")
    ported = F.when(page % 3 == 0, F.regexp_replace(shouted, "^(https?://[^/?#]+)", "$1:8443")).otherwise(shouted)
    url = F.regexp_replace(ported, "://", "://user:pass@")
    return table(spark, sf, "pages").select(
        "page_id", identity.endpoint_identity(url).alias("endpoint"),
        identity.model_config_identity(
            b.text_of("a", page % 9), F.when(page % 5 != 0, b.text_of("m", page)), url, F.when(page % 2 != 0, b.text_of("v", page))
        ).alias("model_config_identity"),
    )


@query(
    "protocol_identity",
    """
SELECT event_id, sha256('{"dataset_args":{"d":{"shots":' || json_extract_string(props, '$.k') || '}},"generation_config":{"stop":["a","' || event_type ||
  '"],"temperature":0.5,"top_k":' || user_id || '.0,"top_p":1.0},"seed":42}') AS protocol_identity FROM events""",
)
def protocol_identity(spark, sf):
    k = F.get_json_object("props", "$.k")
    config = b.text_of(
        '{"model":"m', F.col("user_id"), '","seed":42,"limit":', k, ',"dataset_args":{"d":{"local_path":"/p/', F.col("event_id"),
        '","shots":', k, '}},"generation_config":{"top_p":1.0,"temperature":0.5,"top_k":', F.col("user_id"), '.0,"stop":["a","', F.col("event_type"), '"]},"api_key":"x"}',
    )
    return table(spark, sf, "events").select("event_id", identity.protocol_identity(config).alias("protocol_identity"))


# --- pinned data ----------------------------------------------------------------

_WANTED = "wanted AS (SELECT DISTINCT l_partkey AS p_partkey FROM lineitem WHERE l_quantity < 3)"


def _wanted(spark, sf, quantity=3):
    return table(spark, sf, "lineitem").filter(F.col("l_quantity") < quantity).select(F.col("l_partkey").alias("p_partkey")).distinct()


@query("pin_extract", f"WITH {_WANTED} SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_partkey IN (SELECT p_partkey FROM wanted)")
def pin_extract(spark, sf):
    root = work_path(spark, "pinned")
    pinned.pin_extract(spark, table(spark, sf, "part"), _wanted(spark, sf), "p_partkey", root)
    return pinned.read_pinned(spark, root).select("p_partkey", "p_name", "p_retailprice")


@query(
    "pin_verify",
    f"""
WITH {_WANTED}, fewer AS (SELECT DISTINCT l_partkey AS p_partkey FROM lineitem WHERE l_quantity < 2),
n AS (SELECT (SELECT count(*) FROM wanted) AS w, (SELECT count(*) FROM fewer) AS f, (SELECT count(*) FROM wanted WHERE p_partkey NOT IN (SELECT p_partkey FROM fewer)) AS d)
SELECT 'same' AS check_name, true AS ok, w AS rows, w AS wanted, 'content verified' AS reason FROM n
UNION ALL SELECT 'fewer', false, w, f, 'provenance ids differ from the wanted ids: ' || d FROM n""",
)
def pin_verify(spark, sf):
    root = work_path(spark, "pinned")
    pinned.pin_extract(spark, table(spark, sf, "part"), _wanted(spark, sf), "p_partkey", root)

    def checked(name, quantity):
        verdict = pinned.pin_verify(spark, root, _wanted(spark, sf, quantity), "p_partkey")
        return verdict.select(F.lit(name).alias("check_name"), "ok", "rows", "wanted", "reason")

    return checked("same", 3).unionByName(checked("fewer", 2))


# --- redaction ------------------------------------------------------------------

_URL = "([a-zA-Z][a-zA-Z0-9+.-]*://)[^/@\\s]+@"
_KEY = "sk-[A-Za-z0-9][A-Za-z0-9._-]{6,}"
_TOKEN = "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"
_SECRET_TEXT = """text || ' see https://user:' || doc_id || '@host.example/x, sk-' || md5(text) || ' or eyJ' || md5(lang) || '.' || md5(source) || '.' || md5(text)"""


def _secret_text():
    return b.text_of(
        F.col("text"), " see https://user:", F.col("doc_id"), "@host.example/x, sk-", F.md5("text"), " or eyJ", F.md5("lang"), ".",
        F.md5("source"), ".", F.md5("text"),
    )


@query(
    "redact_text",
    f"""
WITH t AS (SELECT doc_id, {_SECRET_TEXT} AS text FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '{_URL}', '\\1***@', 'g'), '{_KEY}', '***', 'g'), '{_TOKEN}', '***', 'g') AS text,
  len(regexp_extract_all(text, '{_URL}')) AS url_hits, len(regexp_extract_all(text, '{_KEY}')) AS key_hits, len(regexp_extract_all(text, '{_TOKEN}')) AS token_hits
FROM t""",
)
def redact_text(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    texts = docs.select("doc_id", _secret_text().alias("text"))
    masked = redact.redact_column(texts, "text")
    return masked.withColumns({c: F.col(c).cast("bigint") for c in ("url_hits", "key_hits", "token_hits")})


@query(
    "redact_known",
    """
SELECT doc_id, source AS run_id, replace(replace(text || ' with key-' || source || ', tail-' || source || ' and EMPTY, ', 'key-' || source, '***'), 'tail-' || source, '***')
  || '***<***' AS text
FROM documents""",
)
def redact_known(spark, sf):
    """A list of a thousand secrets a run beside those of its configuration; the texts name one of them plainly and one with an earlier secret inside."""
    docs = table(spark, sf, "documents")
    source = F.col("source")
    runs = docs.select(source.alias("run_id")).distinct()
    configs = runs.withColumn(
        "config_json", b.text_of('{"api_key":"key-', F.col("run_id"), '","token":"EMPTY","secret":"tail-', F.col("run_id"), '","password":"***"}')
    )
    more = F.transform(F.sequence(F.lit(0), F.lit(999)), lambda i: F.concat(F.lit("<"), F.col("run_id"), F.lit("#"), i.cast("string"), F.lit(">")))
    listed = redact.collect_secrets(configs).select("run_id", F.concat("secrets", more).alias("secrets"))
    number = F.col("doc_id") % 1000
    texts = docs.select(
        "doc_id", source.alias("run_id"),
        b.text_of(
            F.col("text"), " with key-", source, ", tail-", source, " and EMPTY, ", "<", source, "#", number, ">", "<<", source, "#", 999 - number, ">",
        ).alias("text"),
    )
    return redact.redact_known(texts, listed, "text")


@query(
    "redact_by_key",
    """
SELECT event_id, '{"api_key":"***","max_tokens":' || json_extract_string(props, '$.k') || ',"nested":{"My-Token":"***","input_tokens":' || user_id ||
  ',"list":[{"password":"***","x":null},"https://***@h/' || event_id || '",1.5,true]},"note":"use *** now","z":"' || event_type || '"}' AS config_json
FROM events""",
)
def redact_by_key(spark, sf):
    config = b.text_of(
        '{"z":"', F.col("event_type"), '", "api_key": "secret', F.col("event_id"), '", "max_tokens": ', F.get_json_object("props", "$.k"),
        ', "note":"use sk-abcdefgh', F.col("event_id"), ' now", "nested":{"list":[{"x":null,"password":{"deep":1}},"https://u:p@h/', F.col("event_id"),
        '",1.5,true],"input_tokens":', F.col("user_id"), ',"My-Token":[1,2]}}',
    )
    return redact.redact_by_key(table(spark, sf, "events").select("event_id", config.alias("config_json")), "config_json")


# --- image ownership --------------------------------------------------------------

_REFS = b.EVENTS_SQL + """,
refs AS (SELECT DISTINCT run_id, image FROM facts WHERE image LIKE 'swebench/%' AND coalesce(problem, '') <> 'not a JSON object')
"""


@query("referenced_images", "WITH " + _REFS + "SELECT run_id, image FROM refs")
def referenced_images(spark, sf):
    return images.referenced_images(facts(spark, sf))


@query(
    "ownership_candidates",
    "WITH " + _REFS + """,
attempts AS (
  SELECT DISTINCT 'u' || user_id AS run_id, user_id AS pos, user_id % 3 <> 0 AS has_baseline,
         CASE WHEN user_id % 5 <> 0 THEN '2024-01-' || lpad(CAST(user_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00+00:00' END AS attempt_start
  FROM events),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY image ORDER BY NOT has_baseline, CASE WHEN has_baseline THEN coalesce(attempt_start, '~') ELSE '' END, pos) AS rn
  FROM refs JOIN attempts USING (run_id))
SELECT image, run_id, attempt_start, has_baseline FROM ranked WHERE rn = 1""",
)
def ownership_candidates(spark, sf):
    user = F.col("user_id")
    start = b.text_of("2024-01-", F.lpad((user % 28 + 1).cast("string"), 2, "0"), "T00:00:00+00:00")
    attempts = table(spark, sf, "events").select("user_id").distinct().select(
        b.text_of("u", user).alias("run_id"), user.alias("run_pos"), F.when(user % 5 != 0, start).alias("attempt_start"),
        (user % 3 != 0).alias("has_baseline"),
    )
    return images.ownership_candidates(images.referenced_images(facts(spark, sf)), attempts).select(
        "image", "run_id", "attempt_start", "has_baseline"
    )


@query(
    "ownership_classify",
    """
WITH c AS (
  SELECT c_custkey AS k, 'swebench/c' || c_custkey AS image, 'u' || c_nationkey AS run_id,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey % 5 <> 0 END AS has_baseline, c_custkey % 28 + 1 AS made, c_custkey % 9 + 10 AS started FROM customer)
SELECT image, run_id, CASE WHEN k % 7 = 0 THEN 'absent' WHEN k % 11 = 0 THEN 'in_use' WHEN k % 13 = 0 THEN 'unproven'
    WHEN has_baseline AND k % 19 = 0 THEN 'unproven' WHEN NOT has_baseline THEN 'unproven' WHEN k % 23 <> 0 AND made >= started THEN 'owned' ELSE 'unproven' END AS class,
  CASE WHEN k % 7 = 0 OR k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 'inspect failed: no such image' WHEN has_baseline AND k % 19 = 0 THEN 'present in the pre-run image inventory'
    WHEN NOT has_baseline THEN 'no pre-run image inventory was recorded' WHEN k % 23 <> 0 AND made >= started THEN NULL
    ELSE 'created=' || CASE WHEN k % 23 = 0 THEN 'unknown' ELSE '2024-01-' || lpad(CAST(made AS VARCHAR), 2, '0') || 'T10:00:00.123456789Z' END ||
         ' attempt_start=2024-01-' || lpad(CAST(started AS VARCHAR), 2, '0') || 'T12:00:00+02:00' END AS reason
FROM c""",
)
def ownership_classify(spark, sf):
    k = F.col("c_custkey")
    two = lambda col: F.lpad(col.cast("string"), 2, "0")
    base = table(spark, sf, "customer").select("c_custkey", b.text_of("swebench/c", k).alias("image"), b.text_of("u", F.col("c_nationkey")).alias("run_id"))
    candidates = base.select(
        "image", "run_id", b.text_of("2024-01-", two(k % 9 + 10), "T12:00:00+02:00").alias("attempt_start"),
        F.when(k % 17 != 0, k % 5 != 0).alias("has_baseline"),
    )
    created = base.select(
        "image", F.when(k % 23 == 0, F.lit("")).otherwise(b.text_of("2024-01-", two(k % 28 + 1), "T10:00:00.123456789Z")).alias("created_at"),
        F.when(k % 13 == 0, F.lit("no such image")).alias("inspect_error"),
    )
    return images.ownership_classify(
        candidates, base.filter(k % 7 != 0), base.filter(k % 11 == 0), created, base.filter(k % 19 == 0).select("run_id", "image")
    )


# --- edit distance ----------------------------------------------------------------


# SQL's distance counts bytes. Each letter beyond ASCII in the tables stands for one control character there, one to one, so
# distances are those of the texts; any other letter would make the two sides differ and be noticed.
_LETTERS = "ÄÖÜäöüßÇÈÉÊçèéêÍÑÓíñó"
_CODES = [c for c in range(1, 32) if c not in (9, 10, 13)]


def _recoded(text: str) -> str:
    return f"translate({text}, '{_LETTERS}', " + " || ".join(f"chr({c})" for c in _CODES[: len(_LETTERS)]) + ")"


@query(
    "edit_distance_scores",
    f"""
WITH d AS (SELECT doc_id, {_recoded("text")} AS text, doc_id % (SELECT count(*) FROM benchmark) AS item_id FROM documents),
r AS (SELECT item_id, {_recoded("text")} AS text FROM benchmark)
SELECT doc_id, levenshtein(d.text, r.text) AS distance, greatest(length(d.text), length(r.text)) AS longest FROM d JOIN r USING (item_id)""",
)
def edit_distance_scores(spark, sf):
    references = table(spark, sf, "benchmark")
    items = references.agg(F.count(F.lit(1)).alias("items"))
    placed = table(spark, sf, "documents").select("doc_id", F.col("text").alias("prediction")).withColumn(
        "item_id", F.col("doc_id") % items.scalar()
    )
    scored = text_distance.edit_distance_scores(placed, references.select("item_id", F.col("text").alias("reference")), "item_id")
    return scored.select("doc_id", F.col("distance").cast("bigint").alias("distance"), F.col("longest").cast("bigint").alias("longest"))
