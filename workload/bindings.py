"""How the driver's tables play the engine's tables, in Spark and in SQL.

Each Spark function has the SQL of the same projection beside it, so queries and
their SQL start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill.operators.ordered import dense_positions
from workload.registry import spread, table


def text_of(*parts) -> Column:
    """Text from columns and literals, cast and joined."""
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


# --- conversations as samples -------------------------------------------------

CONV_SQL = """
conv AS (
  SELECT 'r' || (conv_id % 3) AS run_id, 's' || (conv_id % 4) AS subset, conv_id % 4 AS subset_pos, conv_id,
         CAST(conv_id AS VARCHAR) AS sample_id, turn, role, text
  FROM conversations)
"""


def conv(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    return c.select(
        text_of("r", F.col("conv_id") % 3).alias("run_id"), text_of("s", F.col("conv_id") % 4).alias("subset"),
        (F.col("conv_id") % 4).alias("subset_pos"), "conv_id", F.col("conv_id").cast("string").alias("sample_id"),
        "turn", "role", "text",
    )


SAMPLES_SQL = CONV_SQL + """,
samples AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, subset ORDER BY conv_id) - 1 AS pos
  FROM (SELECT DISTINCT run_id, subset, subset_pos, conv_id, sample_id FROM conv))
"""


def samples(spark: SparkSession, sf: str) -> DataFrame:
    ids = conv(spark, sf).select("run_id", "subset", "subset_pos", "conv_id", "sample_id").distinct()
    return dense_positions(ids, ["run_id", "subset"], "conv_id")


# Every turn is a text part; odd turns also carry a media part of one of four kinds.
PARTS_SQL = SAMPLES_SQL + """,
parts AS (
  SELECT run_id, subset, sample_id, turn, 0 AS part, role, 'text' AS kind, 'Answer: ' || text AS text, NULL AS media,
         CAST(NULL AS VARCHAR) AS fingerprint, CAST(NULL AS BOOLEAN) AS media_ok
  FROM conv
  UNION ALL
  SELECT run_id, subset, sample_id, turn, 1, role, 'media', NULL,
         CASE (conv_id + turn) % 4 WHEN 0 THEN 'data:text/plain;base64,' || base64(encode(text))
              WHEN 1 THEN 'https://img.example/' || conv_id || '/' || turn
              WHEN 2 THEN 'ref-' || conv_id || '-' || turn ELSE 'data:x;base64,abcde' END,
         CASE (conv_id + turn) % 4
              WHEN 0 THEN sha256('{"media_sha256":"' || lower(hex(encode(text))) || '"}')
              WHEN 1 THEN sha256('{"media_url":"https://img.example/' || conv_id || '/' || turn || '"}')
              WHEN 2 THEN sha256('{"media_ref":"ref-' || conv_id || '-' || turn || '"}')
              ELSE sha256('{"media":"data:x;base64,abcde"}') END,
         (conv_id + turn) % 4 = 0
  FROM conv WHERE turn % 2 = 1),
raw_parts AS (SELECT run_id, subset, sample_id, turn, text FROM conv WHERE conv_id % 5 <> 0)
"""


def parts(spark: SparkSession, sf: str) -> DataFrame:
    """Processed parts: one scan, the media part comes from exploding each turn."""
    n = (F.col("conv_id") + F.col("turn")) % 4
    media = (
        F.when(n == 0, F.concat(F.lit("data:text/plain;base64,"), F.base64(F.encode("text", "UTF-8"))))
        .when(n == 1, text_of("https://img.example/", F.col("conv_id"), "/", F.col("turn")))
        .when(n == 2, text_of("ref-", F.col("conv_id"), "-", F.col("turn")))
        .otherwise(F.lit("data:x;base64,abcde"))
    )
    none = F.lit(None).cast("string")

    def part(number: int, kind: str, text: Column, ref: Column) -> Column:
        return F.struct(
            F.lit(number).cast("bigint").alias("part"), F.lit(kind).alias("kind"), text.alias("text"), ref.alias("media")
        )

    made = F.array_compact(
        F.array(
            part(0, "text", F.concat(F.lit("Answer: "), "text"), none),
            F.when(F.col("turn") % 2 == 1, part(1, "media", none, media)),
        )
    )
    return conv(spark, sf).select("run_id", "subset", "sample_id", "turn", "role", F.inline(made))


def raw_parts(spark: SparkSession, sf: str, which: str = "conv_id % 5 <> 0") -> DataFrame:
    return conv(spark, sf).filter(which).select(
        "run_id", "subset", "sample_id", "turn", F.lit(0).cast("bigint").alias("part"), "role",
        F.lit("text").alias("kind"), "text",
    )


# --- events as evidence lines ---------------------------------------------------

EVENTS_SQL = """
e0 AS (
  SELECT event_id AS i, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
ev AS (
  SELECT i, 'u' || user_id AS run_id, 's' || (i % 3) AS subset,
         CASE WHEN i % 4 = 3 THEN 'reviewed' ELSE 'predicted' END AS kind, 'part-' || (i % 2) AS source,
         CASE WHEN i % 89 = 0 THEN 'not a JSON object' WHEN i % 7 = 1 THEN 'no sample id' END AS problem,
         CASE WHEN i % 89 <> 0 AND i % 7 <> 1 THEN CAST(i % 97 AS VARCHAR) END AS sample_id,
         CASE WHEN i % 89 <> 0 AND i % 5 IN (0, 1, 4) THEN k % 3 ELSE 0 END AS repeat,
         i % 8 = 0 AS traced,
         CASE event_type WHEN 'view' THEN 'stop' WHEN 'click' THEN 'max_tokens' WHEN 'purchase' THEN 'tool_calls'
              WHEN 'signup' THEN 'content_filter' ELSE 'unknown' END AS reason,
         cents, k,
         CASE WHEN i % 8 = 0 AND i % 16 = 0 THEN 3 WHEN i % 13 = 0 THEN 0 WHEN i % 13 = 2 THEN 2 ELSE 1 END AS usage_kind,
         CASE WHEN i % 4 = 0 THEN 'swebench/img' || (k % 10) WHEN i % 4 = 1 THEN 'other/img' || k END AS image
  FROM e0),
facts AS (
  SELECT run_id, subset, kind, source, problem, sample_id, repeat, image,
         CASE WHEN traced THEN reason WHEN i % 6 = 5 THEN 'unknown' ELSE reason END AS r1,
         CASE WHEN traced THEN CASE WHEN k % 2 = 0 THEN 'max_tokens' ELSE 'unknown' END END AS r2,
         CASE WHEN traced THEN 2 ELSE 0 END AS steps,
         usage_kind > 0 AS has_usage,
         CASE usage_kind WHEN 1 THEN cents WHEN 3 THEN 1000 ELSE 0 END AS input_tokens,
         CASE usage_kind WHEN 1 THEN k WHEN 3 THEN k ELSE 0 END AS output_tokens,
         CASE usage_kind WHEN 1 THEN cents + k ELSE 0 END AS total_tokens
  FROM ev),
predicted AS (SELECT * FROM facts WHERE kind = 'predicted' AND problem IS NULL)
"""


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines written from the events, with every form an id, repeat or usage may take."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = spread(table(spark, sf, "events"), "event_id").select(
        F.col("event_id").alias("i"), "user_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        k.alias("k"),
    )
    i, cents, k = F.col("i"), F.col("cents"), F.col("k")
    sid, rep = i % 97, k % 3
    identity = (
        F.when(i % 7 == 0, text_of('"index":', sid))
        .when(i % 7 == 1, text_of('"sample_id":null,"index":', sid))
        .when(i % 7 == 2, text_of('"sample_id":null,"sample_score":{"sample_id":"', sid, '"}'))
        .when(i % 7 == 3, text_of('"sample_id":"', sid, '"'))
        .otherwise(text_of('"sample_id":', sid))
    )
    repeat = (
        F.when(i % 5 == 0, text_of(',"repeat_id":', rep))
        .when(i % 5 == 1, text_of(',"repeat":"', rep, '"'))
        .when(i % 5 == 2, F.lit(',"repeat_id":"x"'))
        .when(i % 5 == 3, F.lit(""))
        .otherwise(text_of(',"repeat_id":', rep, ".5"))
    )
    reason = (
        F.when(F.col("event_type") == "view", F.lit("stop")).when(F.col("event_type") == "click", F.lit("max_tokens"))
        .when(F.col("event_type") == "purchase", F.lit("tool_calls")).when(F.col("event_type") == "signup", F.lit("content_filter"))
    )
    stop = F.when(reason.isNull(), F.lit("{}")).otherwise(text_of('{"stop_reason":"', reason, '"}'))
    choices = F.when(i % 6 == 5, F.lit("[]")).otherwise(text_of("[", stop, "]"))
    usage = (
        F.when(i % 13 == 0, F.lit("{}"))
        .when(i % 13 == 1, text_of('{"input":', cents, ',"output":', k, ',"total":', cents + k, "}"))
        .when(i % 13 == 2, F.lit('{"input_tokens":"12","output_tokens":true}'))
        .otherwise(text_of('{"input_tokens":', cents, ',"output_tokens":', k, ',"total_tokens":', cents + k, "}"))
    )
    second = F.when(k % 2 == 0, F.lit('{"type":"model_generate","payload":{"stop_reason":"max_tokens"}}')).otherwise(
        F.lit('{"type":"model_generate"}')
    )
    traced_usage = F.when(i % 16 == 0, text_of('{"input_tokens":1000,"output_tokens":', k, "}")).otherwise(F.lit("{}"))
    trace = F.when(
        i % 8 == 0,
        text_of(
            ',"agent_trace":{"events":[{"type":"model_generate","payload":', stop, '},{"type":"tool_result"},', second,
            '],"total_usage":', traced_usage, "}",
        ),
    ).otherwise(F.lit(""))
    image = (
        F.when(i % 4 == 0, text_of(',"metadata":{"docker_image":"swebench/img', k % 10, '"}'))
        .when(i % 4 == 1, text_of(',"metadata":{"docker_image":"other/img', k, '"}'))
        .otherwise(F.lit(""))
    )
    line = F.when(i % 89 == 0, text_of("{broken ", i)).otherwise(
        text_of("{", identity, repeat, ',"model_output":{"choices":', choices, ',"usage":', usage, "}", trace, image, "}")
    )
    return e.select(
        text_of("u", F.col("user_id")).alias("run_id"), text_of("s", i % 3).alias("subset"),
        F.when(i % 4 == 3, F.lit("reviewed")).otherwise(F.lit("predicted")).alias("kind"),
        text_of("part-", i % 2).alias("source"), line.alias("line"), i.alias("event_id"),
    )


# --- documents and labels as coverage -------------------------------------------

# Each source is a run; "clean-<source>" is the same run with perfect evidence.
COVERAGE_SQL = """
docs AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, source, lang, n_chars FROM documents),
cov_samples AS (
  SELECT source AS run_id, lang AS subset, id AS sample_id FROM docs
  UNION ALL SELECT 'clean-' || source, lang, id FROM docs),
cov_ev AS (
  SELECT source AS run_id, lang AS subset, 'predicted' AS kind, id AS sample_id, 0 AS repeat, NULL AS problem FROM docs WHERE n_chars > 500
  UNION ALL SELECT source, lang, 'predicted', id, 1, NULL FROM docs WHERE n_chars > 500 AND doc_id % 3 = 0
  UNION ALL SELECT source, lang, 'predicted', id, 0, NULL FROM docs WHERE n_chars > 500 AND doc_id % 11 = 0
  UNION ALL SELECT source, lang, 'predicted', 'x' || id, 0, NULL FROM docs WHERE doc_id % 17 = 0
  UNION ALL SELECT source, lang || '_extra', 'predicted', id, 0, NULL FROM docs WHERE doc_id % 23 = 0
  UNION ALL SELECT source, lang, 'predicted', NULL, 0, 'no sample id' FROM docs WHERE doc_id % 29 = 0
  UNION ALL SELECT 'clean-' || source, lang, 'predicted', id, 0, NULL FROM docs
  UNION ALL SELECT 'clean-' || source, lang, 'reviewed', id, 0, NULL FROM docs
  UNION ALL SELECT source, lang, 'reviewed', id, 0, NULL FROM docs JOIN labels USING (doc_id)
  UNION ALL SELECT source, lang, 'reviewed', id, 1, NULL FROM docs JOIN labels USING (doc_id) WHERE doc_id % 3 = 0 AND quality = 1
  UNION ALL SELECT source, lang, 'reviewed', 'y' || id, 0, NULL FROM docs JOIN labels USING (doc_id) WHERE doc_id % 19 = 0),
usable AS (SELECT * FROM cov_ev WHERE problem IS NULL),
keys AS (
  SELECT run_id, subset, sample_id, repeat,
         count(*) FILTER (WHERE kind = 'predicted') AS np, count(*) FILTER (WHERE kind = 'reviewed') AS nr
  FROM usable GROUP BY ALL),
bases AS (SELECT DISTINCT run_id, subset, sample_id FROM usable WHERE kind = 'predicted'),
cov_manifest AS (
  SELECT run_id, subset, count(*) AS selected,
         CAST(CASE subset WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END AS BIGINT) AS subset_pos,
         CASE WHEN run_id <> 'src3' THEN sha256(subset) END AS question_digest, sha256('i' || subset) AS input_digest,
         run_id <> 'src5' AS media_evidence
  FROM cov_samples GROUP BY run_id, subset)
"""


def coverage_samples(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select(
        F.explode(F.array("source", F.concat(F.lit("clean-"), "source"))).alias("run_id"), F.col("lang").alias("subset"),
        F.col("doc_id").cast("string").alias("sample_id"),
    )


def _evidence_rows(rows: list[Column]) -> Column:
    return F.inline(F.array_compact(F.array(*rows)))


def _evidence_row(condition: Column | None, run: Column, subset: Column, kind: str, sample: Column, repeat: int, problem: str | None = None) -> Column:
    row = F.struct(
        run.alias("run_id"), subset.alias("subset"), F.lit(kind).alias("kind"), sample.alias("sample_id"),
        F.lit(repeat).cast("bigint").alias("repeat"), F.lit(problem).cast("string").alias("problem"),
    )
    return row if condition is None else F.when(condition, row)


def coverage_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Prediction and review rows; documents are read once and exploded into their rows."""
    doc = F.col("doc_id")
    sid, run, lang = doc.cast("string"), F.col("source"), F.col("lang")
    clean = F.concat(F.lit("clean-"), run)
    long = F.col("n_chars") > 500
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    predicted = docs.select(
        _evidence_rows(
            [
                _evidence_row(long, run, lang, "predicted", sid, 0),
                _evidence_row(long & (doc % 3 == 0), run, lang, "predicted", sid, 1),
                _evidence_row(long & (doc % 11 == 0), run, lang, "predicted", sid, 0),
                _evidence_row(doc % 17 == 0, run, lang, "predicted", F.concat(F.lit("x"), sid), 0),
                _evidence_row(doc % 23 == 0, run, F.concat(lang, F.lit("_extra")), "predicted", sid, 0),
                _evidence_row(doc % 29 == 0, run, lang, "predicted", F.lit(None).cast("string"), 0, "no sample id"),
                _evidence_row(None, clean, lang, "predicted", sid, 0),
                _evidence_row(None, clean, lang, "reviewed", sid, 0),
            ]
        )
    )
    reviewed = docs.join(table(spark, sf, "labels"), "doc_id").select(
        _evidence_rows(
            [
                _evidence_row(None, run, lang, "reviewed", sid, 0),
                _evidence_row((doc % 3 == 0) & (F.col("quality") == 1), run, lang, "reviewed", sid, 1),
                _evidence_row(doc % 19 == 0, run, lang, "reviewed", F.concat(F.lit("y"), sid), 0),
            ]
        )
    )
    return predicted.unionByName(reviewed).withColumn("source", F.col("subset"))


def coverage_manifest(spark: SparkSession, sf: str) -> DataFrame:
    subset = F.col("subset")
    return coverage_samples(spark, sf).groupBy("run_id", "subset").agg(F.count(F.lit(1)).alias("selected")).select(
        "run_id", "subset", "selected",
        F.when(subset == "de", 0).when(subset == "en", 1).when(subset == "es", 2).otherwise(3).cast("bigint").alias("subset_pos"),
        F.when(F.col("run_id") != "src3", F.sha2("subset", 256)).alias("question_digest"),
        F.sha2(F.concat(F.lit("i"), subset), 256).alias("input_digest"),
        (F.col("run_id") != "src5").alias("media_evidence"),
    )


# --- orders and lineitem as runs and metrics --------------------------------------

RUNS_SQL = """
runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderkey AS n, 'g' || (o_custkey % 50) AS run_group, 'm' || (o_custkey % 20) AS model_alias,
         CASE WHEN o_custkey % 7 <> 0 THEN 'configuration-' || (o_custkey % 40) END AS model_config_identity,
         o_orderpriority AS dataset,
         CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'smoke' ELSE 'lite' END AS profile,
         'completed' AS execution_status,
         CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'complete' WHEN o_orderstatus = 'O' THEN 'partial'
              ELSE 'unverified' END AS validity_status,
         CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'unknown' ELSE 'verified' END AS comparability,
         CASE WHEN o_orderkey % 31 <> 0 THEN 'protocol-' || (o_custkey % 3) END AS protocol_identity,
         'manifest-' || (o_orderkey % 6) AS sample_manifest_identity,
         o_orderdate AS finished_at, o_orderdate - INTERVAL 1 DAY AS started_at,
         'reason|' || o_orderkey || chr(10) || repeat('x', CAST(o_orderkey % 200 AS INTEGER)) AS status_reason
  FROM orders),
metrics AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS run_id, l_linenumber AS line, 'metric-' || l_linenumber AS metric_name,
         min(l_discount) AS score, CAST(min(l_quantity) AS BIGINT) AS num,
         CASE l_linenumber % 3 WHEN 1 THEN 'percent' END AS display_kind, CASE WHEN l_linenumber % 3 = 2 THEN 'pts' END AS unit
  FROM lineitem GROUP BY l_orderkey, l_linenumber)
"""


def runs(spark: SparkSession, sf: str) -> DataFrame:
    key, cust, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        key.cast("string").alias("run_id"), text_of("g", cust % 50).alias("run_group"), text_of("m", cust % 20).alias("model_alias"),
        F.when(cust % 7 != 0, text_of("configuration-", cust % 40)).alias("model_config_identity"),
        F.col("o_orderpriority").alias("dataset"),
        F.when(key % 41 == 0, F.lit(None)).when(key % 5 == 0, F.lit("smoke")).otherwise(F.lit("lite")).alias("profile"),
        F.lit("completed").alias("execution_status"),
        F.when(key % 37 == 0, F.lit(None)).when(status == "F", F.lit("complete")).when(status == "O", F.lit("partial"))
        .otherwise(F.lit("unverified")).alias("validity_status"),
        F.when(key % 43 == 0, F.lit(None)).when(key % 4 == 0, F.lit("unknown")).otherwise(F.lit("verified")).alias("comparability"),
        F.when(key % 31 != 0, text_of("protocol-", cust % 3)).alias("protocol_identity"),
        text_of("manifest-", key % 6).alias("sample_manifest_identity"),
        F.col("o_orderdate").alias("finished_at"),
        (F.col("o_orderdate") - F.expr("INTERVAL 1 DAY")).alias("started_at"),
        F.concat(text_of("reason|", key, "\n"), F.repeat(F.lit("x"), (key % 200).cast("int"))).alias("status_reason"),
        F.lit("1.0").alias("harness_version"),
    )


def metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    from proofmill.functions.identity import TOP_CATEGORY_KEY

    line = F.col("l_linenumber")
    grouped = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_discount").alias("score"), F.min("l_quantity").cast("bigint").alias("num")
    )
    return grouped.select(
        F.col("l_orderkey").cast("string").alias("run_id"), text_of("metric-", line).alias("metric_name"),
        text_of("key-", line).alias("metric_key"), F.lit("mean").alias("aggregation"), F.lit("{}").alias("dimensions_json"),
        "score", F.col("score").alias("macro_score"), "num",
        F.when(line % 3 == 1, F.lit("percent")).alias("display_kind"), F.when(line % 3 == 2, F.lit("pts")).alias("unit"),
        F.lit("higher_is_better").alias("direction"), (line == 1).alias("is_primary"),
        F.lit(TOP_CATEGORY_KEY).alias("category_key"), F.lit("").alias("subset"),
    )


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)
