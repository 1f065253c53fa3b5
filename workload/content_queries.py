"""Content, manifest and sample-selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from proofmill.operators import content, manifest, ordered
from workload import bindings as b
from workload.registry import query, table

#: Positions of a chunk in the manifest queries: small, so that small data has trees of many chunks.
FANOUT = 4

_Q = """SELECT run_id, subset, sample_id,
  sha256('{"question_text":[' || string_agg(CAST(to_json(text) AS VARCHAR), ',' ORDER BY turn) || ']}') AS question_digest"""


@query(
    "content_parts",
    """
WITH c AS (SELECT CAST(conv_id AS VARCHAR) || '-' || turn AS sample_id, conv_id, turn, role, text FROM conversations)
SELECT sample_id, CAST(0 AS BIGINT) AS turn_no, CAST(0 AS BIGINT) AS part, 'text' AS kind, NULL AS role, text, NULL AS media FROM c WHERE turn % 3 = 0
UNION ALL SELECT sample_id, 0, 0, 'text', role, text, NULL FROM c WHERE turn % 3 = 1
UNION ALL SELECT sample_id, 0, 0, 'text', 'system', 'Be brief.', NULL FROM c WHERE turn % 3 = 2
UNION ALL SELECT sample_id, 1, 0, 'text', role, text, NULL FROM c WHERE turn % 3 = 2
UNION ALL SELECT sample_id, 1, 1, 'media', role, NULL, 'https://img.example/' || conv_id FROM c WHERE turn % 3 = 2
UNION ALL SELECT sample_id, 1, 2, 'media', role, NULL, 'clip-' || conv_id FROM c WHERE turn % 3 = 2
UNION ALL SELECT sample_id, 1, 3, 'text', role, '', NULL FROM c WHERE turn % 3 = 2
""",
)
def content_parts(spark, sf):
    turn, none = F.col("turn"), F.lit(None).cast("string")

    def part(kind, text=none, image=none, url=none, audio=none):
        return F.struct(
            F.lit(kind).alias("type"), text.alias("text"), image.alias("image"), url.alias("url"), none.alias("video"),
            audio.alias("audio"),
        )

    part_type = "array<struct<type:string,text:string,image:string,url:string,video:string,audio:string>>"

    def message(role, text, parts=None):
        return F.struct(role.alias("role"), text.alias("text"), (F.lit(None).cast(part_type) if parts is None else parts).alias("parts"))

    rich = F.array(
        part("text", F.col("text")),
        part("image", image=b.text_of("https://img.example/", F.col("conv_id"))),
        part("audio", url=F.lit(""), audio=b.text_of("clip-", F.col("conv_id"))),
        part("text"),
    )
    nested = table(spark, sf, "conversations").select(
        F.lit("r").alias("run_id"), F.lit("s").alias("subset"), b.text_of(F.col("conv_id"), "-", turn).alias("sample_id"),
        F.when(turn % 3 == 0, F.col("text")).alias("input_text"),
        F.when(turn % 3 == 1, F.array(message(F.col("role"), F.col("text"))))
        .when(turn % 3 == 2, F.array(message(F.lit("system"), F.lit("Be brief.")), message(F.col("role"), none, rich)))
        .alias("messages"),
    )
    return content.content_parts(nested).select("sample_id", F.col("turn").alias("turn_no"), "part", "kind", "role", "text", "media")


@query(
    "media_fingerprint",
    "WITH " + b.PARTS_SQL + "SELECT sample_id, turn, fingerprint, media_ok FROM parts WHERE kind = 'media'",
)
def media_fingerprint(spark, sf):
    media = b.parts(spark, sf).filter(F.col("kind") == "media")
    return content.media_fingerprint(media).select("sample_id", "turn", "fingerprint", "media_ok")


@query("question_digest", "WITH " + b.PARTS_SQL + _Q + " FROM conv GROUP BY ALL", also="question_digest_whole")
def question_digest(spark, sf):
    return content.question_digest(b.raw_parts(spark, sf, "true"))


@query(
    "media_digest",
    "WITH " + b.PARTS_SQL + """
SELECT run_id, subset, sample_id,
  sha256('{"media":[' || coalesce(string_agg('"' || fingerprint || '"', ',' ORDER BY turn) FILTER (WHERE kind = 'media'), '') || ']}') AS media_digest,
  coalesce(bool_and(media_ok) FILTER (WHERE kind = 'media'), true) AS media_evidence
FROM parts GROUP BY run_id, subset, sample_id""",
)
def media_digest(spark, sf):
    return content.media_digest(content.media_fingerprint(b.parts(spark, sf)))


_INPUT = """sha256('{"input_messages":[' || string_agg(
    CASE WHEN kind = 'text' THEN '{"kind":"text","role":"' || role || '","text":' || CAST(to_json(text) AS VARCHAR) || '}'
         ELSE '{"fingerprint":"' || fingerprint || '","kind":"media","role":"' || role || '"}' END,
    ',' ORDER BY turn, part) || ']}')"""


@query("input_digest", "WITH " + b.PARTS_SQL + f"SELECT run_id, subset, sample_id, {_INPUT} AS input_digest FROM parts GROUP BY run_id, subset, sample_id")
def input_digest(spark, sf):
    return content.input_digest(content.media_fingerprint(b.parts(spark, sf)))


_FINGERPRINTS_SQL = b.PARTS_SQL + f""",
seen AS (
  SELECT run_id, subset, sample_id,
    sha256('{{"question_text":[' || string_agg(CAST(to_json(text) AS VARCHAR), ',' ORDER BY turn) FILTER (WHERE kind = 'text') || ']}}') AS q,
    sha256('{{"media":[' || coalesce(string_agg('"' || fingerprint || '"', ',' ORDER BY turn) FILTER (WHERE kind = 'media'), '') || ']}}') AS media_digest,
    {_INPUT} AS input_digest,
    coalesce(bool_and(media_ok) FILTER (WHERE kind = 'media'), true) AS media_evidence
  FROM parts GROUP BY run_id, subset, sample_id),
raw AS ({_Q} FROM raw_parts GROUP BY ALL),
prints AS (
  SELECT s.run_id, s.subset, s.subset_pos, s.pos, s.sample_id, coalesce(raw.question_digest, seen.q) AS question_digest,
         media_digest, input_digest, media_evidence
  FROM samples s JOIN seen USING (run_id, subset, sample_id) LEFT JOIN raw USING (run_id, subset, sample_id)),
nodes AS (
  SELECT run_id, subset, pos // {FANOUT} AS chunk, min(subset_pos) AS subset_pos, count(*) AS selected,
    sha256('[' || string_agg('"' || question_digest || '"', ',' ORDER BY pos) || ']') AS q,
    sha256('[' || string_agg('"' || media_digest || '"', ',' ORDER BY pos) || ']') AS m,
    sha256('[' || string_agg('"' || input_digest || '"', ',' ORDER BY pos) || ']') AS i,
    sha256('[' || string_agg('"' || sample_id || '"', ',' ORDER BY pos) || ']') AS ids,
    bool_and(media_evidence) AS media_evidence
  FROM prints GROUP BY run_id, subset, chunk),
manifest AS (
  SELECT run_id, subset, min(subset_pos) AS subset_pos, sum(selected)::BIGINT AS selected,
    sha256('[' || string_agg('"' || q || '"', ',' ORDER BY chunk) || ']') AS question_digest,
    sha256('[' || string_agg('"' || m || '"', ',' ORDER BY chunk) || ']') AS media_digest,
    sha256('[' || string_agg('"' || i || '"', ',' ORDER BY chunk) || ']') AS input_digest,
    sha256('[' || string_agg('"' || ids || '"', ',' ORDER BY chunk) || ']') AS ids,
    bool_and(media_evidence) AS media_evidence
  FROM nodes GROUP BY run_id, subset)
"""


def fingerprints(spark, sf):
    parts = content.media_fingerprint(b.parts(spark, sf))
    return content.sample_fingerprints(b.samples(spark, sf).drop("conv_id"), parts, b.raw_parts(spark, sf))


_MANIFEST_COLUMNS = ["run_id", "subset", "selected", "question_digest", "media_digest", "input_digest", "media_evidence"]


@query(
    "manifest_rollup",
    "WITH " + _FINGERPRINTS_SQL + f"SELECT {', '.join(_MANIFEST_COLUMNS)}, ids AS sample_ids FROM manifest",
)
def manifest_rollup(spark, sf):
    rolled = manifest.manifest_rollup(fingerprints(spark, sf), FANOUT)
    return rolled.select(*_MANIFEST_COLUMNS, F.col("sample_ids_digest").alias("sample_ids"))


@query(
    "manifest_identity",
    "WITH " + _FINGERPRINTS_SQL + """
SELECT run_id, sha256('[' || string_agg('"' || node || '"', ',' ORDER BY chunk) || ']') AS manifest_digest FROM (
  SELECT run_id, substr(md5(subset), 1, 2) AS chunk, sha256('[' || string_agg('{"input_digest":"' || input_digest || '","media_digest":"' || media_digest ||
    '","media_evidence":' || media_evidence || ',"question_digest":"' || question_digest || '","sample_ids":"' || ids ||
    '","selected":' || selected || ',"subset":"' || subset || '"}', ',' ORDER BY subset_pos, subset) || ']') AS node
  FROM manifest GROUP BY run_id, chunk)
GROUP BY run_id""",
)
def manifest_identity(spark, sf):
    return manifest.manifest_identity(manifest.manifest_rollup(fingerprints(spark, sf), FANOUT))


# Stored details: documents play the samples, their text's hash the digests.
_DETAILS = """
details AS (
  SELECT source AS run_id, lang AS subset, CAST(doc_id AS VARCHAR) AS sample_id, sha256(text) AS d, sha256('m' || doc_id) AS m,
         CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id % 50 <> 1 END AS media_evidence,
         row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) - 1 AS pos
  FROM documents)
"""


@query(
    "manifest_from_details",
    "WITH " + _DETAILS + f"""
SELECT run_id, subset, sum(n)::BIGINT AS selected, sha256('[' || string_agg('"' || d || '"', ',' ORDER BY chunk) || ']') AS question_digest,
       sha256('[' || string_agg('"' || m || '"', ',' ORDER BY chunk) || ']') AS media_digest, bool_and(ok) AS media_evidence
FROM (
  SELECT run_id, subset, pos // {FANOUT} AS chunk, count(*) AS n, sha256('[' || string_agg('"' || d || '"', ',' ORDER BY pos) || ']') AS d,
         sha256('[' || string_agg('"' || m || '"', ',' ORDER BY pos) || ']') AS m, bool_and(coalesce(media_evidence, true)) AS ok
  FROM details GROUP BY run_id, subset, chunk)
GROUP BY run_id, subset""",
)
def manifest_from_details(spark, sf):
    doc = F.col("doc_id")
    stored = table(spark, sf, "documents").select(
        F.col("source").alias("run_id"), F.col("lang").alias("subset"), doc.cast("string").alias("sample_id"), "doc_id",
        F.sha2("text", 256).alias("question_digest"), F.sha2(b.text_of("m", doc), 256).alias("media_digest"),
        F.sha2("text", 256).alias("input_digest"),
        F.when(doc % 3 == 0, F.lit(None)).otherwise(doc % 50 != 1).alias("media_evidence"),
    )
    rows = b.dense_positions(stored, ["run_id", "subset"], "doc_id")
    return manifest.manifest_rollup(rows, FANOUT).select("run_id", "subset", "selected", "question_digest", "media_digest", "media_evidence")


@query(
    "first_n_per_subset",
    "WITH " + _DETAILS + """
SELECT run_id, subset, sample_id, pos FROM details
WHERE CASE CAST(substr(run_id, 4) AS INTEGER) % 3 WHEN 0 THEN true WHEN 1 THEN pos < 5 ELSE pos < 20 END""",
)
def first_n_per_subset(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("run_id"), F.col("lang").alias("subset"), F.col("doc_id").cast("string").alias("sample_id"), "doc_id"
    )
    number = F.substring("run_id", 4, 10).cast("int") % 3
    limits = docs.select("run_id").distinct().withColumn("sample_limit", F.when(number == 1, 5).when(number == 2, 20).cast("bigint"))
    positioned = b.dense_positions(docs, ["run_id", "subset"], "doc_id")
    return manifest.first_n_per_subset(positioned, limits).select("run_id", "subset", "sample_id", "pos")


@query(
    "ranked_positions",
    """
SELECT source AS run_id, lang AS subset, doc_id, substr(md5(doc_id::VARCHAR), 1, 12) AS order_key,
       row_number() OVER (PARTITION BY source, lang ORDER BY substr(md5(doc_id::VARCHAR), 1, 12), doc_id) - 1 AS pos
FROM documents""",
)
def ranked_positions(spark, sf):
    """Positions from random keys: 48-bit hashes as text."""
    key = F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 12)
    docs = table(spark, sf, "documents").select(F.col("source").alias("run_id"), F.col("lang").alias("subset"), "doc_id", key.alias("order_key"))
    return ordered.ranked_positions(docs, ["run_id", "subset"], ["order_key", "doc_id"])
