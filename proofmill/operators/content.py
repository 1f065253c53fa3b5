"""Content parts of samples and their fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill.functions.canonical import digest, json_hex, json_object, json_text
from proofmill.functions.scalars import decodable_base64
from proofmill.operators.ordered import Digest, Rollup, plain_digests
from proofmill.sources import files

SAMPLE = ["run_id", "subset", "sample_id"]


def content_parts(samples: DataFrame) -> DataFrame:
    """Long form of nested sample input: one row per text or media part, in order.

    ``samples``: run_id, subset, sample_id, input_text (plain string input) and
    messages array<struct<role, text, parts array<struct<type, text, image, url,
    video, audio>>>>. A plain input is one text part without a role; a message
    with plain content is one text part with its role.
    """
    part_type = "array<struct<type:string,text:string,image:string,url:string,video:string,audio:string>>"
    plain_part = F.struct(
        F.lit("text").alias("type"), F.col("message.text").alias("text"),
        *[F.lit(None).cast("string").alias(n) for n in ("image", "url", "video", "audio")],
    )
    plain_message = F.struct(
        F.lit(None).cast("string").alias("role"), F.col("input_text").alias("text"),
        F.lit(None).cast(part_type).alias("parts"),
    )
    messages = F.when(F.col("input_text").isNotNull(), F.array(plain_message)).otherwise(F.col("messages"))
    turns = samples.select(*SAMPLE, F.posexplode(messages).alias("turn", "message"))
    parts = turns.select(
        *SAMPLE,
        F.col("turn").cast("bigint").alias("turn"),
        F.col("message.role").alias("role"),
        F.posexplode(
            F.when(F.col("message.text").isNotNull(), F.array(plain_part)).otherwise(F.col("message.parts"))
        ).alias("part", "content"),
    )
    is_text = F.coalesce(F.col("content.type") == "text", F.lit(False))

    def given(name: str) -> Column:
        return F.nullif(F.col(f"content.{name}"), F.lit(""))

    return parts.select(
        *SAMPLE, "turn", F.col("part").cast("bigint").alias("part"), "role",
        F.when(is_text, F.lit("text")).otherwise(F.lit("media")).alias("kind"),
        F.when(is_text, F.coalesce("content.text", F.lit(""))).alias("text"),
        F.when(~is_text, F.coalesce("content.image", given("url"), given("video"), given("audio"))).alias("media"),
    )


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """SHA-256 per file of a folder, of any size, keyed by path."""
    return files.file_digests(spark, folder).select("path", F.col("sha256").alias("file_sha256"))


def media_fingerprint(parts: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Add ``fingerprint`` and ``media_ok`` (content was seen, not just named) to media parts.

    ``files`` (path, file_sha256) proves references to files; without it every
    reference stays unproven. Data that does not decode is hashed whole, so different broken media stay
    apart. Payloads are fingerprinted in their rows; with files, data and URL parts do not take part in the join.
    """
    media = F.col("media")
    is_data = media.startswith("data:")
    is_url = media.startswith("http://") | media.startswith("https://")
    payload = F.when(F.instr(media, ",") > 0, F.regexp_replace(media, r"^[^,]*,", "")).otherwise(F.lit(""))
    well_formed, cleaned = decodable_base64(payload)
    content = digest(json_object(media_sha256=json_hex(F.lower(F.hex(F.unbase64(cleaned))))))

    def named(key: str, value: Column) -> Column:
        return digest(json_object(**{key: json_text(value)}))

    is_media = F.col("kind") == "media"
    fingerprint = (
        F.when(~is_media | media.isNull(), F.lit(None).cast("string"))
        .when(is_data & well_formed, content)
        .when(is_data, named("media", media))
        .when(is_url, named("media_url", media))
        .otherwise(named("media_ref", media))
    )
    evidence = F.when(is_media, media.isNotNull() & F.coalesce(is_data & well_formed, F.lit(False)))
    done = parts.select(*parts.columns, fingerprint.alias("fingerprint"), evidence.alias("media_ok"))
    if files is None:
        return done
    named_file = F.coalesce(is_media & ~is_data & ~is_url, F.lit(False))
    proofs = files.select(F.col("path").alias("media"), F.col("file_sha256").alias("__file"))
    proven = done.filter(named_file).join(proofs, "media", "left").withColumns(
        {"fingerprint": F.coalesce("__file", "fingerprint"), "media_ok": F.col("__file").isNotNull()}
    )
    return done.filter(~named_file).unionByName(proven.select(*done.columns))


def question_digest(parts: DataFrame) -> DataFrame:
    """Per sample: digest of the ordered text parts."""
    element = F.when(F.col("kind") == "text", json_text(F.col("text")))
    return plain_digests(
        parts, SAMPLE, ["turn", "part"],
        {"question_digest": Digest(element, '{"question_text":', "}")},
    )


def _media_spec() -> Digest:
    return Digest(F.when(F.col("kind") == "media", json_hex(F.col("fingerprint"))), '{"media":', "}")


def _input_spec() -> Digest:
    role = json_text(F.col("role"))
    as_text = json_object(kind=F.lit('"text"'), role=role, text=json_text(F.col("text")))
    as_media = json_object(fingerprint=json_hex(F.col("fingerprint")), kind=F.lit('"media"'), role=role)
    return Digest(F.when(F.col("kind") == "text", as_text).otherwise(as_media), '{"input_messages":', "}")


def _evidence_rollup() -> Rollup:
    return Rollup(
        F.coalesce(F.bool_and(F.when(F.col("kind") == "media", F.col("media_ok"))), F.lit(True)),
        lambda name: F.bool_and(name),
    )


def media_digest(fingerprinted: DataFrame) -> DataFrame:
    """Per sample: digest of the ordered media fingerprints and whether all are proven."""
    return plain_digests(
        fingerprinted, SAMPLE, ["turn", "part"], {"media_digest": _media_spec()},
        {"media_evidence": _evidence_rollup()},
    )


def input_digest(fingerprinted: DataFrame) -> DataFrame:
    """Per sample: digest of the ordered messages as the model gets them."""
    return plain_digests(fingerprinted, SAMPLE, ["turn", "part"], {"input_digest": _input_spec()})


def sample_fingerprints(samples: DataFrame, processed: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Samples with all three digests, from one pass over the processed parts.

    ``processed`` carries fingerprints (``media_fingerprint``). The question
    digest comes from the raw parts where the sample has any.
    """
    text = F.when(F.col("kind") == "text", json_text(F.col("text")))
    seen = plain_digests(
        processed, SAMPLE, ["turn", "part"],
        {
            "question_seen": Digest(text, '{"question_text":', "}"),
            "media_digest": _media_spec(),
            "input_digest": _input_spec(),
        },
        {"media_evidence": _evidence_rollup()},
    )
    joined = samples.join(seen, SAMPLE, "left")
    if raw is None:
        question = F.col("question_seen")
    else:
        joined = joined.join(question_digest(raw).withColumnRenamed("question_digest", "question_raw"), SAMPLE, "left")
        question = F.coalesce("question_raw", "question_seen")

    def empty(prefix: str) -> Column:
        return digest(F.lit(prefix + "[]}"))

    return joined.select(
        *samples.columns,
        F.coalesce(question, empty('{"question_text":')).alias("question_digest"),
        F.coalesce("media_digest", empty('{"media":')).alias("media_digest"),
        F.coalesce("input_digest", empty('{"input_messages":')).alias("input_digest"),
        F.coalesce("media_evidence", F.lit(True)).alias("media_evidence"),
    )
