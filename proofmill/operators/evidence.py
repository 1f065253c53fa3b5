"""Evidence lines: keys, generation calls, token usage, malformed lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmill.functions.scalars import plain_integer, repeat_number
from proofmill.schemas import EVIDENCE_LINE
from proofmill.sources.lines import line_numbers

TOKENS = "decimal(28,6)"
_USAGE = {
    "input_tokens": ("input_tokens", "input"),
    "output_tokens": ("output_tokens", "output"),
    "total_tokens": ("total_tokens", "total"),
}


def _known(reason: Column) -> Column:
    return F.coalesce(F.nullif(reason, F.lit("")), F.lit("unknown"))


def _has_members(usage: Column) -> Column:
    return F.coalesce(F.size(usage) > 0, F.lit(False))


def _token_sum(usage: Column, names: tuple[str, ...]) -> Column:
    """Sum of the given members; text, booleans and missing members count nothing."""
    total = F.lit(0).cast(TOKENS)
    for name in names:
        value = usage[name]
        numeric = F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
        given = F.coalesce(plain_integer(value).try_cast(TOKENS), F.when(numeric, F.try_variant_get(value, "$", TOKENS)))
        total = total + F.coalesce(given, F.lit(0).cast(TOKENS))
    return total.cast(TOKENS)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``doc`` (typed line) and ``is_object``.

    The line is read as the member of an outer object, so text after the document
    makes it invalid. Going through ``inline`` keeps Spark from parsing once per
    member used. A document that only fails for the type of a member is checked
    again as a whole: it still counts as an object.
    """
    wrapped = F.concat(F.lit('{"doc":'), F.col("line"), F.lit("}"))
    parsed = F.from_json(
        wrapped, f"doc {EVIDENCE_LINE}, damaged string",
        {"columnNameOfCorruptRecord": "damaged", "allowSingleQuotes": "false"},
    )
    rows = lines.select("*", F.inline(F.array(parsed)))
    whole = F.try_variant_get(F.try_parse_json(F.concat(F.lit('{"doc":'), F.col("line"), F.lit("}"))), "$.doc", "variant")
    reread = F.coalesce(F.schema_of_variant(whole).startswith("OBJECT"), F.lit(False))
    sound = F.col("damaged").isNull() & F.col("doc").isNotNull()
    return rows.withColumn("is_object", F.when(sound, F.lit(True)).otherwise(reread)).drop("damaged")


def evidence_key(lines: DataFrame) -> DataFrame:
    """Parse each line and find its key.

    ``sample_id`` counts when the member is present, even as null; only without
    it is ``index`` used; a null result falls back to ``sample_score.sample_id``.
    Adds doc, sample_id, repeat and ``problem`` (NULL for a usable line).
    """
    plain = F.coalesce("doc.sample_id", "doc.index")
    repeat = F.coalesce("doc.repeat_id", "doc.repeat")
    sample_id = F.coalesce(plain_integer(plain), F.try_variant_get(plain, "$", "string"), "doc.sample_score.sample_id")
    is_object = F.col("is_object")
    # the id is worked out in a step of its own, since the problem asks for it again
    told = parse_lines(lines).select(*lines.columns, "doc", "is_object", F.when(is_object, sample_id).alias("sample_id"))
    return told.select(
        *lines.columns,
        "doc",
        "sample_id",
        F.when(is_object, repeat_number(repeat)).otherwise(F.lit(0)).alias("repeat"),
        F.when(~is_object, F.lit("not a JSON object"))
        .when(F.col("sample_id").isNull(), F.lit("no sample id"))
        .alias("problem"),
    )


def generation_columns() -> dict[str, Column]:
    """Stop reasons, step count and usage members of a prediction document ``doc``."""
    choices = F.transform("doc.model_output.choices", lambda c: _known(c["stop_reason"]))
    generated = F.filter("doc.agent_trace.events", lambda e: F.coalesce(e["type"] == "model_generate", F.lit(False)))
    traced = F.transform(generated, lambda e: _known(e["payload"]["stop_reason"]))
    steps = F.coalesce(F.nullif(F.size(generated), F.lit(-1)), F.lit(0))
    reasons = (
        F.when(steps > 0, traced).when(F.size("doc.model_output.choices") > 0, choices).otherwise(F.array(F.lit("unknown")))
    )
    trace_usage, own_usage = F.col("doc.agent_trace.total_usage"), F.col("doc.model_output.usage")
    usage = F.when((steps > 0) & _has_members(trace_usage), trace_usage).otherwise(own_usage)
    return {"reasons": reasons, "steps": steps.cast("bigint"), "usage": usage}


def typed_evidence(lines: DataFrame) -> DataFrame:
    """The evidence fact table: one typed row per line, all later operators start here."""
    made = generation_columns()
    predicted = (F.col("kind") == "predicted") & F.col("problem").isNull()
    keyed = evidence_key(lines).withColumn("usage", F.when(predicted, made["usage"]))
    return keyed.select(
        "run_id", "kind", "subset", "source", "sample_id", "repeat", "problem",
        F.when(predicted, made["reasons"]).alias("stop_reasons"),
        F.when(predicted, made["steps"]).alias("steps"),
        F.when(predicted, _has_members(F.col("usage"))).alias("has_usage"),
        *[F.when(predicted, _token_sum(F.col("usage"), names)).alias(out) for out, names in _USAGE.items()],
        F.col("doc.metadata.docker_image").alias("docker_image"),
    )


def generation_calls(evidence: DataFrame) -> DataFrame:
    """One row per generation call of each prediction line."""
    return evidence.filter((F.col("kind") == "predicted") & F.col("problem").isNull()).select(
        "run_id", "subset", "sample_id", "repeat", "steps",
        F.posexplode("stop_reasons").alias("call", "stop_reason"),
    )


def malformed_lines(lines: DataFrame) -> DataFrame:
    """Every unusable line, whole: the quarantine table with file, place, problem and the line's text.

    Lines of a scan with ``numbered`` also get ``line_no``, their exact number in the file.
    """
    if "seq" not in lines.columns:
        place = F.col("block_start") if "block_start" in lines.columns else F.lit(None).cast("bigint").alias("block_start")
        return evidence_key(lines).filter(F.col("problem").isNotNull()).select("run_id", "kind", "subset", "source", place, "problem", "line")
    bad = F.col("problem").isNotNull() & F.col("line").rlike(r"\S")
    told = line_numbers(evidence_key(lines), bad, ["run_id", "kind", "subset", "problem", "line"])
    return told.select("run_id", "kind", "subset", "source", "block_start", "line_no", "problem", "line")


def malformed_summary(evidence: DataFrame) -> DataFrame:
    """Unusable lines per run, counted by problem; from the fact table or the quarantine table."""
    return evidence.filter(F.col("problem").isNotNull()).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("malformed_lines"),
        F.count_if(F.col("problem") == "no sample id").alias("without_sample_id"),
        F.count_if(F.col("problem") != "no sample id").alias("unparsable"),
    )
