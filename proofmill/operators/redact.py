"""Redaction jobs over text columns and stored configurations."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proofmill.functions.canonical import json_text, let
from proofmill.functions.redaction import (
    API_KEY_PATTERN,
    MASK,
    SECRET_CONFIG_KEYS,
    SIGNED_TOKEN_PATTERN,
    URL_CREDENTIALS_PATTERN,
    is_real_secret,
    mask_json,
    redact_text,
)
from proofmill.session import ship_code


def redact_column(df: DataFrame, column: str) -> DataFrame:
    """Mask secrets in a text column and count what each pattern found in the original."""
    text = F.coalesce(F.col(column), F.lit(""))

    def hits(guard: str, pattern: str) -> Column:
        return F.when(text.contains(guard), F.regexp_count(text, F.lit(pattern))).otherwise(0)

    return df.withColumns(
        {
            "url_hits": hits("://", URL_CREDENTIALS_PATTERN),
            "key_hits": hits("sk-", API_KEY_PATTERN),
            "token_hits": hits("eyJ", SIGNED_TOKEN_PATTERN),
            column: redact_text(F.col(column)),
        }
    )


def collect_secrets(configs: DataFrame) -> DataFrame:
    """(run_id, secrets) from the ``config_json`` of each run: real values of the secret members."""
    config = F.try_parse_json("config_json")
    values = [F.try_variant_get(config, f"$.{name}", "variant") for name in SECRET_CONFIG_KEYS]
    texts = [
        F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")) for v in values
    ]
    return configs.select(
        "run_id", F.filter(F.array(*texts), lambda s: F.coalesce(is_real_secret(s) & (s != ""), F.lit(False))).alias("secrets")
    )


#: A run with more than one in so many texts is spread over several tasks.
SHARE = 1000


class KnownSecrets:
    """Masks a list of secrets in one pass over a text, as replacing them one after the other would."""

    def __init__(self, secrets: list[str]) -> None:
        self.order = [s for s in dict.fromkeys(secrets) if s]
        # A secret with the mask's character could match what an earlier one left behind; only such lists go one by one.
        self.one_by_one = any("*" in s for s in self.order)
        self.search = None
        if self.order and not self.one_by_one:
            self.search = ahocorasick.Automaton()
            for rank, secret in enumerate(self.order):
                self.search.add_word(secret, (rank, len(secret)))
            self.search.make_automaton()

    def mask(self, text: str) -> str:
        if self.one_by_one:
            for secret in self.order:
                text = text.replace(secret, MASK)
            return text
        found = [] if self.search is None else [(rank, end + 1 - size, end + 1) for end, (rank, size) in self.search.iter(text)]
        if not found:
            return text
        # The first secret of the list takes its matches from left to right, then the next one what is still whole.
        taken: list[tuple[int, int]] = []
        for _, start, end in sorted(found):
            at = bisect.bisect(taken, (start, end))
            if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end):
                taken.insert(at, (start, end))
        parts, last = [], 0
        for start, end in taken:
            parts.append(text[last:start])
            last = end
        return MASK.join([*parts, text[last:]])


def _spread(texts: DataFrame) -> Column:
    """Number of tasks that a run's texts go to: more than one for the runs with more than one in ``SHARE`` texts, of which there are fewer than that."""
    counts = texts.groupBy("run_id").count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.where(F.col("count") * SHARE > total).collect() if total > SHARE else []
    pairs = [F.lit(x) for r in hot if r["run_id"] is not None for x in (r["run_id"], -(-SHARE * r["count"] // total))]
    if not pairs:
        return F.lit(1)
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("run_id")).cast("int"), F.lit(1))


def redact_known(df: DataFrame, secrets: DataFrame, column: str) -> DataFrame:
    """Replace the secrets known for each run (run_id, secrets) in a text column, in list order; runs without any keep their texts.

    Texts and secret lists are dealt by run and come sorted, the list first, so a task builds one automaton at a time and
    no row carries a list. Texts of a run with a large share are spread over several tasks, each with the list.
    """
    ship_code(df.sparkSession)
    parts = _spread(df)
    rows = df.select(
        F.col("run_id").alias("run"), F.pmod(F.xxhash64(column), parts).cast("int").alias("part"), F.lit(1).alias("turn"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.lit(None).cast("array<string>").alias("known"),
    )
    lists = secrets.where("run_id IS NOT NULL").select(
        F.col("run_id").alias("run"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("turn"),
        F.lit(None).cast(rows.schema["row"].dataType).alias("row"), F.col("secrets").alias("known"),
    )
    place = df.columns.index(column)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, known, pending = None, None, []
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            turns, lists = batch.column(2).to_pylist(), batch.column(4)
            wanted = pa.array([i for i, t in enumerate(turns) if t == 1], pa.int64())
            fields = batch.column(3).take(wanted).flatten()
            texts, done = iter(fields[place].to_pylist()), []
            for i, turn in enumerate(turns):
                if keys[i] != key:
                    key, known, pending = keys[i], None, []
                if turn == 0:
                    pending += [s for s in lists[i].as_py() or [] if s is not None]
                    continue
                if known is None:
                    known = KnownSecrets(pending)
                text = next(texts)
                done.append(None if text is None else known.mask(text))
            fields[place] = pa.array(done, fields[place].type)
            yield pa.RecordBatch.from_arrays(fields, names=[f"c{i}" for i in range(len(fields))])

    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(df.schema.fields)])
    dealt = rows.unionByName(lists).repartition("run", "part").sortWithinPartitions("run", "part", "turn")
    return dealt.mapInArrow(mask, schema).toDF(*df.columns)


@F.arrow_udf(T.StringType())
def _mask_documents(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else mask_json(t) for t in texts.to_pylist()], pa.string())


def redact_by_key(df: DataFrame, column: str) -> DataFrame:
    """Mask secret members of a JSON column at any depth; text that is not JSON is redacted as text.

    Documents nest without limit, which column expressions cannot follow, so one linear pass over each canonical
    text does it, in Arrow batches.
    """
    ship_code(df.sparkSession)
    as_text = let(redact_text(F.col(column)), json_text)
    plain = F.to_json(F.try_parse_json(column))
    return df.withColumn(column, F.coalesce(_mask_documents(plain), as_text))
