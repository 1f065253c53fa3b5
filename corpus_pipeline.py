"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; its result is
written as Parquet and read again for the next one; a stage's table goes once the next one is written.
All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill.llm import decontaminate, packing, secrets, superminhash, toxicity
from proofmill.llm.common import drop_folder, free_name, table
from proofmill.session import stored

TOKENIZER = "byte_bpe_50k.json"
TOXIC_FROM = 0.5
MAX_COVERAGE = 0.5


def _with_text(df: DataFrame, text: Column, columns: list[str]) -> DataFrame:
    """The given columns with a new text; its length follows where it is a column."""
    name = free_name(df, "new_text")
    new = df.withColumn(name, text)
    changed = {"text": F.col(name), "n_chars": F.char_length(name).cast("long")}
    return new.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the CRF scores as toxic go."""
    chain = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "toxicity")
    scored = toxicity.score_toxicity(docs, chain, name=name)
    return scored.where(F.col(f"{name}.score") < TOXIC_FROM).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    return superminhash.drop_near_duplicates(docs, k=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that mostly consist of them go."""
    leak, rejected, text = (free_name(docs, n) for n in ("leak", "rejected", "clean_text"))
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), name=leak)
    clean = decontaminate.remove_leaks(found, max_coverage=MAX_COVERAGE, name=leak, rejected=rejected, clean_text=text)
    return _with_text(clean.where(~F.col(rejected)), F.col(text), docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    name = free_name(docs, "secrets")
    found = secrets.find_secrets(docs, name=name)
    return _with_text(found, secrets.redact(found, name=name), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of a power of two of ids, each from one document, with their ids, in buckets of equal length."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("decontamination", remove_benchmark),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: The learned first stage and the tokenizer have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, run_folder, before = table(spark, sf_dir, "documents"), f"pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        folder = f"{run_folder}/{name}"
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/docs")
        if before is not None:
            drop_folder(spark, before)
        before = folder
    return docs
