"""The training-data operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmill.llm import (
    collocations,
    cotrain,
    decontaminate,
    embedding_dedup,
    packing,
    phrase_fingerprint,
    prefix_trie,
    secrets,
    sharding,
    site_tree,
    superminhash,
    token_counts,
    toxicity,
)
from proofmill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.leak_digest(decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    score = F.col("toxicity.score")
    return toxicity.score_toxicity(docs, chain).select(
        "doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
    )


def op3_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    views = cotrain.train_quality(docs, table(spark, sf_dir, "labels"))
    score = F.col("quality.score")
    return cotrain.score_quality(docs, views).select(
        "doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"), "quality.text_view", "quality.metadata_view",
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, shards=16, keep=["doc_id"])


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op6_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return superminhash.near_duplicates(docs, k=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = site_tree.main_text(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.secret_digest(secrets.find_secrets(docs, keep=["doc_id"]))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return pieces.sortWithinPartitions("length", "sequence_id")  # each task's pieces in bucket order, without a shuffle


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return phrase_fingerprint.as_text(phrase_fingerprint.fingerprint_pairs(docs))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_quality_cotraining": op3_quality_cotraining,
    "op4_sharding": op4_sharding,
    "op5_token_counts": op5_token_counts,
    "op6_superminhash": op6_superminhash,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_secret_scan": op9_secret_scan,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_phrase_fingerprint": op12_phrase_fingerprint,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES: dict[str, str] = {
    "op1_decontamination": decontaminate.ORACLE,
    "op6_superminhash": superminhash.ORACLE,
    "op7_embedding_dedup": embedding_dedup.ORACLE,
    "op9_secret_scan": secrets.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
