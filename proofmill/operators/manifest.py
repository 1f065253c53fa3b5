"""Sample manifests: roll-ups of fingerprinted samples per run and subset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proofmill.functions.canonical import json_bool, json_hex, json_object, json_text
from proofmill.operators.ordered import FANOUT, Digest, Rollup, tree_digests

MANIFEST = ["run_id", "subset"]


def first_n_per_subset(samples: DataFrame, limits: DataFrame) -> DataFrame:
    """First N samples of each subset by position; N comes from the run's plan row, NULL keeps all.

    Positions are dense, so the rule is a filter: no sort and no window.
    """
    bounded = samples.join(limits.select("run_id", "sample_limit"), "run_id", "left")
    return bounded.filter(F.col("sample_limit").isNull() | (F.col("pos") < F.col("sample_limit"))).drop("sample_limit")


def manifest_rollup(samples: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """One row per (run, subset): count, digests over the samples in order, evidence flag.

    ``samples``: run_id, subset, pos (dense, 0-based), sample_id, the three
    digests, media_evidence and optionally subset_pos. The id list itself stays
    in ``samples``. The digests are trees of ``fanout`` positions a node, whatever
    the size; they are compared among themselves, never with an artifact's declared values.
    """
    if "subset_pos" not in samples.columns:
        samples = samples.withColumn("subset_pos", F.lit(0).cast("bigint"))
    digests = {
        name: Digest(json_hex(F.col(name))) for name in ("question_digest", "media_digest", "input_digest")
    }
    digests["sample_ids_digest"] = Digest(json_text(F.col("sample_id")))
    return tree_digests(
        samples, MANIFEST, F.floor(F.col("pos") / F.lit(fanout)).cast("bigint"), ["pos"], digests,
        {
            "selected": Rollup(F.count(F.lit(1)), F.sum),
            # a stored row without the flag counts as proven
            "media_evidence": Rollup(F.bool_and(F.coalesce("media_evidence", F.lit(True))), F.bool_and),
            "subset_pos": Rollup(F.min("subset_pos"), F.min),
        },
    )


def manifest_row_json() -> Column:
    """Canonical JSON of a manifest row before coverage is added."""
    return json_object(
        subset=json_text(F.col("subset")),
        selected=F.col("selected").cast("string"),
        sample_ids=json_hex(F.col("sample_ids_digest")),
        question_digest=json_hex(F.col("question_digest")),
        media_digest=json_hex(F.col("media_digest")),
        input_digest=json_hex(F.col("input_digest")),
        media_evidence=json_bool(F.col("media_evidence")),
    )


def manifest_identity(manifest: DataFrame) -> DataFrame:
    """Per run: digest of the manifest rows. Runs without rows have no identity.

    Subsets are chunked by the first two hex digits of their name's MD5, so a run with very many subsets is
    spread as well; within a chunk they come by position and name.
    """
    return tree_digests(
        manifest, ["run_id"], F.substring(F.md5(F.col("subset").cast("binary")), 1, 2), ["subset_pos", "subset"],
        {"manifest_digest": Digest(manifest_row_json())},
    )
