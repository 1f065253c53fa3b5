"""Which container images a run may call its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name prefixes of task images.
IMAGE_PREFIXES = ["swebench/", "sweb.eval", "sweb.env", "sweap", "jefzda/sweap"]
NO_START = "~"  # sorts after every timestamp text


def referenced_images(evidence: DataFrame) -> DataFrame:
    """Distinct (run_id, image) named by prediction and review lines."""
    image = F.col("docker_image")
    known = F.lit(False)
    for prefix in IMAGE_PREFIXES:
        known = known | image.startswith(prefix)
    return evidence.filter(known).select("run_id", image.alias("image")).distinct()


def ownership_candidates(references: DataFrame, attempts: DataFrame) -> DataFrame:
    """The attempt that answers for each image.

    ``attempts``: run_id, run_pos, attempt_start (ISO text), has_baseline. An attempt
    with a pre-run inventory beats one without; among those the earliest start
    wins (a missing start is last); without any inventory the first seen wins.
    """
    joined = references.join(attempts, "run_id")
    rank = F.struct(
        ~F.col("has_baseline"),
        F.when(F.col("has_baseline"), F.coalesce("attempt_start", F.lit(NO_START))).otherwise(F.lit("")),
        F.col("run_pos"),
    )
    chosen = F.min_by(F.struct("run_id", "attempt_start", "has_baseline"), rank)
    return joined.groupBy("image").agg(chosen.alias("c")).select("image", "c.*")


_INSTANT = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2})(?:\.(\d{1,6})\d*)?(?:(?:Z|z)|([+-])(\d{2}):?(\d{2}))?$"


def image_time(text: Column) -> Column:
    """Instant of an ISO text: date and time, a fraction cut to microseconds, and a signed zone; no zone means UTC."""
    given = F.trim(text)
    part = lambda n: F.regexp_extract(given, _INSTANT, n)
    fraction = F.when(part(2) != "", F.concat(F.lit("."), part(2))).otherwise(F.lit(""))
    zone = F.when(part(3) != "", F.concat(part(3), part(4), F.lit(":"), part(5))).otherwise(F.lit("+00:00"))
    return F.when(given.rlike(_INSTANT), F.concat(part(1), fraction, zone).try_cast("timestamp"))


def ownership_classify(
    candidates: DataFrame, inventory: DataFrame, in_use: DataFrame, created: DataFrame, baseline: DataFrame
) -> DataFrame:
    """Class of every candidate: absent, in_use, owned, or unproven with the reason.

    ``created``: image, created_at, inspect_error. ``baseline``: run_id, image from the
    attempts' pre-run inventories. ``has_baseline`` may be NULL where only a start
    time is known; then the inventory rules do not apply.
    """
    flag = lambda name: F.lit(True).alias(name)
    joined = (
        candidates.join(inventory.select("image").distinct().select("image", flag("available")), "image", "left")
        .join(in_use.select("image").distinct().select("image", flag("used")), "image", "left")
        .join(created.select("image", "created_at", "inspect_error"), "image", "left")
        .join(baseline.select("run_id", "image").distinct().select("run_id", "image", flag("seen_before")), ["run_id", "image"], "left")
    )
    made, started = image_time(F.col("created_at")), image_time(F.col("attempt_start"))
    clock = F.concat(
        F.lit("created="), F.coalesce(F.nullif("created_at", F.lit("")), F.lit("unknown")),
        F.lit(" attempt_start="), F.coalesce(F.nullif("attempt_start", F.lit("")), F.lit("unknown")),
    )
    c = F.col
    rules = [
        (c("available").isNull(), "absent", F.lit(None).cast("string")),
        (c("used").isNotNull(), "in_use", F.lit(None).cast("string")),
        (c("inspect_error").isNotNull(), "unproven", F.concat(F.lit("inspect failed: "), c("inspect_error"))),
        (c("has_baseline") & c("seen_before").isNotNull(), "unproven", F.lit("present in the pre-run image inventory")),
        (~c("has_baseline"), "unproven", F.lit("no pre-run image inventory was recorded")),
        (made >= started, "owned", F.lit(None).cast("string")),
    ]
    verdict = None
    for condition, name, reason in rules:
        value = F.struct(F.lit(name).alias("class"), reason.alias("reason"))
        verdict = F.when(condition, value) if verdict is None else verdict.when(condition, value)
    verdict = verdict.otherwise(F.struct(F.lit("unproven").alias("class"), clock.alias("reason")))
    return joined.select("image", "run_id", verdict.alias("v")).select("image", "run_id", "v.*")
