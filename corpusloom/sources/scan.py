"""Bounded scans: how many raw rows are looked at, how many are accepted.

``idx`` numbers the raw rows from zero, so a bound on the rows looked at is a
predicate on ``idx`` that the scan itself can apply.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text

# What the two samplers stamp on their rows.
TEXT_SAMPLE_SOURCE = "fineweb-edu/sample-10BT"
IMAGE_SAMPLE_SOURCE = "ArkaMukherjee/coco_dog_images_with_captions"


def bounded_scan(
    raw: DataFrame,
    connector: Callable[[DataFrame], DataFrame],
    limit: int = 1000,
    max_scan: int | None = None,
) -> DataFrame:
    """First ``limit`` records that ``connector`` accepts out of the first
    ``max_scan`` raw rows (twenty per wanted record unless given).

    A limit of zero or less reads nothing and keeps the schema.
    """
    if limit <= 0:
        return connector(raw).where(F.lit(False))
    reach = max_scan or limit * 20
    accepted = connector(raw.where(F.col("idx") < reach))
    return accepted.orderBy("idx", "sub_idx").limit(limit)


def scan_outcome(accepted: DataFrame, limit: int) -> DataFrame:
    """How far a scan fell short of its target."""
    return accepted.agg(F.count("*").alias("accepted")).select(
        F.lit(limit).alias("requested"),
        "accepted",
        (F.col("accepted") < limit).alias("under_target"),
    )


def sample_text(raw: DataFrame, limit: int = 2000, max_chars: int | None = None) -> DataFrame:
    """Look at exactly ``limit`` rows, then drop the short ones: unlike a
    bounded scan the result is usually smaller than the limit."""
    body = text.truncate(text.normalize_ws(F.col("text")), max_chars)
    return (
        raw.where(F.col("idx") < limit)
        .withColumn("text", body)
        .where(text.at_least_words(F.col("text"), 30))
        .select(
            F.col("idx").cast("string").alias("id"),
            "text",
            F.coalesce("url", F.lit("")).alias("url"),
            F.coalesce(F.col("token_count").cast("int"), F.lit(0)).alias("token_count"),
            F.lit(TEXT_SAMPLE_SOURCE).alias("source"),
        )
    )


def sample_images(raw: DataFrame, image_dir: str, limit: int = 500) -> DataFrame:
    """First ``limit`` rows of ``idx, captions``, without empty captions."""
    image_id = text.padded_id("coco_dog_", 6, F.col("idx"))
    return (
        raw.where(F.col("idx") < limit)
        .withColumn("caption", text.normalize_ws(F.col("captions")))
        .where("caption <> ''")
        .select(
            image_id.alias("image_id"),
            F.concat(F.lit(image_dir.rstrip("/") + "/"), image_id, F.lit(".jpg")).alias(
                "image_path"
            ),
            "caption",
            F.lit(IMAGE_SAMPLE_SOURCE).alias("source"),
            F.lit("train").alias("split"),
        )
    )
