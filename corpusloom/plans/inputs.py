"""The given tables, read as the raw sources of the four modalities.

documents -> texts, pages -> captioned images, part -> videos, conversations
-> transcribed audio, embeddings -> stored vectors, benchmark -> query probes.
File facts that would come from a listing or a decoder are derived from the
same tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import vectors
from corpusloom.operators import catalog as cat
from corpusloom.operators import embed, quality
from corpusloom.operators.ranking import with_position
from corpusloom.operators.search import CLIP_SPACE
from corpusloom.plans.curation import embed_manifest
from corpusloom.sources import connectors as con
from corpusloom.sources.readers import spread, spread_rows, table

IMAGES, VIDEOS, CLIPS, FRAMES, AUDIO = "/m/images", "/m/videos", "/m/clips", "/m/frames", "/m/audio"
FPS = 24.0


def raw_text(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text", "n_chars")).select(
        F.col("doc_id").alias("idx"),
        "text",
        F.lit("").alias("url"),
        F.col("n_chars").alias("token_count"),
    )


def raw_images(spark: SparkSession, d: str) -> DataFrame:
    def inside(tag: str):
        return F.regexp_extract("html", f"(?s)<{tag}>(.*?)</{tag}>", 1)

    return spread(table(spark, d, "pages")).select(
        F.col("page_id").alias("idx"),
        F.array(inside("title"), inside("h1")).alias("sentences_raw"),
        F.col("page_id").alias("cocoid"),
        F.encode("html", "UTF-8").alias("image"),
        F.regexp_extract("url", "([^/]*)$", 1).alias("filename"),
        F.lit(None).cast("string").alias("split"),
    )


def raw_clips(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_name"))
    return spread_rows(table(spark, d, "part")).select(
        F.col("p_partkey").alias("idx"),
        F.when(F.col("p_size") < 50, F.encode("p_name", "UTF-8")).alias("mp4"),
        F.col("p_size").cast("double").alias("duration"),
        F.lit(FPS).alias("fps"),
        F.struct(
            F.struct(text.alias("description")).alias("content_metadata"),
            F.col("p_brand").alias("youtube_title"),
            F.lit(None).cast("string").alias("text_to_speech"),
            F.col("p_type").alias("content_fine_category"),
            F.col("p_type").alias("content_parent_category"),
            F.lit(None).cast("string").alias("original_video_filename"),
            F.lit(None).cast("string").alias("original_json_filename"),
            F.lit(None).cast("string").alias("youtube_channel"),
            F.lit(None).cast("string").alias("youtube_upload_date"),
        ).alias("json"),
    )


def raw_videos(spark: SparkSession, d: str) -> DataFrame:
    """Small parts come as bytes, middle ones as a path that exists, large
    ones as a path that does not."""
    size = F.col("p_size")
    name = F.concat(F.lit("/in/"), F.col("p_partkey").cast("string"), F.lit(".mp4"))
    return spread_rows(table(spark, d, "part")).select(
        F.col("p_partkey").alias("idx"),
        F.col("p_name").alias("caption"),
        F.struct(
            F.when(size < 20, F.encode("p_name", "UTF-8")).alias("bytes"),
            F.when(size >= 20, name).alias("path"),
            ((size >= 20) & (size < 40)).alias("path_exists"),
        ).alias("video"),
        F.col("p_type").alias("category"),
        size.cast("double").alias("duration"),
        F.lit(FPS).alias("fps"),
    )


def raw_audio(spark: SparkSession, d: str) -> DataFrame:
    """Turns in order; system turns have no audio payload."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    spoken = F.col("role") != "system"
    return with_position(turns, "conv_id", "turn", name="idx").select(
        "idx",
        "text",
        "role",
        F.struct(
            F.lit(None).cast("array<double>").alias("array"),
            F.when(spoken, F.encode("text", "UTF-8")).alias("bytes"),
            F.lit(None).cast("string").alias("path"),
            F.lit(False).alias("path_exists"),
            F.lit(None).cast("int").alias("sampling_rate"),
        ).alias("audio"),
        F.col("conv_id").alias("speaker_id"),
        F.col("turn").alias("chapter_id"),
    )


def manifest(spark: SparkSession, d: str, modality: str) -> DataFrame:
    if modality == "text":
        return con.text_manifest(raw_text(spark, d))
    if modality == "image":
        return con.image_manifest(raw_images(spark, d), IMAGES)
    if modality == "video":
        return con.clip_manifest(raw_clips(spark, d), CLIPS, FRAMES)
    return con.audio_manifest(raw_audio(spark, d), AUDIO)


def _by_modality(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {m: manifest(spark, d, m) for m in schemas.MODALITIES}


def _union(parts: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts.values())


def all_manifests(spark: SparkSession, d: str) -> DataFrame:
    return _union(_by_modality(spark, d))


def listings_of(
    spark: SparkSession, d: str, made: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Asset files that exist: images of pages without a fragment in their
    address, all clips of videos over three seconds, all audio."""
    images = table(spark, d, "pages").where(~F.col("url").contains("#"))
    clips = made["video"].where("payload.metadata.source_duration_seconds > 3")
    return {
        "image": images.select(F.format_string(f"{IMAGES}/coco_%012d.jpg", "page_id").alias("path")),
        "video": clips.select(F.col("payload.content").alias("path")),
        "audio": made["audio"].select(F.col("payload.content").alias("path")),
    }


def with_probes(rows: DataFrame) -> DataFrame:
    """Decoder facts, derived from caption lengths: images with a short
    caption do not decode, and audio length and loudness follow its text."""
    n = F.length("payload.caption")
    is_audio = F.col("modality") == "audio"
    unread = n % 97 == 0
    return (
        rows.withColumn("asset_ok", n > 20)
        .withColumn("peak", F.when(is_audio & ~unread, (n % 40) / 1000))
        .withColumn("duration_s", F.when(is_audio & ~unread, n / 100))
    )


def _gate(spark: SparkSession, d: str, made: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Each modality against the part of the listing that can hold its files."""
    files = listings_of(spark, d, made)

    def one(modality: str, rows: DataFrame) -> DataFrame:
        if modality in files:
            rows = quality.with_listing(rows, files[modality])
        else:
            rows = rows.withColumn("asset_exists", F.lit(False))
        return quality.quality_gate(with_probes(rows))

    return {m: one(m, rows) for m, rows in made.items()}


def gated(spark: SparkSession, d: str) -> DataFrame:
    return _union(_gate(spark, d, _by_modality(spark, d)))


def text_model() -> embed.HashingModel:
    return embed.HashingModel(vectors.TEXT_DIM)


def clip_model() -> embed.HashingModel:
    return embed.HashingModel(vectors.CLIP_DIM)


def _embed(rows: DataFrame, modality: str) -> DataFrame:
    model = clip_model() if modality in CLIP_SPACE else text_model()
    return embed_manifest(rows, modality, model)


def embedded(spark: SparkSession, d: str, modality: str) -> DataFrame:
    return _embed(manifest(spark, d, modality), modality)


def all_embedded(spark: SparkSession, d: str) -> DataFrame:
    return _union({m: _embed(rows, m) for m, rows in _by_modality(spark, d).items()})


def catalog(spark: SparkSession, d: str, with_vectors: bool = True) -> DataFrame:
    """Gated rows of all modalities as catalog rows, failing ones marked. The
    rows carry their vectors: nothing is joined back."""
    return catalog_and_listing(spark, d, with_vectors)[0]


def catalog_and_listing(
    spark: SparkSession, d: str, with_vectors: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``catalog`` and the asset files it was checked against."""
    made = _by_modality(spark, d)
    rows = _gate(spark, d, made)
    if with_vectors:
        rows = {m: _embed(part, m) for m, part in rows.items()}
    return cat.build_catalog(_union(rows)), _union(listings_of(spark, d, made))


def stored_vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", "embedding", "label")


def probes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
