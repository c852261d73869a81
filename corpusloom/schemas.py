"""Declared schemas. Every artifact is read and written with one of these."""

from pyspark.sql import types as T

MODALITIES = ["text", "image", "video", "audio"]

# Union of the per-modality metadata fields. A struct keeps nested column
# pruning, so a reader that needs `payload.metadata.url` scans only that leaf.
METADATA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("token_count", T.IntegerType()),
        T.StructField("cocoid", T.LongType()),
        T.StructField("filename", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("all_captions", T.StringType()),
        T.StructField("keyframe_paths", T.StringType()),
        T.StructField("n_keyframes", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("source_duration_seconds", T.DoubleType()),
        T.StructField("clip_start_seconds", T.DoubleType()),
        T.StructField("clip_duration_seconds", T.DoubleType()),
        T.StructField("content_parent_category", T.StringType()),
        T.StructField("content_fine_category", T.StringType()),
        T.StructField("original_video_filename", T.StringType()),
        T.StructField("original_json_filename", T.StringType()),
        T.StructField("youtube_title", T.StringType()),
        T.StructField("youtube_channel", T.StringType()),
        T.StructField("youtube_upload_date", T.StringType()),
        T.StructField("source_video_field", T.StringType()),
        T.StructField("source_video_shape", T.StringType()),
        T.StructField("sampling_rate", T.IntegerType()),
        T.StructField("speaker_id", T.StringType()),
        T.StructField("chapter_id", T.StringType()),
    ]
)

PAYLOAD = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("caption", T.StringType()),
        T.StructField("metadata", METADATA),
    ]
)

# `idx`, `sub_idx` give the position in the source: everything that keeps
# "the first" or counts "the next" orders by them, never by arrival.
MANIFEST = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("modality", T.StringType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("payload", PAYLOAD),
        T.StructField("idx", T.LongType()),
        T.StructField("sub_idx", T.IntegerType()),
    ]
)

VECTOR = T.ArrayType(T.FloatType())

CATALOG = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("modality", T.StringType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("quality_status", T.StringType()),
        T.StructField("license", T.StringType()),
        T.StructField("caption", T.StringType()),
        T.StructField("content_path", T.StringType()),
        T.StructField("metadata_json", T.StringType()),
        T.StructField("text_vector", VECTOR),
        T.StructField("clip_vector", VECTOR),
        T.StructField("has_embedding", T.BooleanType()),
    ]
)

EMBEDDING_CACHE = T.StructType(
    [
        T.StructField("content_hash", T.StringType()),
        T.StructField("embedding", VECTOR),
        T.StructField("modality", T.StringType()),
        T.StructField("model_version", T.StringType()),
    ]
)

VERSION_ITEMS = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("modality", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("content_hash", T.StringType()),
    ]
)

SHARD_MEMBERS = T.StructType(
    [
        T.StructField("shard_idx", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("json", T.StringType()),
        T.StructField("asset_name", T.StringType()),
        T.StructField("asset_bytes", T.BinaryType()),
    ]
)
