"""Connectors: raw source rows -> manifest rows.

Each takes a DataFrame of raw rows that carries ``idx``, the row's position in
its source, and returns the manifest schema. Rejected rows are filtered out; a
row that yields several records is exploded. All of it is column expressions,
so a connector adds no shuffle to the scan it sits on.

Texts are kept whole. ``max_chars`` cuts them where a fixed size is wanted
(the usual setting is 2 000 characters); the hash then covers the cut text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import text

# The source each connector stamps on its rows.
TEXT_SOURCE = "HuggingFaceFW/fineweb-edu/sample-10BT"
IMAGE_SOURCE = "Multimodal-Fatima/COCO_captions_train"
VIDEO_SOURCE = "AlexZigma/msr-vtt"
CLIP_SOURCE = "HuggingFaceFV/finevideo"
AUDIO_SOURCE = "openslr/librispeech_asr/clean"

MIN_WORDS = 30
CAPTION_CHARS = 200
DEFAULT_RATE = 16000

# Where a clip's caption may come from, in order.
CLIP_CAPTION_FIELDS = [
    "json.content_metadata.description",
    "json.youtube_title",
    "json.text_to_speech",
    "json.content_fine_category",
]

# Descriptive fields copied from the source video to its clips.
CLIP_PROVENANCE = [
    "content_parent_category",
    "content_fine_category",
    "original_video_filename",
    "original_json_filename",
    "youtube_title",
    "youtube_channel",
    "youtube_upload_date",
]


def _metadata(**fields: Column) -> Column:
    return F.struct(
        *[
            fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.METADATA
        ]
    )


def _manifest(
    rows: DataFrame,
    modality: str,
    source: Column,
    content: Column,
    metadata: Column,
    sub_idx: Column | None = None,
) -> DataFrame:
    """Rows that already hold ``id, content_hash, caption`` -> manifest rows."""
    payload = F.struct(
        F.lit(modality).alias("type"),
        content.alias("content"),
        F.col("caption"),
        metadata.alias("metadata"),
    )
    return rows.select(
        "id",
        source.alias("source"),
        F.lit(modality).alias("modality"),
        "content_hash",
        payload.alias("payload"),
        F.col("idx").cast("long").alias("idx"),
        (F.lit(0) if sub_idx is None else sub_idx).cast("int").alias("sub_idx"),
    )


def text_manifest(
    raw: DataFrame,
    max_chars: int | None = None,
    min_words: int = MIN_WORDS,
    caption_chars: int = CAPTION_CHARS,
    source: Column | None = None,
) -> DataFrame:
    """Raw ``idx, text, url, token_count``; texts under 30 words are rejected."""
    body = text.truncate(text.normalize_ws(F.col("text")), max_chars)
    judged = F.col("text") if max_chars is None else body
    rows = (
        raw.where(text.at_least_words(judged, min_words))
        .withColumn("body", body)
        .withColumn("id", text.padded_id("fineweb_", 8, F.col("idx")))
        .withColumn("content_hash", text.content_hash(F.col("body")))
        .withColumn("caption", text.truncate(F.col("body"), caption_chars))
    )
    meta = _metadata(
        url=F.coalesce("url", F.lit("")),
        token_count=F.coalesce(F.col("token_count").cast("int"), F.lit(0)),
    )
    return _manifest(
        rows, "text", F.lit(TEXT_SOURCE) if source is None else source, F.col("body"), meta
    )


def image_manifest(raw: DataFrame, image_dir: str) -> DataFrame:
    """Raw ``idx, sentences_raw[], cocoid, image, filename, split``.

    The hash is that of the image bytes; a row without bytes is identified by
    its id and caption.
    """
    cocoid = text.int_or(F.col("cocoid").cast("long"), F.col("idx").cast("long"))
    rows = (
        raw.withColumn("captions", text.clean_list(F.col("sentences_raw")))
        .where(F.size("captions") > 0)
        .withColumn("cocoid", cocoid)
        .withColumn("caption", F.element_at("captions", 1))
        .withColumn("id", text.padded_id("coco_", 12, F.col("cocoid")))
        .withColumn("content_hash", _asset_hash(F.col("image")))
    )
    meta = _metadata(
        cocoid=F.col("cocoid"),
        filename=F.coalesce("filename", F.lit("")),
        split=F.coalesce("split", F.lit("train")),
        all_captions=F.to_json("captions"),
    )
    content = F.concat(F.lit(image_dir.rstrip("/") + "/"), "id", F.lit(".jpg"))
    return _manifest(rows, "image", F.lit(IMAGE_SOURCE), content, meta)


def _asset_hash(data: Column) -> Column:
    """Hash of an asset's bytes, else of ``id`` followed by ``caption``."""
    named = text.content_hash(F.concat("id", "caption"))
    return F.when(F.length(data) > 0, text.content_hash(data)).otherwise(named)


def has_bytes(data: Column) -> Column:
    return F.coalesce(F.length(data) > 0, F.lit(False))


def frame_count(seconds: Column, fps: Column, stride: int) -> Column:
    """Frames 0, s, 2s, … of a clip that lasts ``seconds``."""
    return F.ceil(F.floor(seconds * fps) / stride).cast("int")


def frame_paths(root: str, clip_id: Column, n: Column) -> Column:
    """Where the ``n`` sampled frames of a clip lie, numbered from one."""
    folder = F.concat(F.lit(root.rstrip("/") + "/"), clip_id)
    numbers = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(
        F.array().cast("array<int>")
    )

    def name(i: Column) -> Column:
        """``frame_%03d`` without a formatter, which costs most of a long list."""
        number = i.cast("string")
        return F.when(i < 1000, F.lpad(number, 3, "0")).otherwise(number)

    return F.transform(
        numbers, lambda i: F.concat(folder, F.lit("/frame_"), name(i), F.lit(".jpg"))
    )


def video_manifest(
    raw: DataFrame, video_dir: str, keyframe_dir: str, stride: int = 4
) -> DataFrame:
    """One clip per row. Raw ``idx, caption, video{bytes,path,path_exists},
    category, duration, fps``.

    A row needs a caption, a payload (bytes, or a path that exists) and at
    least one sampled frame.
    """
    usable = has_bytes(F.col("video.bytes")) | F.coalesce(
        F.col("video.path_exists"), F.lit(False)
    )
    rows = (
        raw.withColumn("caption", text.normalize_ws(F.col("caption")))
        .where((F.col("caption") != "") & usable)
        .withColumn("id", text.padded_id("msrvtt_", 8, F.col("idx")))
        .withColumn("n", frame_count(F.col("duration"), F.col("fps"), stride))
        .where("n > 0")
        .withColumn("content_hash", _asset_hash(F.col("video.bytes")))
    )
    meta = _metadata(
        keyframe_paths=F.to_json(frame_paths(keyframe_dir, F.col("id"), F.col("n"))),
        n_keyframes=F.col("n"),
        category=F.coalesce(F.col("category").cast("string"), F.lit("")),
    )
    content = F.concat(F.lit(video_dir.rstrip("/") + "/"), "id", F.lit(".mp4"))
    return _manifest(rows, "video", F.lit(VIDEO_SOURCE), content, meta)


def count_clips(duration: Column, clip_s: float, max_clips: int | None = None) -> Column:
    """All clips, the last one possibly short; with ``max_clips`` as many
    whole ones as fit up to that number. At least one."""
    if max_clips is None:
        return F.greatest(F.lit(1), F.ceil(duration / clip_s).cast("int"))
    whole = F.floor(duration / clip_s).cast("int")
    return F.greatest(F.lit(1), F.least(F.lit(max_clips), whole))


def plan_clips(
    rows: DataFrame, duration: str, clip_s: float = 8.0, max_clips: int | None = None
) -> DataFrame:
    """Add ``clip_idx, clip_start``: at least one clip, and as many as the
    duration has room for. See ``count_clips``."""
    n = count_clips(F.col(duration), clip_s, max_clips)
    return (
        rows.where(F.col(duration).isNotNull())
        .withColumn("clip_idx", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn("clip_start", F.col("clip_idx") * F.lit(float(clip_s)))
    )


def plan_segments(rows: DataFrame, duration: str, piece_s: float) -> DataFrame:
    """Cut the whole duration into fixed pieces; the last one may be short."""
    n = F.greatest(F.lit(1), F.ceil(F.col(duration) / piece_s).cast("int"))
    start = F.col("piece_idx") * F.lit(float(piece_s))
    return (
        rows.where(F.col(duration).isNotNull())
        .withColumn("piece_idx", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn("piece_start", start)
        .withColumn(
            "piece_seconds",
            F.least(F.lit(float(piece_s)), F.col(duration) - F.col("piece_start")),
        )
    )


def plan_frames(clips: DataFrame, n_frames: str, stride: int = 24) -> DataFrame:
    """One row per sampled frame: every ``stride``-th, starting with frame 0."""
    steps = F.sequence(F.lit(0), F.col(n_frames).cast("int") - 1, F.lit(stride))
    return clips.where(F.col(n_frames) > 0).select(
        "*", F.posexplode(steps).alias("frame_idx", "frame_no")
    )


def clip_manifest(
    raw: DataFrame,
    clip_dir: str,
    keyframe_dir: str,
    clips_per_video: int | None = None,
    clip_seconds: float = 8.0,
    keyframe_stride: int = 24,
    max_chars: int | None = None,
) -> DataFrame:
    """Several clips per row. Raw ``idx, mp4, duration, fps, json{…}``.

    By default the clips cover the whole video and each tells its own length;
    with ``clips_per_video`` only the first whole ones are made, of the nominal
    length. A clip has no bytes of its own before it is cut, so its hash covers its id
    and caption.
    """
    caption = text.first_nonempty(*[F.col(f) for f in CLIP_CAPTION_FIELDS])
    videos = raw.withColumn(
        "caption", text.truncate(text.normalize_ws(caption), max_chars)
    ).where((F.col("caption") != "") & has_bytes(F.col("mp4")))
    seconds = F.least(F.lit(float(clip_seconds)), F.col("duration") - F.col("clip_start"))
    source_id = text.padded_id("finevideo_", 8, F.col("idx"))
    rows = (
        plan_clips(videos, "duration", clip_seconds, clips_per_video)
        .withColumn(
            "id", F.concat(source_id, F.format_string("_clip_%03d", F.col("clip_idx")))
        )
        .withColumn("n", frame_count(seconds, F.col("fps"), keyframe_stride))
        .where("n > 0")
        .withColumn("content_hash", text.content_hash(F.concat("id", "caption")))
    )
    meta = _metadata(
        keyframe_paths=F.to_json(frame_paths(keyframe_dir, F.col("id"), F.col("n"))),
        n_keyframes=F.col("n"),
        source_duration_seconds=F.col("duration"),
        clip_start_seconds=F.col("clip_start"),
        clip_duration_seconds=seconds if clips_per_video is None else F.lit(float(clip_seconds)),
        **{f: F.coalesce(F.col(f"json.{f}"), F.lit("")) for f in CLIP_PROVENANCE},
    )
    content = F.concat(F.lit(clip_dir.rstrip("/") + "/"), "id", F.lit(".mp4"))
    return _manifest(
        rows, "video", F.lit(CLIP_SOURCE), content, meta, F.col("clip_idx")
    )


def audio_manifest(raw: DataFrame, audio_dir: str) -> DataFrame:
    """Raw ``idx, text, audio{array,bytes,path,path_exists,sampling_rate},
    speaker_id, chapter_id``. Needs a transcript and a payload."""
    usable = (
        F.col("audio.array").isNotNull()
        | has_bytes(F.col("audio.bytes"))
        | F.coalesce(F.col("audio.path_exists"), F.lit(False))
    )
    rows = (
        raw.withColumn("caption", text.normalize_ws(F.col("text")))
        .where((F.col("caption") != "") & usable)
        .withColumn("id", text.padded_id("librispeech_", 8, F.col("idx")))
        .withColumn("content_hash", _asset_hash(F.col("audio.bytes")))
    )
    meta = _metadata(
        sampling_rate=text.int_or(F.col("audio.sampling_rate"), F.lit(DEFAULT_RATE)),
        speaker_id=F.coalesce(F.col("speaker_id").cast("string"), F.lit("")),
        chapter_id=F.coalesce(F.col("chapter_id").cast("string"), F.lit("")),
    )
    content = F.concat(F.lit(audio_dir.rstrip("/") + "/"), "id", F.lit(".wav"))
    return _manifest(rows, "audio", F.lit(AUDIO_SOURCE), content, meta)
