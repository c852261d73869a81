"""Look at an unknown video source before building on it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text
from corpusloom.sources.connectors import CLIP_CAPTION_FIELDS, count_clips, has_bytes

# Field names tried when a source names none itself.
CAPTION_FIELDS = ["caption", "text", "sentence"]
VIDEO_FIELDS = ["video", "video_path", "path", "file"]


@dataclass(frozen=True)
class Preset:
    """A named source: dataset, split and the fields to try in order."""

    dataset: str
    split: str = "train"
    caption_fields: list[str] = field(default_factory=lambda: list(CAPTION_FIELDS))
    video_fields: list[str] = field(default_factory=lambda: list(VIDEO_FIELDS))


# The named sources.
PRESETS = {
    "finevideo": Preset(
        "HuggingFaceFV/finevideo",
        caption_fields=CLIP_CAPTION_FIELDS,
        video_fields=["mp4"],
    ),
    "alexzigma": Preset("AlexZigma/msr-vtt"),
    "chengxiang-archive": Preset("Chengxiang1122/MSRVTT"),
    "chengxiang-mcl": Preset("Chengxiang1122/mcl-mmcl-msrvtt"),
    "friedrichor": Preset("friedrichor/MSR-VTT"),
    "vlm2vec": Preset("VLM2Vec/MSR-VTT"),
    "ntqai": Preset("NTQAI/MSR-VTT-Video-Captioning-Vi"),
    "arushijain": Preset("arushijain45/my-msr-vtt-video-dataset"),
    "arushijain-zip": Preset("arushijain45/my-msr-vtt-video-dataset-zip"),
}


def field_type(schema: T.StructType, dotted: str) -> T.DataType | None:
    """Type behind a dotted name, or None when the source lacks it."""
    current: T.DataType = schema
    for part in dotted.split("."):
        if not isinstance(current, T.StructType) or part not in current.fieldNames():
            return None
        current = current[part].dataType
    return current


def _caption(schema: T.StructType, fields: list[str]) -> Column:
    """First present field; of a list field, its first non-empty element."""
    found = []
    for name in fields:
        kind = field_type(schema, name)
        if isinstance(kind, T.ArrayType):
            strings = F.filter(F.col(name), lambda x: x != "")
            # A present list wins even when none of its elements is usable.
            found.append(
                F.when(F.col(name).isNotNull(), F.coalesce(F.get(strings, 0), F.lit("")))
            )
        elif kind is not None:
            found.append(F.nullif(F.col(name).cast("string"), F.lit("")))
    return text.normalize_ws(F.coalesce(*found, F.lit("")))


def resolve_payload(
    name: str, kind: T.DataType, path_exists: Column | None = None
) -> tuple[Column, Column]:
    """``(usable, shape)`` of a payload column.

    A record is read from its bytes before its path; a bare path counts only
    when the file exists. ``path_exists`` is that fact, joined from a listing.
    """
    exists = F.lit(False) if path_exists is None else F.coalesce(path_exists, F.lit(False))
    c = F.col(name)
    if isinstance(kind, T.StructType):
        keys = kind.fieldNames()
        in_bytes = has_bytes(c["bytes"]) if "bytes" in keys else F.lit(False)
        locations = [F.nullif(c[k], F.lit("")) for k in ("path", "filename") if k in keys]
        location = F.coalesce(*locations, F.lit(None).cast("string"))
        on_disk = location.isNotNull() & exists
        listed = ", ".join(f"'{k}'" for k in sorted(keys))
        shape = (
            F.when(in_bytes, F.lit("dict.bytes"))
            .when(on_disk, F.concat(F.lit("dict.path:"), location))
            .otherwise(F.lit(f"dict keys=[{listed}]"))
        )
        return in_bytes | on_disk, shape
    if isinstance(kind, T.BinaryType):
        return c.isNotNull(), F.lit("bytes")
    if isinstance(kind, T.StringType):
        shape = F.when(exists, F.concat(F.lit("path:"), c)).otherwise(
            F.concat(F.lit("string but not local path:"), text.compact(c))
        )
        return exists, shape
    return F.lit(False), F.lit(kind.simpleString())


def resolve_audio(name: str = "audio") -> Column:
    """Which part of an audio record is used: array, then bytes, then path."""
    return (
        F.when(F.col(f"{name}.array").isNotNull(), F.lit("array"))
        .when(has_bytes(F.col(f"{name}.bytes")), F.lit("bytes"))
        .when(F.coalesce(F.col(f"{name}.path_exists"), F.lit(False)), F.lit("path"))
    )


def schema_summary(raw: DataFrame) -> DataFrame:
    """One row per column, describing the first raw row."""
    first = raw.orderBy("idx").limit(1)
    names = [f for f in raw.schema if f.name != "idx"]

    def shape(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.StructType):
            listed = ", ".join(f"'{k}'" for k in sorted(f.dataType.fieldNames()))
            said = F.lit(f"dict keys=[{listed}]")
        elif isinstance(f.dataType, T.ArrayType):
            said = F.concat(F.lit("list len="), F.size(f.name).cast("string"))
        else:
            said = F.lit(f.dataType.simpleString())
        return F.when(F.col(f.name).isNull(), F.lit("null")).otherwise(said)

    described = F.array(
        *[F.struct(F.lit(f.name).alias("field"), shape(f).alias("shape")) for f in names]
    )
    return first.select(F.inline(described))


def judgement(
    schema: T.StructType,
    preset: Preset,
    path_exists: Column | None = None,
    clip_seconds: float = 8.0,
    max_clips: int | None = None,
) -> list[Column]:
    """``outcome, shape, clips`` of a row under a preset."""
    present, usable, shapes = [], [], []
    for name in preset.video_fields:
        kind = field_type(schema, name)
        if kind is None:
            continue
        is_text = isinstance(kind, T.StringType)
        there = F.col(name).isNotNull() & ((F.col(name) != "") if is_text else F.lit(True))
        ok, shape = resolve_payload(name, kind, path_exists)
        present.append(there)
        usable.append(F.when(there, ok))
        shapes.append(F.when(there, shape))
    any_field = F.lit(False)
    for there in present:
        any_field = any_field | there
    ok = F.coalesce(*usable, F.lit(False))
    outcome = (
        F.when(_caption(schema, preset.caption_fields) == "", F.lit("no caption"))
        .when(~any_field, F.lit("no video field"))
        .when(~ok, F.lit("unusable payload"))
        .when(F.col("duration").isNull(), F.lit("no duration"))
        .otherwise(F.lit("accept"))
    )
    n = count_clips(F.col("duration"), clip_seconds, max_clips)
    return [
        outcome.alias("outcome"),
        F.coalesce(*shapes, F.lit(None).cast("string")).alias("shape"),
        F.when(outcome == "accept", n).otherwise(0).alias("clips"),
    ]


def judge_rows(
    raw: DataFrame,
    preset: Preset,
    path_exists: Column | None = None,
    max_scan: int | None = None,
    clip_seconds: float = 8.0,
    max_clips: int | None = None,
) -> DataFrame:
    """``idx, outcome, shape, clips`` for every scanned row; ``outcome`` is
    ``accept`` or the reason the row is skipped."""
    scanned = raw if max_scan is None else raw.where(F.col("idx") < max_scan)
    return scanned.select("idx", *judgement(raw.schema, preset, path_exists, clip_seconds, max_clips))


def probe_presets(
    raw: DataFrame, presets: dict[str, Preset], path_exists: Column | None = None
) -> DataFrame:
    """``preset, outcome, n_rows, n_clips``: how each preset judges the same
    rows, in one scan."""

    def one(name: str, preset: Preset) -> Column:
        outcome, _, clips = judgement(raw.schema, preset, path_exists)
        return F.struct(F.lit(name).alias("preset"), outcome, clips)

    judged = raw.select(F.inline(F.array(*[one(n, p) for n, p in presets.items()])))
    return judged.groupBy("preset", "outcome").agg(
        F.count("*").alias("n_rows"), F.sum("clips").alias("n_clips")
    )


def probe_source(judged: DataFrame) -> DataFrame:
    """Rows and clips per outcome over everything that was scanned."""
    return judged.groupBy("outcome").agg(
        F.count("*").alias("n_rows"), F.sum("clips").alias("n_clips")
    )


def probe_first(
    raw: DataFrame,
    preset: Preset,
    accepted_target: int = 2,
    max_scan: int = 100,
    path_exists: Column | None = None,
) -> DataFrame:
    """The first accepted clips, as a quick probe stops at: at most
    ``max_scan`` rows are looked at, so ranking them in one window is small."""
    judged = judge_rows(raw, preset, path_exists, max_scan=max_scan)
    clips = judged.where("clips > 0").withColumn(
        "clip_idx", F.explode(F.sequence(F.lit(0), F.col("clips") - 1))
    )
    return (
        clips.select(
            F.concat(
                text.padded_id("probe_", 8, F.col("idx")),
                F.format_string("_clip_%03d", F.col("clip_idx")),
            ).alias("id"),
            "idx",
            "clip_idx",
            "shape",
        )
        .orderBy("idx", "clip_idx")
        .limit(accepted_target)
    )


def require_accepted(accepted: DataFrame, fail_under: int = 1) -> int:
    """Number of accepted clips, or an error when there are too few."""
    n = accepted.count()
    if n < fail_under:
        raise ValueError(f"accepted {n} records, below the required {fail_under}")
    return n
