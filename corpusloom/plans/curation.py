"""The stages of a curation run, each reading and writing artifacts.

``run`` goes through them in order; every stage can also be run alone. A
stage whose artifact is already there is skipped unless forced, and a vector
artifact with another row count than its manifest is rebuilt.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import paths, vectors
from corpusloom.operators import catalog as cat
from corpusloom.operators import dedup, embed, quality, shards, versions
from corpusloom.operators.search import CLIP_SPACE
from corpusloom.session import scratch, stage_table
from corpusloom.sources import tarshard

# Manifest file name of each modality.
MANIFEST_NAMES = {
    "text": "fineweb_edu",
    "image": "coco_captions",
    "video": "finevideo",
    "audio": "librispeech",
}

STAGES = ["connectors", "preprocessing", "quality", "catalog", "version", "shards", "benchmark"]
# The names by which each stage can be resumed.
RESUME_NAMES = {
    "connectors": ["connector", "connectors", "stage1", "stage_01"],
    "preprocessing": ["preprocess", "preprocessing", "stage2", "stage_02", "stage3"],
    "quality": ["quality", "dedup", "quality_dedup", "stage4", "stage_03"],
    "catalog": ["catalog", "stage5", "stage6", "stage_04"],
    "version": ["version", "versioning", "stage7", "stage_05"],
    "shards": ["shard", "shards", "sharding", "stage8", "stage_06"],
    "benchmark": ["benchmark", "stage9", "stage_07"],
}
# Further names of this library.
OWN_NAMES = {"embed": "preprocessing", "filter": "quality"}


def stage_named(name: str) -> str:
    """The stage that a name in any case, with hyphens or not, stands for."""
    plain = name.lower().replace("-", "_")
    for stage, names in RESUME_NAMES.items():
        if plain in names:
            return stage
    if plain in OWN_NAMES:
        return OWN_NAMES[plain]
    raise ValueError(f"unknown stage {name!r}")


@dataclass(frozen=True)
class Layout:
    """Where the artifacts of a run lie."""

    root: str

    def manifest(self, modality: str) -> str:
        return f"{self.root}/manifests/{MANIFEST_NAMES[modality]}_manifest.parquet"

    def embedded(self, modality: str) -> str:
        return f"{self.root}/preprocessed/{modality}_embedded.parquet"

    def filtered(self, modality: str) -> str:
        return f"{self.root}/filtered/{MANIFEST_NAMES[modality]}_filtered.parquet"

    @property
    def catalog(self) -> str:
        return f"{self.root}/catalog"

    @property
    def versions(self) -> str:
        return f"{self.root}/dataset_versions"

    def shards(self, version: str) -> str:
        return f"{self.root}/shards/{version}"

    def shard_manifest(self, version: str) -> str:
        return f"{self.root}/shards/{version}.manifest"


@dataclass
class Run:
    """What a run works on: the manifests to write, how to embed, limits.

    ``probe`` adds the probe columns the quality gate reads for file-backed
    rows (see ``operators.quality``); ``contents`` gives the asset files
    (``path, content``) that go into the shards.
    """

    spark: SparkSession
    layout: Layout
    manifests: dict[str, Callable[[], DataFrame]]
    probe: Callable[[DataFrame], DataFrame] = lambda rows: rows
    contents: Callable[[], DataFrame] | None = None
    text_model: Any = field(default_factory=lambda: embed.HashingModel(vectors.TEXT_DIM))
    clip_model: Any = field(default_factory=lambda: embed.HashingModel(vectors.CLIP_DIM))
    threshold: float = dedup.THRESHOLD
    shard_size: int = shards.SHARD_SIZE

    def model(self, modality: str) -> Any:
        return self.clip_model if modality in CLIP_SPACE else self.text_model

    @property
    def modalities(self) -> list[str]:
        return [m for m in schemas.MODALITIES if m in self.manifests]


def row_count(spark: SparkSession, path: str) -> int | None:
    """Rows of an artifact, from its footers; None when it is missing."""
    rows = cat.published(spark, path)
    return None if rows is None else rows.select().count()


def embed_decision(manifest_rows: int | None, embedded_rows: int | None, force: bool) -> tuple[str, str]:
    """``(status, reason)`` of the embed stage before it runs."""
    if manifest_rows is None:
        return "skipped", "missing manifest"
    if manifest_rows == 0:
        return "skipped", "empty manifest"
    if embedded_rows is None:
        return "build", "no output yet"
    if force:
        return "build", "force rebuild requested"
    if embedded_rows == manifest_rows:
        return "skipped", "preprocessed output already exists"
    return "build", "incomplete output detected"


def embed_input(modality: str):
    """What is embedded: the whole content of a text, else the caption; for a
    video its list of frames."""
    if modality == "text":
        return F.col("payload.content")
    if modality == "video":
        return F.from_json("payload.metadata.keyframe_paths", "array<string>")
    return F.col("payload.caption")


def embed_manifest(
    manifest: DataFrame, modality: str, model: Any, only: Column | None = None
) -> DataFrame:
    """Manifest rows with ``embedding``. Rows outside ``only`` reach the model
    as null, which it skips, and keep a null vector."""
    given = embed_input(modality)
    wanted = given if only is None else F.when(only, given)
    run_model = embed.embed_frames if modality == "video" else embed.embed_text
    return manifest.withColumn("embedding", run_model(wanted, model))


def curate(
    manifest: DataFrame, vector_dim: int, threshold: float = dedup.THRESHOLD
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Gate, then exact and near dedup of one modality's manifest that carries
    ``embedding``: ``(gated, passed and unique ids, kept rows)``.

    Everything is marked; only the returned views leave rows out. Rows that
    carry their status from an earlier stage are not judged again. What stays
    is decided on keys and vectors, written out once; the wide rows are
    touched by a single semi join at the end.
    """
    judged = "quality_status" in manifest.columns
    gated = manifest if judged else quality.quality_gate(manifest)
    keys = quality.passed(gated).select("id", "idx", "sub_idx", "content_hash", "embedding")
    placed = dedup.exact_dedup(keys).select(
        "id", dedup.order_key().alias("pos"), "embedding"
    )
    unique = stage_table(placed, "unique")
    kept = dedup.near_dedup(unique, "pos", "embedding", vector_dim, threshold)
    return gated, unique, gated.join(kept.select("id"), "id", "left_semi")


def stage_connectors(run: Run, modality: str, force: bool = False) -> dict:
    path = run.layout.manifest(modality)
    rows = row_count(run.spark, path)
    if rows is not None and not force:
        return {"status": "skipped", "reason": "manifest already exists", "rows": rows}
    cat.publish(run.manifests[modality](), path)
    return {"status": "ok", "rows": row_count(run.spark, path)}


def stage_preprocessing(run: Run, modality: str, force: bool = False) -> dict:
    source, target = run.layout.manifest(modality), run.layout.embedded(modality)
    n_manifest, n_done = row_count(run.spark, source), row_count(run.spark, target)
    status, reason = embed_decision(n_manifest, n_done, force)
    if status == "skipped":
        return {"status": status, "reason": reason, "rows": n_done or 0}
    manifest = cat.published(run.spark, source)
    # The gate is cheap and the model is not: failing rows stay in the
    # artifact but are not embedded.
    gated = quality.quality_gate(run.probe(manifest))
    passing = F.col("quality_status") == "pass"
    embedded = embed_manifest(gated, modality, run.model(modality), passing)
    # The verdict stays in the artifact; later stages do not read texts for it.
    kept = embedded.select(*manifest.columns, "quality_status", "quality_reason", "embedding")
    cat.publish(kept, target)
    return {"status": "ok", "reason": reason, "rows": row_count(run.spark, target)}


def stage_quality(run: Run, modality: str, force: bool = False) -> dict:
    target = run.layout.filtered(modality)
    rows = row_count(run.spark, target)
    if rows is not None and not force:
        return {"status": "skipped", "reason": "filtered output already exists", "rows": rows}
    source = run.layout.embedded(modality)
    if row_count(run.spark, source) is None:
        return {"status": "skipped", "reason": "missing manifest", "rows": 0}
    embedded = cat.published(run.spark, source)
    if "quality_status" not in embedded.columns:
        embedded = run.probe(embedded)
    gated, unique, kept = curate(embedded, run.model(modality).dim, run.threshold)
    cat.publish(kept, target)
    final = row_count(run.spark, target)
    totals = quality.quality_report(gated).first()
    return {
        "status": "ok",
        "rows": final,
        "total": totals["total"],
        "passed": totals["passed"],
        "pass_rate": totals["pass_rate"],
        "near_duplicates_removed": unique.count() - final,
    }


def stage_catalog(run: Run, force: bool = True) -> dict:
    """Only the filtered artifacts of known names feed the catalog."""
    parts = []
    for modality in run.modalities:
        path = run.layout.filtered(modality)
        if row_count(run.spark, path) is None:
            continue
        rows = cat.published(run.spark, path)
        parts.append(
            cat.build_catalog(
                rows, text_dim=run.text_model.dim, clip_dim=run.clip_model.dim
            )
        )
    if not parts:
        empty = run.spark.createDataFrame([], schemas.CATALOG)
        cat.replace_catalog(empty, run.layout.catalog)
        return {"status": "ok", "rows": 0}
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    cat.replace_catalog(every, run.layout.catalog)
    return {"status": "ok", "rows": cat.read_catalog(run.spark, run.layout.catalog).count()}


def stage_version(run: Run, name: str) -> dict:
    catalog = cat.read_catalog(run.spark, run.layout.catalog)
    header = versions.create_version(catalog, run.layout.versions, name, run.modalities).first()
    return {"status": "ok", "rows": header["total_items"]}


def stage_shards(run: Run, name: str) -> dict:
    catalog = cat.read_catalog(run.spark, run.layout.catalog)
    items = versions.load_version(run.spark, run.layout.versions, name)
    listing = None if run.contents is None else run.contents().select(
        paths.local_part(F.col("path")).alias("path")
    )
    members = stage_table(shards.plan_members(items, catalog, run.shard_size, listing), "members")
    contents = None if run.contents is None else run.contents()
    shards.write_shards(members, run.layout.shards(name), items, contents, run.shard_size)
    manifest = shards.shard_manifest(items, members, run.shard_size)
    cat.publish(manifest, run.layout.shard_manifest(name))
    return {"status": "ok", "rows": row_count(run.spark, run.layout.shard_manifest(name))}


def stage_benchmark(run: Run, name: str) -> dict:
    import time

    path = run.layout.shards(name)
    if not tarshard.exists(run.spark, path):
        return {"status": "skipped", "reason": "no shards", "rows": 0}
    started = time.time()
    stats = shards.shard_stats(shards.read_shards(run.spark, path, records=False))
    measured = shards.loader_metrics(stats, 1.0)
    seconds = max(time.time() - started, 1e-9)
    rates = {
        "seconds": round(seconds, 2),
        "items_per_second": round(measured["items"] / seconds, 2),
        "mb_per_second": round(measured["mb_per_second"] / seconds, 2),
    }
    return {"status": "ok", "rows": measured["items"], **rates}


def resume(
    run: Run, stage: str, modality: str = "all", force: bool = False, version: str = "v001"
) -> list[dict]:
    """One stage, for one modality or for all of them. What it stages on the
    way is deleted when it ends."""
    with scratch(run.spark):
        return _resume(run, stage, modality, force, version)


def _resume(run: Run, stage: str, modality: str, force: bool, version: str) -> list[dict]:
    name, asked = stage_named(stage), modality.lower() or "all"
    if asked != "all" and asked not in run.modalities:
        raise ValueError(f"unknown modality {modality!r} for stage {name}")
    per_modality = {
        "connectors": stage_connectors,
        "preprocessing": stage_preprocessing,
        "quality": stage_quality,
    }
    if name in per_modality:
        chosen = run.modalities if asked == "all" else [asked]
        return [
            {"stage": name, "modality": m, **per_modality[name](run, m, force)} for m in chosen
        ]
    if name == "catalog":
        return [{"stage": name, "modality": "all", **stage_catalog(run)}]
    by_version = {"version": stage_version, "shards": stage_shards, "benchmark": stage_benchmark}
    return [{"stage": name, "modality": "all", **by_version[name](run, version)}]


def run_all(run: Run, version: str = "v001", force: bool = False) -> list[dict]:
    """All stages in order."""
    out: list[dict] = []
    for stage in STAGES:
        out += resume(run, stage, force=force, version=version)
    return out


def artifact_freshness(
    spark: SparkSession, artifacts: dict[str, str], made_from: dict[str, str]
) -> DataFrame:
    """``artifact, newest, stale``: when the newest file was written, and
    whether the artifact it was made from has a newer one. Files are listed,
    never opened."""

    def newest(path: str):
        if not cat.path_exists(spark, path):
            return None
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        )
        return files.agg(F.max("modificationTime")).first()[0]

    times = {name: newest(path) for name, path in artifacts.items()}

    def stale(name: str) -> bool:
        own, source = times[name], times.get(made_from.get(name, ""))
        return source is not None and (own is None or own < source)

    rows = [(name, times[name], stale(name)) for name in artifacts]
    return spark.createDataFrame(rows, "artifact string, newest timestamp, stale boolean")


def artifact_status(spark: SparkSession, artifacts: dict[str, str]) -> DataFrame:
    """``artifact, present, n_rows`` for every named parquet path."""
    rows = []
    for name, path in artifacts.items():
        n = row_count(spark, path)
        rows.append((name, n is not None, n or 0))
    return spark.createDataFrame(rows, "artifact string, present boolean, n_rows bigint")
