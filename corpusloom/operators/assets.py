"""Content-addressed asset store: layout, what is missing, what is garbage."""

from __future__ import annotations

import shutil
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import paths
from corpusloom.operators.ranking import first_per_key


def cas_layout(manifest: DataFrame, root: str) -> DataFrame:
    """Where the asset of every file-backed row belongs: ``id, content_hash,
    src, dest``. Equal content has one destination."""
    content = F.col("payload.content")
    return (
        manifest.where((F.col("modality") != "text") & (content != ""))
        .withColumn("src", content)
        .select(
            "id",
            "content_hash",
            "src",
            paths.cas_path(root, F.col("content_hash"), paths.suffix(F.col("src"))).alias("dest"),
        )
    )


def cas_missing(layout: DataFrame, listing: DataFrame) -> DataFrame:
    """One copy per destination that the store does not hold yet."""
    wanted = first_per_key(layout, ["dest"], ["id"])
    held = listing.select(F.col("path").alias("dest"))
    return wanted.join(held, "dest", "left_anti")


def cas_get(layout: DataFrame, listing: DataFrame) -> DataFrame:
    """Layout rows with ``stored``: whether the blob is in the store."""
    held = listing.select(F.col("path").alias("dest")).distinct()
    held = held.withColumn("_held", F.lit(True))
    return layout.join(held, "dest", "left").withColumn(
        "stored", F.coalesce("_held", F.lit(False))
    ).drop("_held")


def _store(path: str):
    """File system and path for a plain path or a URI; one whose scheme is not
    known is an error."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _copy(rows: Iterator) -> None:
    for row in rows:
        (source, src), (target, dest) = _store(row.src), _store(row.dest)
        if source.get_file_info(src).type != fs.FileType.File:
            continue
        if target.get_file_info(dest).type != fs.FileType.NotFound:
            continue
        target.create_dir(dest.rpartition("/")[0], recursive=True)
        # A copy that is cut off must not look complete.
        partial = f"{dest}.{uuid.uuid4().hex}.part"
        with source.open_input_stream(src) as data, target.open_output_stream(partial) as out:
            shutil.copyfileobj(data, out, 1 << 20)
        target.move(partial, dest)


def cas_put(missing: DataFrame) -> None:
    """Copy the missing blobs, each task its share; repeating it is harmless."""
    missing.select("src", "dest").foreachPartition(_copy)


def use_cas_paths(manifest: DataFrame, root: str) -> DataFrame:
    """Point ``payload.content`` of file-backed rows into the store."""
    content = F.col("payload.content")
    stored = paths.cas_path(root, F.col("content_hash"), paths.suffix(content))
    backed = (F.col("modality") != "text") & (content != "")
    return manifest.withColumn(
        "payload",
        F.col("payload").withField("content", F.when(backed, stored).otherwise(content)),
    )


def cas_garbage(held: DataFrame, live_items: DataFrame) -> DataFrame:
    """Stored hashes that no live version refers to; these may be collected."""
    live = live_items.select("content_hash")
    return held.join(live, "content_hash", "left_anti")


def plan_precompute(listing: DataFrame, root: str, out_root: str, size: int = 224) -> DataFrame:
    """Target of every ``.jpg`` below ``root``, at the same relative path."""
    base = root.rstrip("/") + "/"
    relative = F.substring(F.col("path"), len(base) + 1, 1 << 30)
    return listing.where(
        F.col("path").startswith(base) & F.col("path").endswith(".jpg")
    ).select(
        F.col("path").alias("src"),
        F.concat(F.lit(out_root.rstrip("/") + "/"), relative).alias("dest"),
        F.lit(size).alias("width"),
        F.lit(size).alias("height"),
    )
