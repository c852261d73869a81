"""The unified catalog: one flat row per item, partitioned by modality."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom import schemas
from corpusloom.functions import licenses, paths, vectors
from corpusloom.operators import snapshots
from corpusloom.operators.ranking import first_per_key
from corpusloom.operators.search import CLIP_SPACE, TEXT_SPACE
from corpusloom.session import stage_table


def last_vectors(embedded: DataFrame) -> DataFrame:
    """The last vector of every id, by ``pos``."""
    named = embedded.where(F.col("embedding").isNotNull()).withColumn("_back", -F.col("pos"))
    return first_per_key(named, ["id"], ["_back"]).select("id", "embedding")


def build_catalog(
    manifest: DataFrame,
    embedded: DataFrame | None = None,
    text_dim: int = vectors.TEXT_DIM,
    clip_dim: int = vectors.CLIP_DIM,
) -> DataFrame:
    """Flatten manifest rows and attach their vectors (``id, embedding, pos``,
    or an ``embedding`` column the rows already carry).

    Rows without a vector of the right length get a zero vector and
    ``has_embedding`` false. The join is by id on both sides and is left to
    the optimizer: vectors grow with the data and are never broadcast by hand.
    """
    if embedded is not None:
        joined = manifest.drop("embedding").join(last_vectors(embedded), "id", "left")
    elif "embedding" in manifest.columns:
        joined = manifest
    else:
        joined = manifest.withColumn("embedding", F.lit(None).cast("array<float>"))
    modality = F.col("modality")
    as_text = F.when(modality.isin(TEXT_SPACE), F.col("embedding"))
    as_clip = F.when(modality.isin(CLIP_SPACE), F.col("embedding"))
    own = F.col("license") if "license" in manifest.columns else None
    status = (
        F.coalesce("quality_status", F.lit("unknown"))
        if "quality_status" in manifest.columns
        else F.lit("unknown")
    )
    return joined.select(
        "id",
        "source",
        "modality",
        "content_hash",
        status.alias("quality_status"),
        licenses.license_of(F.col("source"), own).alias("license"),
        F.coalesce("payload.caption", F.lit("")).alias("caption"),
        F.coalesce("payload.content", F.lit("")).alias("content_path"),
        F.coalesce(F.to_json("payload.metadata"), F.lit("{}")).alias("metadata_json"),
        vectors.sanitize(as_text, text_dim).alias("text_vector"),
        vectors.sanitize(as_clip, clip_dim).alias("clip_vector"),
        (vectors.has_dim(as_text, text_dim) | vectors.has_dim(as_clip, clip_dim)).alias(
            "has_embedding"
        ),
    )


def stage_catalog(
    catalog: DataFrame, text_dim: int = vectors.TEXT_DIM, clip_dim: int = vectors.CLIP_DIM
) -> DataFrame:
    """``stage_table`` of catalog rows, in which a zero vector is one bit.

    Every row has at least one, of more values than all its other columns. They are
    filled in where they are read; all other vectors, null ones too, are kept as given.
    """
    blank = {"text_vector": vectors.zeros(text_dim), "clip_vector": vectors.zeros(clip_dim)}
    marked = catalog.select(
        *[F.when(_differs(c, blank[c]), F.col(c)).alias(c) if c in blank else c for c in catalog.columns],
        *[(~_differs(c, zero)).alias(f"_no_{c}") for c, zero in blank.items()],
    )
    staged = stage_table(marked, "catalog")
    filled = {c: F.when(F.col(f"_no_{c}"), zero).otherwise(F.col(c)) for c, zero in blank.items()}
    return staged.withColumns(filled).select(*catalog.columns)


def _differs(column: str, zero: Column) -> Column:
    return F.coalesce(F.col(column) != zero, F.lit(True))


def tag_license(df: DataFrame) -> DataFrame:
    """Add ``license`` from the source; a licence already present is kept."""
    own = F.col("license") if "license" in df.columns else None
    return df.withColumn("license", licenses.license_of(F.col("source"), own))


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def publish(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace the table at ``path`` by a new snapshot of it (``snapshots``).

    Readers see the old table or the new one, whole, at every moment. The version
    before stays for readers that began with it, older ones go. An empty frame
    publishes an empty table, so no stale rows stay behind.
    """
    snapshots.replace(df, path, partition_by)
    snapshots.expire(df.sparkSession, path, keep=2)


def published(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table at ``path``, published or plain Parquet; None when it is missing."""
    if snapshots.current(spark, path) is not None:
        return snapshots.read(spark, path, schema)
    if not path_exists(spark, path) or path_exists(spark, f"{path}/parts"):
        return None  # nothing, or a first snapshot that is still being written
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def replace_catalog(catalog: DataFrame, path: str) -> None:
    publish(catalog.select(*schemas.CATALOG.fieldNames()), path, "modality")


def append_catalog(catalog: DataFrame, path: str) -> None:
    """Add rows, creating the table when it does not exist."""
    snapshots.append(catalog.select(*schemas.CATALOG.fieldNames()), path, "modality")


def read_catalog(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version of a catalog, or an earlier one that has not expired."""
    return snapshots.read(spark, path, schemas.CATALOG, version)


def query_catalog(
    catalog: DataFrame,
    modalities: list[str] | None = None,
    sources: list[str] | None = None,
    status: str | None = None,
    licenses_in: list[str] | None = None,
    where: Column | None = None,
    limit: int | None = 100,
) -> DataFrame:
    """Rows matching all given predicates, in order of id.

    The predicates are plain comparisons on columns, so the one on modality
    prunes partitions and the rest are pushed into the scan.
    """
    found = catalog
    for column, wanted in (
        ("modality", modalities),
        ("source", sources),
        ("license", licenses_in),
    ):
        if wanted:
            found = found.where(F.col(column).isin(wanted))
    if status:
        found = found.where(F.col("quality_status") == status)
    if where is not None:
        found = found.where(where)
    return found if limit is None else found.orderBy("id").limit(limit)


def lookup(catalog: DataFrame, item_id: str) -> DataFrame:
    """The rows of one id; an id with other characters is refused."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", item_id):
        raise ValueError(f"not an item id: {item_id!r}")
    return catalog.where(F.col("id") == item_id)


def servable(catalog: DataFrame) -> DataFrame:
    """What an asset request needs: id, path, URL and media type."""
    return catalog.where(
        paths.valid_id(F.col("id")) & (F.col("modality") != "text")
    ).select(
        "id",
        "modality",
        "content_path",
        paths.asset_url(F.col("id")).alias("asset_url"),
        paths.media_type(F.col("content_path")).alias("media_type"),
    )
