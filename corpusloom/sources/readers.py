"""Scans: declared-schema parquet, single tables and binary assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas
from corpusloom.functions import paths, text


def read_artifact(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet with a declared schema: no inference pass over the files."""
    return spark.read.schema(schema).parquet(path)


def read_manifest(spark: SparkSession, *locations: str) -> DataFrame:
    return spark.read.schema(schemas.MANIFEST).parquet(*locations)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder that holds ``<name>.parquet`` per table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly work on a small input.

    A file with one row group is one task. Only an input with fewer tasks than
    cores is redistributed; a large one has more and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if n_tasks(df) >= cores else df.repartition(cores)


def spread_rows(df: DataFrame) -> DataFrame:
    """Deal out narrow rows of which much is made each.

    A file is split by its bytes, but one task reads all rows of a row group: a
    narrow table can have many tasks of which one has all rows.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, n_tasks(df)))


def n_tasks(df: DataFrame) -> int:
    """How many tasks compute ``df``."""
    return df._jdf.queryExecution().toRdd().getNumPartitions()


def asset_listing(
    spark: SparkSession, root: str, glob: str = "*", with_hash: bool = False
) -> DataFrame:
    """Every file below ``root``: path, length and, if asked, its SHA-256.

    Without the hash the ``content`` column is pruned, so files are listed
    but never opened.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
    )
    # Local paths carry a scheme that manifests do not.
    plain = F.regexp_replace("path", "^file:/+", "/")
    cols: list[Column] = [plain.alias("path"), F.col("length")]
    if with_hash:
        cols.append(text.content_hash(F.col("content")).alias("content_hash"))
    return files.select(*cols)


def stored_hashes(listing: DataFrame) -> DataFrame:
    """Hashes present in a content-addressed store, from its file names."""
    name = F.regexp_extract("path", r"([0-9a-f]{64})(\.[^./]*)?$", 1)
    return listing.select(
        name.alias("content_hash"), paths.suffix(F.col("path")).alias("ext"), "path"
    ).where(F.col("content_hash") != "")
