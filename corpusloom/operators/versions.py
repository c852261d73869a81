"""Dataset versions: immutable, ordered lists of catalog items."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas
from corpusloom.operators.catalog import path_exists
from corpusloom.operators.ranking import limit_per_group, with_position
from corpusloom.session import stage_table

# The models a version records by default.
MODELS = {
    "text": "sentence-transformers/all-MiniLM-L6-v2",
    "image": "openai/clip-vit-base-patch32",
    "video": "openai/clip-vit-base-patch32",
    "audio": "openai/whisper-small → projection",
}


def modality_order(c: Column, modalities: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(m) for m in modalities]), c).cast("int")


def select_items(
    catalog: DataFrame,
    name: str,
    modalities: list[str] | None = None,
    sources: list[str] | None = None,
    quality_filter: bool = True,
    limit_per_modality: int | None = None,
    exclude_sources: list[str] | None = None,
) -> DataFrame:
    """Items of a version in order: by modality as listed, then by id."""
    mods = modalities or schemas.MODALITIES
    chosen = catalog
    if sources:
        chosen = chosen.where(F.col("source").isin(sources))
    if exclude_sources:
        chosen = chosen.where(~F.col("source").isin(exclude_sources))
    if quality_filter:
        chosen = chosen.where(F.col("quality_status") == "pass")
    chosen = chosen.select("id", "modality", "source", "content_hash")
    chosen = limit_per_group(chosen, "modality", mods, ["id"], limit_per_modality)
    # Ranking reads its input twice (once to find the ranges), so the narrow
    # rows are written out first and the catalog is gone through once.
    narrow = stage_table(chosen, "chosen")
    ordered = narrow.withColumn("_m", modality_order(F.col("modality"), mods))
    placed = with_position(ordered, "_m", "id")
    return placed.select(F.lit(name).alias("version"), *schemas.VERSION_ITEMS.fieldNames()[1:])


def modality_counts(items: DataFrame, modalities: list[str]) -> DataFrame:
    """Items per requested modality, zeros included."""
    spark = items.sparkSession
    wanted = spark.createDataFrame([(m,) for m in modalities], "modality string")
    counts = items.groupBy("modality").agg(F.count("*").alias("n"))
    return wanted.join(counts, "modality", "left").select(
        "modality", F.coalesce("n", F.lit(0)).alias("n_items")
    )


def schema_hash(schema) -> str:
    import hashlib

    return hashlib.sha256(schema.json().encode()).hexdigest()


def _paths(root: str, name: str) -> tuple[str, str]:
    base = f"{root.rstrip('/')}/{name}"
    return f"{base}/items", f"{base}/header"


def content_fingerprint(rows: DataFrame) -> DataFrame:
    """``n_rows, fingerprint``: what a table holds, whatever the order of its rows,
    files and columns.

    Each row is hashed over its columns in order of name, with their lengths, so that
    no two rows read alike; the fingerprint is the sum of the hashes, in which copies
    count. Sums meet in any order, so nothing is sorted and only sums are shuffled.
    """
    parts = []
    for field in sorted(rows.schema.fields, key=lambda f: f.name):
        value = F.col(f"`{field.name}`")
        nested = not isinstance(field.dataType, T.AtomicType)
        value = F.to_json(F.struct(value)) if nested else value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("n")))
    mark = F.conv(F.substring(F.sha2(F.concat(F.lit(""), *parts), 256), 1, 15), 16, 10)
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(mark.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("fingerprint"),
    )


def pinned_inputs(inputs: dict[str, DataFrame]) -> dict[str, dict]:
    """Rows and fingerprint of each input of a version, by the name of its table."""
    found = {name: content_fingerprint(rows).first() for name, rows in sorted(inputs.items())}
    return {n: {"rows": r["n_rows"], "fingerprint": r["fingerprint"]} for n, r in found.items()}


def create_version(
    catalog: DataFrame,
    root: str,
    name: str,
    modalities: list[str] | None = None,
    sources: list[str] | None = None,
    quality_filter: bool = True,
    limit_per_modality: int | None = None,
    exclude_sources: list[str] | None = None,
    config: dict[str, Any] | None = None,
    models: dict[str, str] | None = None,
    inputs: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Write a version and return its one-row header.

    A version never changes: creating an existing name again is an error
    unless it would come out identical. ``inputs`` are the tables it was made from:
    their names and the fingerprints of their content are pinned with it, so a name
    is refused as well when an input has changed since.
    """
    spark = catalog.sparkSession
    mods = modalities or schemas.MODALITIES
    items = select_items(
        catalog, name, mods, sources, quality_filter, limit_per_modality, exclude_sources
    )
    pinned = json.dumps(
        {
            "modalities": mods,
            "sources": sources,
            "exclude_sources": exclude_sources,
            "quality_filter": quality_filter,
            "limit_per_modality": limit_per_modality,
            "models": models or MODELS,
            "transforms": config or {},
            # Versions that pin none read as they always did.
            **({"inputs": pinned_inputs(inputs)} if inputs else {}),
        },
        sort_keys=True,
    )
    items_path, header_path = _paths(root, name)
    header = version_header(items, name, mods, pinned, models or MODELS)
    if path_exists(spark, header_path):
        old = read_header(spark, root, name)
        says = ["total_items", "config", "schema_hash", "items_fingerprint"]
        if old.select(*says).first() == header.select(*says).first():
            return old
        raise FileExistsError(f"version {name!r} exists and differs")
    items.write.mode("overwrite").parquet(items_path)
    # The header goes last: a version without one does not exist yet.
    header.write.json(header_path)
    return read_header(spark, root, name)


def version_header(
    items: DataFrame, name: str, modalities: list[str], config: str, models: dict[str, str]
) -> DataFrame:
    """One row: counts, models, configuration and a fingerprint of the items."""
    per = [
        F.count_if(F.col("modality") == m).cast("long").alias(m) for m in modalities
    ]
    mark = F.xxhash64("pos", "id", "content_hash").cast("decimal(38,0)")
    return items.agg(
        F.count("*").alias("total_items"),
        F.struct(*per).alias("modalities"),
        F.coalesce(F.sum(mark), F.lit(0)).cast("string").alias("items_fingerprint"),
    ).select(
        F.lit(name).alias("version"),
        "total_items",
        "modalities",
        F.struct(*[F.lit(v).alias(m) for m, v in models.items()]).alias("models"),
        F.lit(config).alias("config"),
        F.lit(schema_hash(schemas.CATALOG)).alias("schema_hash"),
        "items_fingerprint",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("created_at"),
    )


def read_header(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The one-row JSON header; the file is a few hundred bytes."""
    return spark.read.json(_paths(root, name)[1]).select(
        "version",
        "total_items",
        "modalities",
        "models",
        "config",
        "schema_hash",
        "items_fingerprint",
        "created_at",
    )


def load_version(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Items of a version; an unknown name is an error."""
    items_path, header_path = _paths(root, name)
    if not path_exists(spark, header_path):
        raise FileNotFoundError(f"version {name!r} not found under {root}")
    return spark.read.schema(schemas.VERSION_ITEMS).parquet(items_path)


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    """Names of the versions under ``root``, sorted."""
    headers = spark.read.json(f"{root.rstrip('/')}/*/header")
    return headers.select("version").distinct().orderBy("version")


def compare_versions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Items per modality in two versions and the difference."""

    def counts(items: DataFrame, name: str) -> DataFrame:
        return items.groupBy("modality").agg(F.count("*").alias(name))

    both = counts(a, "n_a").join(counts(b, "n_b"), "modality", "full")
    n_a, n_b = F.coalesce("n_a", F.lit(0)), F.coalesce("n_b", F.lit(0))
    return both.select(
        "modality", n_a.alias("n_a"), n_b.alias("n_b"), (n_b - n_a).alias("delta")
    )


def version_report(items: DataFrame, catalog: DataFrame) -> DataFrame:
    """``metric, key, value``: items per modality, source and licence, and the
    share of each modality of the catalog that the version leaves out."""
    held = items.select("id").join(catalog.select("id", "modality", "source", "license"), "id")
    facts = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.col(c).alias("key"))
            for c in ("modality", "source", "license")
        ]
    )
    counts = held.select(F.inline(facts)).groupBy("metric", "key").agg(
        F.count("*").cast("double").alias("value")
    )
    whole = catalog.groupBy(F.col("modality").alias("key")).agg(F.count("*").alias("n"))
    own = counts.where("metric = 'modality'").select("key", "value")
    rates = whole.join(own, "key", "left").select(
        F.lit("drop_rate").alias("metric"),
        "key",
        F.round(1 - F.coalesce("value", F.lit(0.0)) / F.col("n"), 6).alias("value"),
    )
    return counts.unionByName(rates)


def compare_reports(a: DataFrame, b: DataFrame, catalog: DataFrame) -> DataFrame:
    """``metric, key, a, b, delta`` of the reports of two versions."""
    first = version_report(a, catalog).withColumnRenamed("value", "a")
    second = version_report(b, catalog).withColumnRenamed("value", "b")
    in_a, in_b = F.coalesce("a", F.lit(0.0)), F.coalesce("b", F.lit(0.0))
    return first.join(second, ["metric", "key"], "full").select(
        "metric", "key", in_a.alias("a"), in_b.alias("b"), F.round(in_b - in_a, 6).alias("delta")
    )


def diff_versions(a: DataFrame, b: DataFrame) -> DataFrame:
    """``id, change``: added, removed, changed (other content) or common."""
    old = a.select("id", F.col("content_hash").alias("old"))
    new = b.select("id", F.col("content_hash").alias("new"))
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(F.col("old") != F.col("new"), "changed")
        .otherwise("common")
    )
    return old.join(new, "id", "full").select("id", change.alias("change"))


def _hash_number(c: Column, digits: int) -> Column:
    """The first hex digits of the SHA-256 as a number."""
    return F.conv(F.substring(F.sha2(c, 256), 1, digits), 16, 10).cast("long")


def train_eval_split(items: DataFrame, eval_ratio: float = 0.1) -> DataFrame:
    """Add ``split`` from a hash of the id: the same on every run, whatever
    else is in the table.

    The first 32 bits fall into ten thousand even buckets. Modalities are
    split independently, and one too small to get an eval row that way gives
    the row with the smallest hash. The lookup of those is broadcast: it has
    one row for each of the four modalities.
    """
    cut = int(round(eval_ratio * 10000))
    placed = items.withColumn("_hash", _hash_number(F.col("id"), 15))
    known = placed.where(F.col("modality").isin(schemas.MODALITIES))
    smallest = known.groupBy("modality").agg(F.min("_hash").alias("_first"))
    joined = placed.join(F.broadcast(smallest), "modality", "left")
    is_first = F.coalesce(F.col("_first") == F.col("_hash"), F.lit(False)) & F.lit(cut > 0)
    chosen = (_hash_number(F.col("id"), 8) % 10000 < cut) | is_first
    split = F.when(chosen, "eval").otherwise("train")
    return joined.withColumn("split", split).drop("_hash", "_first")


def split_report(split: DataFrame) -> DataFrame:
    return split.groupBy("modality", "split").agg(F.count("*").alias("n_items"))


def epoch_order(
    items: DataFrame, seed: int, epoch: int, key: str = "id", resume_at: int = 0
) -> DataFrame:
    """Items in the shuffled order of an epoch, from position ``resume_at``.

    The order depends on seed, epoch and key alone, so a stopped epoch goes on
    where it was.
    """
    mixed = F.sha2(F.concat(F.lit(f"{seed}:{epoch}:"), F.col(key).cast("string")), 256)
    keys = stage_table(items.select(key), "keys")
    placed = with_position(keys.withColumn("_mixed", mixed), "_mixed", key, name="epoch_pos")
    return placed.where(F.col("epoch_pos") >= resume_at).select(key, "epoch_pos")
