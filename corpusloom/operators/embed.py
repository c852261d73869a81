"""Batch embedding through a pluggable model, pooling and the vector cache.

A model is a small frozen dataclass: its fields say which model it is, and
``load()`` builds the callable ``list[str] -> matrix``. Loading happens once
per Python worker and is reused by every later task on that worker; only the
one input column crosses into Python.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas
from corpusloom.functions import vectors
from corpusloom.operators.ranking import first_per_key, salted_lookup
from corpusloom.session import stage_table

Encode = Callable[[list[str]], np.ndarray]

# Words of which a worker holds the place, and the longest of them: some 10 MB.
_WORDS_HELD = 65_536
_WORD_CHARS = 64


class _Places(dict):
    """The component of each word, from ``dim`` on where its sign is minus.

    The words seen first are held, which are mostly the frequent ones. Others and
    long ones are hashed again, so that no vocabulary fills a worker."""

    def __init__(self, dim: int) -> None:
        self.dim = dim

    def __missing__(self, word: str) -> int:
        digest = hashlib.md5(word.encode()).digest()
        found = int.from_bytes(digest[:4], "big") % self.dim
        found += 0 if digest[4] < 128 else self.dim
        if len(self) < _WORDS_HELD and len(word) <= _WORD_CHARS:
            self[word] = found
        return found


@dataclass(frozen=True)
class HashingModel:
    """Deterministic stand-in for a learned model: signed word counts, unit
    length. A word's MD5 picks its component (first 8 hex digits modulo
    ``dim``) and its sign (ninth digit below 8: plus)."""

    dim: int = vectors.TEXT_DIM
    name: str = "hashing"

    def load(self) -> Encode:
        places = _Places(self.dim)

        def encode(texts: list[str]) -> np.ndarray:
            sizes = []

            def spots() -> Iterator[int]:
                for text in texts:
                    words = text.split()
                    sizes.append(len(words))
                    yield from map(places.__getitem__, words)

            at = np.fromiter(spots(), np.int64)
            at += np.repeat(np.arange(len(texts)) * 2 * self.dim, sizes)
            signed = np.bincount(at, minlength=len(texts) * 2 * self.dim)
            signed = signed.reshape(len(texts), 2, self.dim)
            return vectors.unit_rows((signed[:, 0] - signed[:, 1]).astype(np.float64))

        return encode


_LOADED: dict[Any, Encode] = {}


def _warm(model: Any) -> Encode:
    """The loaded model of this worker process."""
    if model not in _LOADED:
        _LOADED[model] = model.load()
    return _LOADED[model]


def _encode_chunks(encode: Encode, texts: list[str], size: int, dim: int) -> np.ndarray:
    parts = [encode(texts[i : i + size]) for i in range(0, len(texts), size)]
    return np.vstack(parts) if parts else np.empty((0, dim))


def _slices(batches: Iterator[pa.Array], size: int) -> Iterator[pa.Array]:
    """The rows of Arrow batches, ``size`` at a time. A batch may hold ten thousand
    texts; Python sees a few of them at once, and so does what takes the vectors."""
    for batch in batches:
        for at in range(0, len(batch), size):
            yield batch.slice(at, size)
        if not len(batch):
            yield batch


def _vector_list(rows: np.ndarray, known: np.ndarray) -> pa.Array:
    """One list per row of ``known``, null where it is false; ``rows`` are the others."""
    ends = np.r_[0, np.cumsum(known) * rows.shape[1]].astype(np.int32)
    values = pa.array(rows.astype(np.float32).ravel())
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array(~known))


def embed_text(c: Column, model: Any, batch_size: int = 128) -> Column:
    """Vector of a text column; null text gives null.

    Declared non-deterministic, because the optimizer copies a deterministic
    call into every filter on its result and the model would run again for
    each. Filters belong before embedding.
    """

    @F.arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _warm(model)
        for part in _slices(batches, batch_size):
            texts = part.drop_null().to_pylist()
            rows = encode(texts) if texts else np.empty((0, model.dim))
            yield _vector_list(rows, part.is_valid().to_numpy(zero_copy_only=False))

    return run.asNondeterministic()(c)


def embed_frames(c: Column, model: Any, batch_size: int = 128) -> Column:
    """Mean vector of a list column (the frames of a clip); an empty list
    gives null. Frames are flattened into model batches and pooled in the
    same task, so a clip's frames are never shuffled."""

    @F.arrow_udf("array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = _warm(model)
        for part in _slices(batches, batch_size):
            lists = [x or [] for x in part.to_pylist()]
            means = list(_frame_means(encode, lists, batch_size, model.dim))
            known = np.array([len(frames) > 0 for frames in lists], bool)
            yield _vector_list(np.array(means).reshape(-1, model.dim), known)

    return run.asNondeterministic()(c)


def _frame_means(
    encode: Encode, lists: list[list[str]], size: int, dim: int
) -> Iterator[np.ndarray]:
    """Mean vector per list that is not empty. Lists share model batches of ``size``
    frames; of a list that goes over several only its sum is held."""
    flat = (frame for frames in lists for frame in frames)
    rows = np.empty((0, dim))
    for frames in lists:
        missing, total = len(frames), np.zeros((0, dim))
        while missing:
            if not len(rows):
                rows = encode(list(islice(flat, size)))
            part, rows = rows[:missing], rows[missing:]
            missing -= len(part)
            # One row after the other, as the sum of the whole list would be.
            total = np.concatenate([total, part]).sum(axis=0, keepdims=True)
        if frames:
            yield total[0] / len(frames)


def embed_batches(
    df: DataFrame,
    model: Any,
    in_col: str,
    out_col: str = "embedding",
    batch_size: int = 128,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``out_col``. ``partitions`` sets how many workers may run at once;
    left out, the input's own partitioning is used and nothing is shuffled."""
    spread = df if partitions is None else df.repartition(partitions)
    return spread.withColumn(out_col, embed_text(F.col(in_col), model, batch_size))


def embed_on(
    df: DataFrame, model: Any, in_col: str, out_col: str, profile, batch_size: int = 128
) -> DataFrame:
    """``embed_batches`` on executors of a resource profile (GPUs, memory).

    Whole rows pass through Python here, because only a map over rows can ask
    for a profile; select the columns needed first.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _warm(model)
        for batch in batches:
            rows = _encode_chunks(encode, batch[in_col].fillna("").tolist(), batch_size, model.dim)
            found = pd.Series(list(rows.astype(np.float32)), index=batch.index, dtype=object)
            yield batch.assign(**{out_col: found.where(batch[in_col].notna(), None)})

    schema = T.StructType([*df.schema, T.StructField(out_col, schemas.VECTOR)])
    return df.mapInPandas(run, schema, profile=profile)


def run_embed(
    manifest: DataFrame, out_path: str, model: Any, in_col: str, batch_size: int = 128
) -> dict[str, float]:
    """Embed and write, counting rows while they are written."""
    seen = Observation()
    started = time.time()
    embedded = embed_batches(manifest, model, in_col, batch_size=batch_size)
    counted = embedded.observe(
        seen, F.count("*").alias("n_rows"), F.count("embedding").alias("embedded")
    )
    counted.write.mode("overwrite").parquet(out_path)
    seconds = time.time() - started
    n_rows = seen.get["n_rows"]
    return {
        "rows": n_rows,
        "embedded": seen.get["embedded"],
        "seconds": round(seconds, 2),
        "rows_per_second": round(n_rows / seconds, 2),
    }


def embed_metrics(embedded: DataFrame, by: str = "modality") -> DataFrame:
    """Rows, rows with a vector and the vector length, per group."""
    return embedded.groupBy(by).agg(
        F.count("*").alias("n_rows"),
        F.count("embedding").alias("embedded"),
        F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("dim"),
    )


def _sums(group: str, in_order: bool = False):
    """Vector sums per group of ``total, n`` rows. Rows in order of the group
    give one row per group; others give one per group and 4096 groups."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[Any, tuple[np.ndarray, int]] = {}
        for batch in batches:
            for key, rows in batch.groupby(group, sort=False):
                m = np.vstack(rows["total"].to_numpy()).astype(np.float64)
                total, n = totals.pop(key, (0.0, 0))
                totals[key] = (total + m.sum(axis=0), n + int(rows["n"].sum()))
            # Groups are usually close together; do not hold all of them.
            if len(totals) > 4096:
                last = {key: totals.pop(key)} if in_order else {}
                yield _sums_frame(group, totals)
                totals = last
        if totals:
            yield _sums_frame(group, totals)

    return run


def _sums_frame(group: str, totals: dict) -> pd.DataFrame:
    return pd.DataFrame(
        {
            group: list(totals),
            "total": [t for t, _ in totals.values()],
            "n": [n for _, n in totals.values()],
        }
    )


def mean_pool(df: DataFrame, group: str, vec: str, out: str = "pooled") -> DataFrame:
    """Mean vector per group.

    Vectors are summed inside each task first, so what is shuffled is one row
    per group and task, however many vectors a group has; those are summed the
    same way where they meet.
    """
    kind = df.schema[group].dataType.simpleString()
    schema = f"`{group}` {kind}, total array<double>, n bigint"
    known = df.where(F.col(group).isNotNull() & (F.size(vec) > 0))
    one = known.select(group, F.col(vec).alias("total"), F.lit(1).cast("bigint").alias("n"))
    partial = one.mapInPandas(_sums(group), schema)
    met = partial.repartition(group).sortWithinPartitions(group)
    return met.mapInPandas(_sums(group, in_order=True), schema).select(
        group,
        F.transform("total", lambda x: x / F.col("n")).alias(out),
        F.col("n").alias("n_vectors"),
    )


def projection_matrix(rows: int, cols: int, seed: int = 0) -> np.ndarray:
    """Fixed pseudo-random weights in ±1/sqrt(rows), the same on every worker."""
    i, j = np.meshgrid(np.arange(rows), np.arange(cols), indexing="ij")
    mixed = (i * 7919 + j * 104729 + i * j * 31 + seed * 1299709) % 65537
    return (2.0 * mixed / 65537.0 - 1.0) / np.sqrt(rows)


def project(c: Column, in_dim: int, out_dim: int, seed: int = 0) -> Column:
    """Linear map to ``out_dim`` components; other lengths give null."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = projection_matrix(in_dim, out_dim, seed)
        for batch in batches:
            fits = np.array([v is not None and len(v) == in_dim for v in batch])
            out = pd.Series([None] * len(batch), dtype=object)
            mapped = vectors.matrix(batch[fits], in_dim) @ weights
            for at, row in zip(np.flatnonzero(fits), mapped):
                out.iat[at] = row
            yield out

    return run(c)


def mean_over_time(frames: Column, dim: int) -> Column:
    """Mean of a list of equal-length vectors (the time axis of audio)."""
    zeros = F.array_repeat(F.lit(0.0), dim)
    total = F.aggregate(
        frames, zeros, lambda s, v: F.zip_with(s, v.cast("array<double>"), lambda a, b: a + b)
    )
    return F.when(F.size(frames) > 0, F.transform(total, lambda x: x / F.size(frames)))


def model_version(modality: Column, number: int = 1) -> Column:
    """The stamp cached vectors carry, such as ``text_v001``."""
    return F.concat(modality, F.lit(f"_v{number:03d}"))


def cache_misses(manifest: DataFrame, cache: DataFrame, version: int = 1) -> DataFrame:
    """One row per content hash that has no vector of this model version."""
    stamped = manifest.withColumn("model_version", model_version(F.col("modality"), version))
    wanted = first_per_key(stamped, ["content_hash", "model_version"], ["idx", "sub_idx", "id"])
    return wanted.join(
        cache.select("content_hash", "model_version"),
        ["content_hash", "model_version"],
        "left_anti",
    )


def embed_with_cache(
    manifest: DataFrame, cache: DataFrame, model: Any, in_col: str, version: int = 1
) -> tuple[DataFrame, DataFrame]:
    """``(vectors by id, new cache rows)``.

    Each distinct content is embedded at most once; vectors of another model
    version are never used. The new rows are written out before they are used
    twice, so the model runs once. Of the cache only wanted rows are ranked,
    and a content with very many rows is looked up in many tasks.
    """
    keys = ["content_hash", "model_version"]
    misses = cache_misses(manifest, cache, version)
    computed = embed_batches(misses.withColumn("_in", F.col(in_col)), model, "_in")
    columns = schemas.EMBEDDING_CACHE.fieldNames()
    fresh = stage_table(computed.select(*columns), "embeddings")
    wanted = manifest.select(
        "id",
        "content_hash",
        model_version(F.col("modality"), version).alias("model_version"),
    )
    used = cache.select(*columns).join(wanted.select(*keys).distinct(), keys, "left_semi")
    known = first_per_key(used, keys, ["modality"])
    every = known.withColumn("cached", F.lit(True)).unionByName(
        fresh.withColumn("cached", F.lit(False))
    )
    found = salted_lookup(wanted, every.select(*keys, "embedding", "cached"), keys, "id")
    return found.where(F.col("cached").isNotNull()), fresh


def embed_through_cache(
    manifest: DataFrame, path: str, model: Any, in_col: str, version: int = 1
) -> DataFrame:
    """Vectors by id from the cache table at ``path``, which is created when it
    is missing and gets what it did not hold. Running again computes nothing."""
    spark = manifest.sparkSession
    spark.createDataFrame([], schemas.EMBEDDING_CACHE).write.mode("append").parquet(path)
    cache = spark.read.schema(schemas.EMBEDDING_CACHE).parquet(path)
    found, fresh = embed_with_cache(manifest, cache, model, in_col, version)
    found = stage_table(found, "found-vectors")
    fresh.write.mode("append").parquet(path)
    return found


def enrich(df: DataFrame, model: Any, in_col: str, out_col: str, keep: list[str]) -> DataFrame:
    """A copy with a further feature column, reduced to the exported columns."""
    return embed_batches(df, model, in_col, out_col).select(*keep, out_col)
