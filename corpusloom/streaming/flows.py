"""Streaming forms. Each runs until the present input is used up, or with
``trigger={"processingTime": "1 minute"}`` for as long as files arrive.

``progress`` is where a flow remembers what it has taken in; started again
with the same one it goes on from there, and without one it starts afresh in
the shared folder. Batch outputs are written per
batch id, so a batch that is run again after a failure replaces its own
output instead of adding to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corpusloom import schemas
from corpusloom.operators import dedup, kept_store
from corpusloom.session import discard, fresh_path, list_folder, move, scratch


UNTIL_DONE = {"availableNow": True}


def arrivals(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    glob: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _start(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    progress: str | None,
    trigger: dict | None = None,
) -> StreamingQuery:
    at = progress or fresh_path(stream.sparkSession, "progress")
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", at)
        .trigger(**(trigger or UNTIL_DONE))
        .start()
    )


def run(query: StreamingQuery) -> None:
    """Wait for the end and raise what went wrong."""
    query.awaitTermination()


def _batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def append_to_catalog(
    stream: DataFrame,
    to_catalog: Callable[[DataFrame], DataFrame],
    path: str,
    progress: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Turn every batch of raw rows into catalog rows and add them."""

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = to_catalog(batch).select(*schemas.CATALOG.fieldNames())
        rows.write.mode("overwrite").parquet(_batch_path(path, batch_id))

    return _start(stream, each, progress, trigger)


def read_appended(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All batches written so far."""
    return spark.read.schema(schema or schemas.CATALOG).parquet(path)


def first_by_hash(
    stream: DataFrame,
    path: str,
    order: str = "idx",
    progress: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Smallest ``order`` per content hash, whatever order rows arrive in.

    A batch adds its own minima to the table at ``path``; no state is held, and
    ``compact_firsts`` keeps the table as small as the number of hashes.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        first = batch.groupBy("content_hash").agg(F.min(order).alias("first_idx"))
        first.write.mode("overwrite").parquet(_batch_path(path, batch_id))

    return _start(stream, each, progress, trigger)


def read_firsts(spark: SparkSession, path: str) -> DataFrame:
    """The current first row of every hash: later updates only lower it."""
    updates = spark.read.schema("content_hash string, first_idx bigint").parquet(path)
    return updates.groupBy("content_hash").agg(F.min("first_idx").alias("first_idx"))


def compact_firsts(spark: SparkSession, path: str) -> None:
    """Fold what the batches added into one part, between two runs of a flow.

    The folded part is written first and the old ones go then; if that is cut
    off, minima stand twice, which changes no result.
    """
    old = [p for p in list_folder(spark, path) if "batch_id=" in p]
    if len(old) < 2:
        return
    last = max(int(p.rsplit("batch_id=", 1)[1]) for p in old)
    folded = f"{path.rstrip('/')}.folded-{last}"
    read_firsts(spark, path).write.mode("overwrite").parquet(folded)
    move(spark, folded, _batch_path(path, -1 - last))
    for part in old:
        discard(spark, part)


def near_dedup_stream(
    stream: DataFrame,
    pos: str,
    vec: str,
    dim: int,
    path: str,
    threshold: float = dedup.THRESHOLD,
    progress: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep what is not similar to anything kept before.

    Batches are decided in turn against the store of kept vectors at ``path``
    (``kept_store``), of which each reads only the cells it can reach. A batch reads
    the batches before it, so that running it again decides it the same way.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        with scratch(session):
            kept_store.KeptStore(session, path, dim, threshold).add(batch, batch_id, pos, vec)

    return _start(stream, each, progress, trigger)


def read_kept(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """``pos, vec, batch_id`` of what a near-dedup flow has kept so far."""
    return kept_store.KeptStore(spark, path, dim).kept()


def window_counts(
    stream: DataFrame,
    ts: str,
    path: str,
    width: str,
    by: list[Column],
    progress: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Rows and newest timestamp per time window and group.

    A batch adds its own counts to the table at ``path``; no state is held and
    no watermark leaves rows out, so a late row counts like any other.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn(ts, F.col(ts).cast("timestamp"))
        counted = timed.groupBy(F.window(ts, width), *by).agg(
            F.count("*").alias("n_rows"), F.max(ts).alias("newest")
        )
        rows = counted.withColumn("window_start", F.col("window.start")).drop("window")
        rows.write.mode("overwrite").parquet(_batch_path(path, batch_id))

    return _start(stream, each, progress, trigger)


def read_windows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Rows and newest timestamp of every window over all batches."""
    return spark.read.parquet(path).groupBy("window_start", *keys).agg(
        F.sum("n_rows").alias("n_rows"), F.max("newest").alias("newest")
    )
