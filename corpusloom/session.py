"""Session defaults and the shared folder for cut lineage.

Executors come and go, so nothing here relies on executor-local storage:
intermediate tables go to the folder that ``spark.checkpoint.dir`` names, and
a lost executor only costs the tasks it was running.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "corpusloom", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Texts differ in length by orders of magnitude; bound batches by size.
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per session.

    Functions that run in tasks are sent by name, so the executors need the
    package itself wherever the driver was started from.
    """
    context = spark.sparkContext
    if getattr(context, "_corpusloom_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._corpusloom_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local-mode session may fall back to a folder of its own; on a
    cluster a missing setting is an error rather than a machine-local path.
    """
    inner = getattr(spark.sparkContext, "_corpusloom_scratch", [])
    if inner:
        return inner[-1]
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context = spark.sparkContext
    if not hasattr(context, "_corpusloom_folder"):
        context._corpusloom_folder = tempfile.mkdtemp(prefix="corpusloom-")
    return context._corpusloom_folder


@contextmanager
def scratch(spark: SparkSession):
    """Tables staged inside are deleted at the end, so that work which ends with
    a written result leaves nothing else in the shared folder."""
    path = fresh_path(spark, "scratch")
    context = spark.sparkContext
    if not hasattr(context, "_corpusloom_scratch"):
        context._corpusloom_scratch = []
    context._corpusloom_scratch.append(path)
    try:
        yield path
    finally:
        context._corpusloom_scratch.remove(path)
        discard(spark, path)


def release(spark: SparkSession) -> None:
    """Let the driver give back what finished plans hold.

    Spark drops broadcasts, shuffles and generated classes once the driver's JVM has
    collected what named them. With little in use that seldom happens by itself: the
    heap grows to its limit and generated classes pile up beside it.
    """
    spark._jvm.System.gc()


def fresh_name(label: str) -> str:
    """A name that nothing else has."""
    return f"{label}-{uuid.uuid4().hex}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{fresh_name(label)}"


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The plan is computed a single time, survives executor loss, and later
    reads get parquet column pruning and row-group skipping.
    """
    return stage_at(df, fresh_path(df.sparkSession, label))


def stage_at(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """``stage_table`` under a path the caller will ``discard``."""
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """What stands directly in a folder; nothing when it is missing."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    return [str(x.getPath().toString()) for x in fs.listStatus(at)]


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename on the file system that ``source`` names, replacing ``target``."""
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = a.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(b):
        fs.delete(b, True)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"could not move {source} to {target}")
