"""Tables as immutable snapshots behind a versioned pointer.

    <table>/parts/part=<name>/…            data, written once, never changed
    <table>/versions/0000000007.json       the parts of version 7

A writer adds its data beside everything else and then creates the next pointer.
Creating a file that must not exist yet is one step of the file system, so of two
writers that both saw version 6 exactly one makes version 7. Readers take the
highest complete pointer: there is a table at every moment, also while a writer is
at work or after one has died. Going back to an old version is a new pointer to its
parts.

Pointers are complete when they hold their whole text, whose last character closes
it; a file cut off by a crash is passed over, and its number stays used. On local
file systems a pointer appears with its content through a hard link, elsewhere by
the file system's own exclusive create. A store without one (plain object storage)
cannot keep two writers apart and needs a committer that can.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corpusloom.session import discard, fresh_name, list_folder

_DIGITS = 10
# Files that a task may write at a time: as many as there are modalities.
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_MOST_OPEN = 4


class Conflict(RuntimeError):
    """Another writer has made the next version."""


@dataclass(frozen=True)
class Version:
    """One state of a table: its number, what made it and the parts it reads."""

    number: int
    action: str
    parts: list[str]
    made_at: str
    note: dict


def _paths(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether this call made the file; False when it was there already."""
    fs, at = _paths(spark, path)
    fs.mkdirs(at.getParent())
    data = bytearray(text.encode())
    if fs.getScheme() == "file":
        # Hadoop's local file system looks before it writes, in two steps. A hard
        # link to a finished file either makes the name or fails.
        files, get = spark._jvm.java.nio.file.Files, spark._jvm.java.nio.file.Paths.get
        none = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)
        target = get(at.toUri().getPath(), none)
        beside = get(f"{at.getParent().toUri().getPath()}/.{fresh_name('new')}", none)
        options = spark.sparkContext._gateway.new_array(spark._jvm.java.nio.file.OpenOption, 0)
        files.write(beside, data, options)
        try:
            files.createLink(target, beside)
            return True
        except Exception as e:
            if files.exists(target, spark.sparkContext._gateway.new_array(
                spark._jvm.java.nio.file.LinkOption, 0)):
                return False
            raise OSError(f"could not create {path}") from e
        finally:
            files.deleteIfExists(beside)
    try:
        out = fs.create(at, False)
    except Exception as e:
        if fs.exists(at):
            return False
        raise OSError(f"could not create {path}") from e
    out.write(data)
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, at = _paths(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _pointer(path: str, number: int) -> str:
    return f"{path}/versions/{number:0{_DIGITS}d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = (p.rsplit("/", 1)[1] for p in list_folder(spark, f"{path}/versions"))
    found = (n.removesuffix(".json") for n in names if n.endswith(".json"))
    return sorted(int(n) for n in found if n.isdigit() and len(n) == _DIGITS)


def _version(spark: SparkSession, path: str, number: int) -> Version | None:
    """The version of a number; None where its pointer is not complete."""
    try:
        held = json.loads(read_text(spark, _pointer(path, number)))
    except ValueError:
        return None
    return Version(number, held["action"], held["parts"], held["made_at"], held["note"])


def _state(spark: SparkSession, path: str) -> tuple[int, Version | None]:
    """The highest number and the newest version, of one listing: what is made on
    top of both cannot miss a version made since."""
    numbers = _numbers(spark, path)
    for number in reversed(numbers):
        version = _version(spark, path, number)
        if version is not None:
            return numbers[-1], version
    return max(numbers, default=0), None


def current(spark: SparkSession, path: str) -> Version | None:
    """The newest version; None when there is no table yet."""
    return _state(spark, path)[1]


def history(spark: SparkSession, path: str) -> list[Version]:
    """All versions that can be read, oldest first."""
    found = (_version(spark, path, n) for n in _numbers(spark, path))
    return [v for v in found if v is not None]


def _commit(
    spark: SparkSession, path: str, action: str, parts: list[str], after: int, note: dict
) -> Version:
    """Version ``after + 1``, or a ``Conflict``."""
    held = {
        "action": action,
        "parts": parts,
        "made_at": datetime.now(timezone.utc).isoformat(timespec="seconds"),
        "note": note,
    }
    if not create_if_absent(spark, _pointer(path, after + 1), json.dumps(held)):
        raise Conflict(f"version {after + 1} of {path} was made by another writer")
    return Version(after + 1, **held)


def write_part(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write ``df`` as a part that no version reads yet; its name.

    A task writes a few partitions side by side; only one that meets more of them
    sorts its rows, which are wide, by partition first.
    """
    name = fresh_name("p")
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    conf = df.sparkSession.conf
    before = conf.get(_OPEN_FILES, None)
    conf.set(_OPEN_FILES, _MOST_OPEN)
    try:
        writer.parquet(f"{path}/parts/part={name}")
    finally:
        conf.unset(_OPEN_FILES) if before is None else conf.set(_OPEN_FILES, before)
    return name


def replace(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    expect: int | None = None,
    note: dict | None = None,
) -> Version:
    """A version with the rows of ``df`` and nothing else.

    With ``expect`` it is only made on top of that version (0: no table), else on
    top of the newest when writing ended. A writer that loses raises ``Conflict``
    and its part goes.
    """
    return _changed(df, path, partition_by, expect, note, "replace", keep=False)


def append(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    expect: int | None = None,
    note: dict | None = None,
) -> Version:
    """A version with the rows of ``df`` beside those of the version before it."""
    return _changed(df, path, partition_by, expect, note, "append", keep=True)


def _changed(df, path, partition_by, expect, note, action, keep) -> Version:
    spark = df.sparkSession
    part = write_part(df, path, partition_by)
    try:
        while True:
            number, before = _state(spark, path)
            if expect is not None and expect != (before.number if before else 0):
                raise Conflict(f"{path} is not at version {expect}")
            parts = [*before.parts, part] if keep and before else [part]
            try:
                return _commit(spark, path, action, parts, number, note or {})
            except Conflict:
                if expect is not None:
                    raise
                # Nothing was promised about what is replaced: try on top of it.
    except Exception:
        discard(spark, f"{path}/parts/part={part}")
        raise


def read(
    spark: SparkSession, path: str, schema: StructType | None = None, version: int | None = None
) -> DataFrame:
    """The rows of a version, by default the newest.

    A partition column of the table is a column of ``schema`` like any other.
    Without a schema it is taken from the files.
    """
    found = current(spark, path) if version is None else _version(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no version {version or ''} of a table at {path}")
    reader = spark.read.option("basePath", f"{path}/parts")
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.parquet(*[f"{path}/parts/part={p}" for p in found.parts])
    return rows.drop("part") if schema is None else rows.select(schema.names)


def roll_back(spark: SparkSession, path: str, version: int) -> Version:
    """A new version with the parts of an old one."""
    old = _version(spark, path, version)
    if old is None:
        raise FileNotFoundError(f"no version {version} of a table at {path}")
    missing = [p for p in old.parts if not list_folder(spark, f"{path}/parts/part={p}")]
    if missing:
        raise FileNotFoundError(f"version {version} of {path} has expired")
    number, _ = _state(spark, path)
    return _commit(spark, path, "roll back", old.parts, number, {"to": version})


def compact(
    spark: SparkSession, path: str, schema: StructType | None = None, partition_by: str | None = None
) -> Version:
    """The newest version's rows as one part. Raises ``Conflict`` when another
    writer made a version meanwhile; the table is then as that one left it."""
    before = current(spark, path)
    if before is None:
        raise FileNotFoundError(f"no table at {path}")
    rows = read(spark, path, schema, before.number)
    return replace(rows, path, partition_by, before.number, {"compacts": before.number})


def expire(spark: SparkSession, path: str, keep: int = 5, orphans: bool = False) -> list[str]:
    """Delete parts that only versions before the newest ``keep`` read; their names.

    With ``orphans`` also those that no version reads. These are of writers that
    died, or that are still at work: use it while nobody writes. Pointers stay, as
    a record.
    """
    if keep < 1:
        raise ValueError("the newest version is always kept")
    versions = history(spark, path)
    live = {p for v in versions[-keep:] for p in v.parts}
    at = f"{path}/parts"
    found = [p.rsplit("part=", 1)[1] for p in list_folder(spark, at) if "part=" in p]
    known = {p for v in versions for p in v.parts}
    gone = sorted(p for p in found if p not in live and (orphans or p in known))
    for part in gone:
        discard(spark, f"{at}/part={part}")
    return gone
