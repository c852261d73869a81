"""Tables behind versioned pointers."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.operators import snapshots
from corpusloom.session import list_folder
from conftest import values

SCHEMA = StructType().add("id", "long").add("kind", "string")


def rows_of(spark, *ids):
    return spark.createDataFrame([(i, "even" if i % 2 == 0 else "odd") for i in ids], SCHEMA)


def ids(spark, path, version=None):
    return sorted(r[0] for r in values(snapshots.read(spark, path, SCHEMA, version), "id"))


def test_replace_append_and_go_back(spark, tmp_path):
    path = str(tmp_path / "t")
    assert snapshots.current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, path, SCHEMA)
    assert snapshots.replace(rows_of(spark, 1, 2), path, "kind").number == 1
    assert snapshots.append(rows_of(spark, 3), path, "kind").number == 2
    assert ids(spark, path) == [1, 2, 3]
    snapshots.replace(rows_of(spark, 9), path, "kind", note={"why": "test"})
    assert ids(spark, path) == [9] and ids(spark, path, 2) == [1, 2, 3]
    assert snapshots.roll_back(spark, path, 2).number == 4
    assert ids(spark, path) == [1, 2, 3]
    assert [v.action for v in snapshots.history(spark, path)] == ["replace", "append", "replace", "roll back"]
    snapshots.replace(rows_of(spark), path, "kind")
    assert ids(spark, path) == []


def test_partitions_of_all_parts_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        snapshots.append(rows_of(spark, i), path, "kind")
    odd = snapshots.read(spark, path, SCHEMA).where("kind = 'odd'")
    assert sorted(r[0] for r in values(odd, "id")) == [1, 3]
    assert odd.select(F.input_file_name()).distinct().count() == 2
    plan = odd._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan


def test_readers_see_a_table_at_every_step(spark, tmp_path, monkeypatch):
    """The old version stays readable until the new pointer is there."""
    path = str(tmp_path / "t")
    snapshots.replace(rows_of(spark, 1), path)
    seen = []
    create = snapshots.create_if_absent

    def watched(*args):
        seen.append(ids(spark, path))
        made = create(*args)
        seen.append(ids(spark, path))
        return made

    monkeypatch.setattr(snapshots, "create_if_absent", watched)
    snapshots.replace(rows_of(spark, 2), path)
    assert seen == [[1], [2]]


def test_two_writers_cannot_both_win(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.replace(rows_of(spark, 0), path)

    def write(i):
        try:
            return snapshots.replace(rows_of(spark, i), path, expect=1).number
        except snapshots.Conflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        won = list(pool.map(write, range(10, 16)))
    assert sorted(x for x in won if x) == [2]
    assert ids(spark, path) == [10 + won.index(2)]
    # What the others wrote is gone.
    assert len(list_folder(spark, f"{path}/parts")) == 2
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: snapshots.append(rows_of(spark, i), path), range(20, 24)))
    assert ids(spark, path) == sorted([10 + won.index(2), 20, 21, 22, 23])


def test_one_of_many_creates_a_file(spark, tmp_path):
    path = str(tmp_path / "f.json")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: snapshots.create_if_absent(spark, path, f'"{i}"'), range(40)))
    assert sum(made) == 1
    assert (tmp_path / "f.json").read_text() == f'"{made.index(True)}"'
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["f.json"]


def test_a_pointer_cut_off_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.replace(rows_of(spark, 1), path)
    (tmp_path / "t" / "versions" / "0000000002.json").write_text('{"action": "repl')
    (tmp_path / "t" / "versions" / "notes.json").write_text("x")
    assert ids(spark, path) == [1]
    assert snapshots.replace(rows_of(spark, 5), path, expect=1).number == 3
    assert ids(spark, path) == [5]


def test_a_failing_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.replace(rows_of(spark, 1), path)
    bad = rows_of(spark, 2).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"), "kind")
    with pytest.raises(Exception, match="no"):
        snapshots.replace(bad, path)
    assert ids(spark, path) == [1]


def test_expiry_keeps_what_versions_read(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        snapshots.replace(rows_of(spark, i), path)
    orphan = snapshots.write_part(rows_of(spark, 77), path)
    old = [v.parts[0] for v in snapshots.history(spark, path)]
    # What another writer may be at work on stays, unless asked for.
    assert snapshots.expire(spark, path, keep=2) == sorted(old[:2])
    assert snapshots.expire(spark, path, keep=2, orphans=True) == [orphan]
    assert ids(spark, path) == [3] and ids(spark, path, 3) == [2]
    with pytest.raises(FileNotFoundError):
        snapshots.roll_back(spark, path, 1)
    with pytest.raises(ValueError):
        snapshots.expire(spark, path, keep=0)


def test_compaction_keeps_the_rows_in_one_part(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(3):
        snapshots.append(rows_of(spark, i), path, "kind")
    assert len(snapshots.compact(spark, path, SCHEMA, "kind").parts) == 1
    assert ids(spark, path) == [0, 1, 2]
    got = snapshots.read(spark, path)
    assert sorted(got.columns) == ["id", "kind"] and got.count() == 3


def test_partitions_are_written_without_a_sort(spark, tmp_path):
    """Rows of one task stay in their order in each partition; the setting does not stay."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    rows = spark.range(0, 1000, 1, 1).selectExpr("id", "cast(id % 3 as string) as kind")
    seen = []
    writer = type(rows.write)
    parquet = writer.parquet

    def noted(self, *args, **kwargs):
        seen.append(spark.conf.get(name))
        return parquet(self, *args, **kwargs)

    before = spark.conf.get(name)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(writer, "parquet", noted)
        snapshots.replace(rows, str(tmp_path / "t"), "kind")
    assert int(seen[0]) > 1 and spark.conf.get(name) == before
    held = snapshots.read(spark, str(tmp_path / "t"), rows.schema)
    assert held.exceptAll(rows).count() == 0 and held.count() == 1000
