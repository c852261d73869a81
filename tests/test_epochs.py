"""Epoch order by a bijection."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import epochs
from conftest import pairs, values


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 11, 97, 1000])
def test_every_position_once_and_back(spark, n):
    key = F.lit("k")
    got = spark.range(n).select(
        "id", epochs.permuted(F.col("id"), n, key).alias("y"),
    )
    got = got.withColumn("back", epochs.unpermuted(F.col("y"), n, key))
    rows = values(got)
    assert sorted(y for _, y, _ in rows) == list(range(n))
    assert all(x == back for x, _, back in rows)
    if n >= 97:
        assert sum(x == y for x, y, _ in rows) < n / 10
        other = dict(values(spark.range(n).select("id", epochs.permuted(F.col("id"), n, F.lit("l")))))
        assert sum(other[x] == y for x, y, _ in rows) < n / 10


@pytest.mark.parametrize("n,size", [(1, 1), (7, 3), (100, 10), (103, 10), (9, 20)])
def test_rows_and_positions_agree(spark, n, size):
    order = epochs.Epoch(n, size, 3, 1)
    got = values(spark.range(n).select("id", order.position_of(F.col("id")), order.row_at(F.col("id"))))
    place = {row: at for row, at, _ in got}
    assert sorted(place.values()) == list(range(n))
    assert {at: row for row, at in place.items()} == {at: row for at, _, row in got}
    # Shards stay together, one after the other.
    runs = [row // size for row in sorted(place, key=place.get)]
    assert sum(a != b for a, b in zip(runs, runs[1:])) == -(-n // size) - 1


def test_resuming_needs_no_sort(spark):
    items = spark.range(250).select(F.col("id").alias("pos"), F.format_string("i%d", "id").alias("id"))
    whole = pairs(epochs.epoch_rows(items, 250, 40, 7, 0).select("id", "epoch_pos"))
    rest = epochs.epoch_rows(items.repartition(3), 250, 40, 7, 0, resume_at=100)
    assert pairs(rest.select("id", "epoch_pos")) == {i: p for i, p in whole.items() if p >= 100}
    plan = epochs.epoch_rows(items, 250, 40, 7, 0, 100)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert whole != pairs(epochs.epoch_rows(items, 250, 40, 7, 1).select("id", "epoch_pos"))
    next_ = epochs.loader_plan(items, 250, 40, 7, 0, 240, 50)
    assert pairs(next_.select("id", "epoch_pos")) == {i: p for i, p in whole.items() if p >= 240}
    assert epochs.loader_plan(items, 250, 40, 7, 0, 250, 5).count() == 0
    assert epochs.epoch_rows(items.limit(0), 0, 40, 7, 0).count() == 0
    with pytest.raises(ValueError):
        epochs.Epoch(3, 0, 1, 1)
