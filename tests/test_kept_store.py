"""The store of kept vectors: same decisions, few files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import dedup, kept_store
from conftest import values
from test_dedup import _frame, greedy


def store_of(spark, path, dim, threshold=0.92, **kw):
    return kept_store.KeptStore(spark, str(path), dim, threshold, **kw)


def _kept(store):
    return sorted(r[0] for r in values(store.kept(), "pos"))


def test_ten_deliveries_equal_one_pass(spark, tmp_path):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((120, 8))
    rows = centres[rng.integers(0, 120, 400)] + 0.25 * rng.standard_normal((400, 8))
    rows[rng.choice(400, 100, replace=False)] = rows[3]  # copies in every delivery
    want = [i for i, hit in greedy(rows, 0.92).items() if hit is None]
    store = store_of(spark, tmp_path / "s", 8, block_rows=16, growth=2)
    df = _frame(spark, rows)
    for batch in range(10):
        part = df.where(f"pos between {40 * batch} and {40 * batch + 39}")
        store.add(part, batch, "pos", "vec")
    assert _kept(store) == want
    # It has been dealt anew on the way, and old layouts have gone.
    assert store.layout().number > 1
    assert len(list((tmp_path / "s").glob("layout-*"))) == 2


def test_a_batch_reads_only_cells_it_can_reach(spark, tmp_path):
    """Forty far groups; a batch of one group opens few of their files."""
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 32)) * 4
    rows = np.repeat(centres, 50, axis=0) + rng.standard_normal((2000, 32))
    store = store_of(spark, tmp_path / "s", 32, 0.97)
    store.add(_frame(spark, rows), 0, "pos", "vec")
    every = store.kept().select(F.input_file_name()).distinct().count()
    new = centres[7] + rng.standard_normal((60, 32))
    batch = dedup.distinct_vectors(_frame(spark, new, range(5000, 5060)), "pos", "vec", 32)
    reached = dedup.reached_cells(batch, store.cells(1))
    homes = store.homes(reached, 1)
    read = homes.select(F.input_file_name()).distinct().count()
    assert 0 < read <= every / 5, (read, every)
    plan = homes._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "cell" in plan.split("PartitionFilters")[1][:400]
    store.add(_frame(spark, new, range(5000, 5060)), 1, "pos", "vec")
    both = np.concatenate([rows, new])
    order = [*range(2000), *range(5000, 5060)]
    want = [order[i] for i, hit in greedy(both, 0.97).items() if hit is None]
    assert _kept(store) == want


def test_a_batch_that_runs_again_decides_alike(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = rng.standard_normal((120, 3))
    want = [i for i, hit in greedy(rows, 0.9).items() if hit is None]
    store = store_of(spark, tmp_path / "s", 3, 0.9, growth=2)
    df = _frame(spark, rows)
    for batch in (0, 0, 1, 2, 2, 2, 3):
        store.add(df.where(f"pos between {30 * batch} and {30 * batch + 29}"), batch, "pos", "vec")
    assert _kept(store) == want


def test_odd_batches(spark, tmp_path):
    store = store_of(spark, tmp_path / "s", 2)
    assert _kept(store) == []
    store.add(_frame(spark, []), 0, "pos", "vec")
    store.add(_frame(spark, [None, [0, 0], [1]]), 1, "pos", "vec")
    assert _kept(store) == [] and store.layout() is None
    store.add(_frame(spark, [[1, 0], [2, 0], [0, 1]]), 2, "pos", "vec")
    store.add(_frame(spark, [[1, 0.01], [-1, 0]], [10, 11]), 3, "pos", "vec")
    assert _kept(store) == [0, 2, 11]
    all_stay = store_of(spark, tmp_path / "t", 2, 1.0)
    all_stay.add(_frame(spark, [[1, 0], [1, 0]]), 0, "pos", "vec")
    assert _kept(all_stay) == [0, 1]
    with pytest.raises(ValueError):
        store_of(spark, tmp_path / "u", 2, -1)
    with pytest.raises(ValueError):
        store.add(_frame(spark, []), -1, "pos", "vec")
