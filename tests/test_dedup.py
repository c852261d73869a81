import numpy as np
import pytest

from corpusloom.operators import dedup
from conftest import values

KIND = "pos bigint, vec array<float>"


def _frame(spark, vectors, order=None):
    order = range(len(vectors)) if order is None else order
    return spark.createDataFrame(
        [(int(p), None if v is None else [float(x) for x in v]) for p, v in zip(order, vectors)], KIND
    )


def greedy(vectors, threshold):
    """The rule, one row at a time: ``{pos: first kept match or None}``."""
    kept, out = [], {}
    for i, v in enumerate(vectors):
        v = np.float32(v).astype(float)
        n = np.linalg.norm(v)
        unit = v / n if n else v
        hit = next((j for j, k in kept if k @ unit > threshold), None)
        out[i] = hit
        if hit is None:
            kept.append((i, unit))
    return out


def _kept(df, dim, t, **kw):
    return sorted(r[0] for r in values(dedup.near_dedup(df, "pos", "vec", dim, t, **kw), "pos"))


def test_contract(spark):
    a, near, orth = [1, 0, 0], [1, 0.05, 0], [0, 1, 0]
    assert _kept(_frame(spark, [a, near, orth]), 3, 0.92) == [0, 2]
    assert _kept(_frame(spark, []), 3, 0.92) == []


def test_equal_to_the_threshold_stays(spark):
    assert _kept(_frame(spark, [[1, 0], [0.6, 0.8], [0, 1]]), 2, 0.8) == [0, 1, 2]


def test_chain_keeps_both_ends(spark):
    def at(deg):
        return [np.cos(np.radians(deg)), np.sin(np.radians(deg))]

    assert _kept(_frame(spark, [at(0), at(20), at(40)]), 2, 0.92) == [0, 2]


def test_zero_missing_and_short_vectors_survive(spark):
    rows = [[0, 0], [1, 0], [0, 0], None, [1], [2, 0], [1, 0, 0]]
    assert _kept(_frame(spark, rows), 2, 0.92) == [0, 1, 2, 3, 4, 6]


def test_order_is_by_position_not_by_arrival(spark):
    df = _frame(spark, [[1, 0], [1, 0.01], [0, 1]], order=[7, 3, 5])
    assert _kept(df, 2, 0.92) == [3, 5]


@pytest.mark.parametrize("seed", range(4))
def test_rounds_equal_the_sequential_rule(spark, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, 8))
    rows = centers[rng.integers(0, 6, 150)] + rng.normal(size=(150, 8)) * rng.choice([0.1, 0.6])
    # A third of the rows are copies of one row.
    rows[rng.choice(150, 50, replace=False)] = rows[11]
    t = float(rng.choice([0.3, 0.8, 0.92]))
    want = greedy(rows, t)
    df = _frame(spark, rows).repartition(3)
    for size in (7, 10_000):
        assert _kept(df, 8, t, block_rows=size) == [i for i, h in want.items() if h is None]
    links = dedup.near_dup_links(df, "pos", "vec", 8, t, block_rows=16)
    assert dict(values(links, "pos", "dup_of")) == {i: h for i, h in want.items() if h is not None}


def test_long_chain_across_cells(spark):
    """Each vector is similar to the next only, in any order of positions."""
    angles = np.radians(np.arange(0, 340, 20.0))
    rows = np.c_[np.cos(angles), np.sin(angles)]
    for seed in (0, 1):
        order = np.arange(len(rows)) if seed == 0 else np.random.default_rng(seed).permutation(len(rows))
        want = [i for i, h in greedy(rows[order], 0.92).items() if h is None]
        assert _kept(_frame(spark, rows[order]), 2, 0.92, block_rows=3) == want


@pytest.mark.parametrize("tail", [0, 20, 1024])
def test_a_tail_is_decided_like_the_rest(spark, tail):
    rng = np.random.default_rng(12)
    rows = rng.normal(size=(80, 3))
    want = {i: h for i, h in greedy(rows, 0.6).items() if h is not None}
    df = _frame(spark, rows)
    links = dedup.near_dup_links(df, "pos", "vec", 3, 0.6, block_rows=9, tail_rows=tail)
    assert dict(values(links, "pos", "dup_of")) == want


def test_a_long_chain_takes_many_rounds(spark, monkeypatch):
    """Every vector waits for the one before it."""
    angles = np.radians(np.arange(0, 170, 20.0))
    rows, turns = np.c_[np.cos(angles), np.sin(angles)], []
    once = dedup._earliest
    monkeypatch.setattr(dedup, "_earliest", lambda *a: turns.append(1) or once(*a))
    df = _frame(spark, rows)
    links = dedup.near_dup_links(df, "pos", "vec", 2, 0.92, tail_rows=0)
    want = {i: h for i, h in greedy(rows, 0.92).items() if h is not None}
    assert dict(values(links, "pos", "dup_of")) == want
    assert len(turns) > 3


def test_batches_in_turn_equal_one_pass(spark):
    rng = np.random.default_rng(9)
    rows = rng.normal(size=(90, 4))
    want = [i for i, h in greedy(rows, 0.9).items() if h is None]
    df = _frame(spark, rows)
    kept = spark.createDataFrame([], KIND)
    for low in range(0, 90, 30):
        batch = df.where(f"pos >= {low} and pos < {low + 30}")
        kept = kept.unionByName(dedup.kept_of_batch(batch, kept, "pos", "vec", 4, 0.9, block_rows=8))
    assert sorted(r[0] for r in values(kept, "pos")) == want


def test_copy_of_a_dropped_row_alone_is_kept(spark):
    def at(deg):
        return [np.cos(np.radians(deg)), np.sin(np.radians(deg))]

    kept = dedup.kept_of_batch(
        _frame(spark, [at(0), at(20)]), spark.createDataFrame([], KIND), "pos", "vec", 2
    )
    again = _frame(spark, [at(0), at(40)], order=[2, 3])
    fresh = dedup.kept_of_batch(again, kept, "pos", "vec", 2)
    assert [r[0] for r in values(fresh, "pos")] == [3]


def test_thresholds(spark):
    df = _frame(spark, [[1, 0], [1, 0]])
    assert _kept(df, 2, 1.0) == [0, 1]
    with pytest.raises(ValueError):
        dedup.near_dedup(df, "pos", "vec", 2, -0.1)


def test_exact_dedup_keeps_the_first(spark):
    df = spark.createDataFrame(
        [("c", 2, 0, "h"), ("a", 1, 1, "h"), ("b", 1, 0, "h"), ("d", 9, 0, "g")],
        "id string, idx bigint, sub_idx int, content_hash string",
    )
    out = dedup.exact_dedup(df)
    assert sorted(r[0] for r in values(out, "id")) == ["b", "d"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Each key is cut to one row before the shuffle as well as after it.
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_order_key(spark):
    df = spark.createDataFrame([(0, 1), (0, 0), (5, 3), (1, 0)], "idx bigint, sub_idx int")
    got = values(df.select("idx", "sub_idx", dedup.order_key().alias("k")).orderBy("k"), "idx", "sub_idx")
    assert got == [(0, 0), (0, 1), (1, 0), (5, 3)]


def test_order_key_never_wraps(spark):
    """Hashed ids have no room: an error, not two rows with one key."""
    for row in [(1 << 44, 0), (0, 1 << 20), (-1, 0), (0, -1)]:
        df = spark.createDataFrame([row], "idx bigint, sub_idx int")
        with pytest.raises(Exception, match="no order key"):
            df.select(dedup.order_key()).collect()
    df = spark.createDataFrame([((1 << 43) - 1, (1 << 20) - 1)], "idx bigint, sub_idx int")
    assert df.select(dedup.order_key()).first()[0] == (1 << 63) - 1


def test_report(spark):
    before, after = spark.range(5), spark.range(3)
    assert tuple(dedup.dedup_report(before, after).first()) == (5, 2, 3)
