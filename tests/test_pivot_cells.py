"""Cells around pivots: every pair over the threshold meets, once."""

import numpy as np
import pytest

from corpusloom.operators import pivot_cells
from conftest import values

KIND = "pos bigint, vec array<float>"


def clustered(n, dim, seed=0, spread=0.35):
    """Rows around as many centres as the square root of their number."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(2, int(n**0.5)), dim))
    rows = centres[rng.integers(0, len(centres), n)] + spread * rng.standard_normal((n, dim))
    return rows.astype(np.float32)


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], KIND)


def unit(rows):
    rows = rows.astype(float)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@pytest.mark.parametrize("dim,threshold,block", [(8, 0.3, 1000), (8, 0.9, 7), (3, 0.0, 5), (160, 0.9, 40)])
def test_each_pair_over_the_threshold_meets_once(spark, dim, threshold, block):
    rows = np.concatenate([clustered(300, dim), np.random.default_rng(1).standard_normal((100, dim))])
    frame = frame_of(spark, rows)
    cells = pivot_cells.fit(frame, threshold, block)
    x = unit(rows.astype(np.float32))
    own, visits = cells.dealt(x, np.arange(len(x)))
    places = [{int(b), *map(int, v)} for b, v in zip(own, visits)]
    hit = np.argwhere(np.triu(x @ x.T > threshold, 1))
    for a, b in hit:
        # One lives where the other lives or visits, and not the other way round too.
        meets = (int(own[a]) in places[b]) + (int(own[b]) in places[a]) - (own[a] == own[b])
        assert meets == 1, (a, b)
    assert len(hit)


def test_blocks_find_all_pairs(spark):
    """The screens leave no pair out, in low and in high dimensions."""
    import pandas as pd

    for dim, threshold in ((16, 0.5), (256, 0.85)):
        rows = clustered(700, dim, seed=4)
        part = pd.DataFrame({"pos": np.arange(700), "vec": list(rows), "open": True})
        block = pivot_cells.Block(threshold)
        block.live(part.iloc[:300])
        block.live(part.iloc[300:500])
        found = {(b, a) for a, b, *_ in block.pairs(part.iloc[500:]) for a, b in zip(a + 500, b)}
        found |= {(a, b) for a, b, *_ in block.pairs(None) for a, b in zip(a, b)}
        near = unit(rows) @ unit(rows).T > threshold
        near[500:, 500:] = False
        assert found == set(map(tuple, np.argwhere(np.triu(near, 1)).tolist()))


def test_dealt_rows_grow_slower_than_their_number_to_one_and_a_half(spark):
    """Four and sixteen times the rows; without any structure as well."""
    for rows, most in ((clustered(24_000, 24, spread=0.1), 1.2), (np.random.default_rng(3).standard_normal((24_000, 24)), 1.5)):
        dealt = []
        for n in (1500, 6000, 24_000):
            report = pivot_cells.dealing(frame_of(spark, rows[:n]), 0.92, 65536).first()
            assert report["vectors"] == n
            dealt.append(report["rows_dealt"])
        powers = np.diff(np.log(dealt)) / np.log(4)
        assert powers.max() < most, (dealt, powers)


def test_near_cells_are_bundled(spark):
    """Without structure a row visits half of the bundles, not of the cells; those
    of a structured set hold rows that are near, so that few are visited."""
    noise = np.random.default_rng(3).standard_normal((60_000, 8)).astype(np.float32)
    report = pivot_cells.dealing(frame_of(spark, noise), 0.1, 65536).first()
    assert report["cells"] > 80 and report["rows_dealt"] < 26 * 60_000, report
    x = unit(clustered(5000, 16, spread=0.05))
    cells = pivot_cells.bare(x[:500]).with_rows(np.full(500, 10), np.zeros(500), np.full(500, 0.5), 1000, 0.95)
    some = cells.bundled(1000)
    assert some.bundle.max() == 47 and (np.bincount(some.bundle) < 160).all()
    assert all(len(v) < 24 for v in some.dealt(x[:50], np.arange(50))[1])


def test_nothing_to_deal(spark):
    assert tuple(pivot_cells.dealing(frame_of(spark, np.zeros((0, 3))), 0.9, 10).first()) == (0, 0, 0, 0)
    frame = frame_of(spark, np.ones((1, 3)))
    assert values(pivot_cells.dealing(frame, 0.9, 10)) == [(1, 1, 1, 1)]


def test_many_pairs_of_a_block_take_little_memory():
    """Pairs well over the threshold are not compared again in double, the rest a few
    at a time: also where every pair of long rows is over it."""
    import tracemalloc

    import pandas as pd

    noise = np.random.default_rng(7).standard_normal((1500, 384))
    rows = (np.ones(384) + 0.05 * noise).astype(np.float32)
    block = pivot_cells.Block(0.92)
    block.live(pd.DataFrame({"pos": np.arange(1500), "vec": list(rows), "open": True}))
    tracemalloc.start()
    found = sum(len(a) for a, *_ in block.pairs(None))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 1500 * 1499 // 2 and most < 200_000_000, most


def test_decided_rows_are_not_compared_with_each_other():
    """They stay in their bundle, and a block only pairs them with undecided ones."""
    import pandas as pd

    rows = clustered(600, 256, seed=4)
    open_ = np.arange(600) % 9 == 0
    part = pd.DataFrame({"pos": np.arange(600), "vec": [r.tobytes() for r in rows], "open": open_})
    block = pivot_cells.Block(0.85)
    block.live(part)
    near = np.triu(unit(rows) @ unit(rows).T > 0.85, 1) & open_[None, :]
    found = [(a, b) for a, b, *_ in block.pairs(None) for a, b in zip(a.tolist(), b.tolist())]
    assert len(found) == len(set(found)) == near.sum() > 0
    assert set(found) == set(map(tuple, np.argwhere(near).tolist()))
    bare = pivot_cells.bare(unit(rows[:50]))
    cells = bare.with_rows(np.full(50, 12), np.zeros(50), np.full(50, np.pi), 1000, 0.0).bundled(1000)
    _, visits = cells.dealt(unit(rows), np.arange(600), open_)
    assert not any(len(v) for v, goes in zip(visits, open_) if not goes)
    assert all(len(v) == cells.bundle.max() for v, goes in zip(visits, open_) if goes)
