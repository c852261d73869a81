"""Operators over vectors against brute force, with the awkward cases."""

import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import cells, components, topk, vectors_dedup

VECTORS = "vec_id bigint, embedding array<float>, label int"
CLASH = ["row", "vec", "node", "weight", "x", "pivot", "rank", "score"]


def vectors_of(spark, rows):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    for name in CLASH:
        frame = frame.withColumn(name, F.lit("x"))
    return frame


def clustered(seed=1, groups=12, each=8, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = rng.standard_normal(dim)
        for _ in range(each):
            rows.append((centre + 0.12 * rng.standard_normal(dim)).astype(np.float32).tolist())
    rows += rng.standard_normal((40, dim)).astype(np.float32).tolist()
    rows += [rows[0]] * 5 + [[x * 2 for x in rows[3]]]
    order = rng.permutation(len(rows))
    return [(100 + int(i), rows[j]) for i, j in enumerate(order)]


def expected(rows, threshold=0.95):
    hit = brute.cosines([v for _, v in rows]) >= threshold
    np.fill_diagonal(hit, False)
    forest = brute.Forest([i for i, _ in rows])
    for a, b in zip(*np.nonzero(hit)):
        forest.link(rows[a][0], rows[b][0])
    return {i: (int(hit[k].sum()), forest.root(i)) for k, (i, _) in enumerate(rows)}


@pytest.mark.parametrize("block", [1024, 3])
def test_near_vectors_match_brute_force(spark, monkeypatch, block):
    """With very many tables nothing is missed; small cells change nothing."""
    monkeypatch.setattr(cells.compare, "__defaults__", (block,))
    rows = clustered()
    got = vectors_dedup.near_dedup(vectors_of(spark, rows), tables=60, bits=6).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == expected(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_of_the_defaults(spark, data):
    """Pairs just above the threshold, where recall is lowest."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        side = rng.standard_normal(64)
        side -= a * (a @ side)
        side /= np.linalg.norm(side)
        b = 0.951 * a + np.sqrt(1 - 0.951**2) * side
        rows += [(2 * i, a.tolist()), (2 * i + 1, b.tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    links = vectors_dedup.near_dedup(frame).agg(F.sum("n_links")).first()[0] / 2
    assert links / 600 >= 0.95
    given = spark.read.parquet(f"{data}/embeddings.parquet")
    want = expected([(r.vec_id, r.embedding) for r in given.collect()])
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors_dedup.near_dedup(given).collect()}
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in want.values())


def test_awkward_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 0.0]), (7, [None, 1.0]), (8, []), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [-0.0, 1.0]),
            (11, [0.0, 1.0]), (12, [1.0, 0.01, 0.0]), (13, [1.0]), (14, [5.0]), (None, [-1.0, 0.0])]
    got = {}
    for r in vectors_dedup.near_dedup(vectors_of(spark, rows)).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert got[1] == [(3, 1, True)] and got[2] == [(3, 1, False)] * 2
    # A null id links as well, with its own or with others.
    assert sorted(got[None], key=str) == [(0, None, True), (3, 1, False)]
    assert got[10] == [(1, 10, True)] and got[11] == [(1, 10, False)]
    # Every length has its own links.
    assert got[9] == [(1, 9, True)] and got[12] == [(1, 9, False)]
    assert got[13] == [(1, 13, True)] and got[14] == [(1, 13, False)]
    assert all(got[i] == [(0, i, True)] for i in (3, 4, 5, 6, 7, 8))
    assert vectors_dedup.near_dedup(vectors_of(spark, [])).count() == 0


def test_vectors_of_two_lengths_and_wide_keys(spark):
    short, long = clustered(seed=5, groups=4, dim=8), clustered(seed=6, groups=6, dim=12)
    long = [(i + 1000, v) for i, v in long]
    got = vectors_dedup.near_dedup(vectors_of(spark, short + long), tables=200, bits=18).collect()
    want = expected(short) | expected(long)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 200)]
    edges += [(5, 5), (7, 6), (7, 6), (None, 3), (150, 90)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in components.components(frame).collect()}
    want = dict.fromkeys(range(61), 0) | dict.fromkeys([90, *range(100, 300)], 90)
    assert got == want
    assert components.components(frame.limit(0)).count() == 0


# -- top-k -------------------------------------------------------------------


def best_by_hand(rows, every, k=5):
    x = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows]
    out = []
    for q, (i, a) in enumerate(x):
        if i is None or i % every:
            continue
        others = sorted(
            (-int(a.astype(object) @ b.astype(object)), j) for p, (j, b) in enumerate(x)
            if p != q and len(a) == len(b)
        )[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(others)]
    return sorted(out)


def tuples(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("block,pivots", [(4096, 64), (3, 4)])
def test_top_k_is_exact(spark, block, pivots):
    rows = clustered(seed=3, groups=20)
    got = topk.top_k(vectors_of(spark, rows), F.col("vec_id") % 10 == 0, query_block=block, pivots=pivots)
    assert tuples(got) == best_by_hand(rows, 10)


def test_annuli_are_skipped_and_results_stay_exact(spark, monkeypatch):
    """Queries near their own cluster let most annuli go unread."""
    rng = np.random.default_rng(8)
    rows = [
        (c * 50 + i, (np.eye(30)[c] * 5 + 0.01 * rng.standard_normal(30)).tolist())
        for c in range(30)
        for i in range(50)
    ]
    monkeypatch.setattr(topk, "_ANNULUS", 16)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert tuples(topk.top_k(frame, F.col("vec_id") % 50 == 0)) == best_by_hand(rows, 50)


def test_top_k_ties_and_awkward_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 1.0]), (50, [1.0, 1.0]), (3, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (9, [0.5, nan])]
    frame = vectors_of(spark, [*rows, (100, None), (8, [None, 1.0]), (7, []), (6, [1.0])])
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0)
    assert tuples(got) == best_by_hand(rows[:-1], 50)
    assert topk.top_k(vectors_of(spark, []), F.lit(True)).count() == 0
    # Each length is searched on its own.
    lengths = [(50 * i, [float(i)] * (1 + i % 3)) for i in range(12)]
    assert tuples(topk.top_k(vectors_of(spark, lengths), F.col("vec_id") % 100 == 0)) == best_by_hand(lengths, 100)
    alone = topk.top_k(vectors_of(spark, [(0, [1.0])]), F.lit(True))
    assert alone.count() == 0
    nameless = topk.top_k(vectors_of(spark, [(0, [1.0]), (None, [3.0])]), F.col("vec_id") == 0)
    assert tuples(nameless) == [(0, 1, None, 256 * 768)]


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**18 + i, -(2.0**18) - i * 7]) for i in range(12)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert tuples(topk.top_k(frame, F.col("vec_id") % 4 == 0)) == best_by_hand(rows, 4)


def test_very_large_components_are_not_clamped(spark):
    """Components that differ only beyond 2**27 keep their scores and their order."""
    rows = [(0, [1.0, 0.0]), (1, [1e6, 0.0]), (2, [2e6, 1.0]), (3, [-1e9, 5.0]), (4, [1e9, 7.0]), (5, [1e9, 8.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert tuples(topk.top_k(frame, F.col("vec_id") == 0)) == best_by_hand(rows[:1] + rows[1:], 1)[:5]
    # Scores beyond 64 bits: the order is exact, what is returned is the nearest.
    got = topk.top_k(frame, F.col("vec_id") >= 4, k=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(4, 5), (4, 2), (5, 4), (5, 2)]
    assert got[0].score == (1 << 63) - 1
    assert got[1].score == (1 << 63) - 1


def test_search_expands_from_the_own_ring_and_stops(spark, monkeypatch):
    """Far groups: the rings that are read are few, and their number is bounded."""
    rng = np.random.default_rng(9)
    rows = [
        (c * 100 + i, (np.eye(24)[c] * 9 + 0.01 * rng.standard_normal(24)).tolist())
        for c in range(24)
        for i in range(100)
    ]
    asked = []
    whole = topk._Rings.waves

    def watched(self, *args):
        for wave in whole(self, *args):
            asked.append((sum(map(len, wave.values())), len(self.cell)))
            yield wave

    monkeypatch.setattr(topk._Rings, "waves", watched)
    monkeypatch.setattr(topk, "FIRST_ROWS", 50)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert tuples(topk.top_k(frame, F.col("vec_id") % 100 == 0)) == best_by_hand(rows, 100)
    rings = asked[0][1]
    assert rings >= 20 and sum(n for n, _ in asked) <= 24 * rings / 4


def test_runs_of_one_pivot_may_be_out_of_order():
    """Two files of a pivot that follow each other in the wrong order."""
    from types import SimpleNamespace

    import pandas as pd

    x = np.array([3, 2, 1, 9, 8, 7])
    # Lifted to length 9; the pivot is (9, 0).
    distance = np.sqrt((x - 9.0) ** 2 + 81 - x**2)
    batch = pd.DataFrame({"pivot": 0, "cell": 3, "distance": distance, "row": np.arange(6), "vec_id": x})
    batch["x"] = [np.array([a]) for a in x]
    assert all(run["distance"].is_monotonic_increasing for run in topk._annuli(batch))
    for query, floor in ((9, 50), (1, 5)):
        asked = {3: np.array([0])}
        sent = (np.array([99]), np.array([[query]]), np.array([floor]), np.array([[9.0, 0.0]]), 81.0, asked, False)
        found = pd.concat(topk._search(SimpleNamespace(value=sent), 3)([batch]))
        want = sorted((query * a for a in x), reverse=True)[:3]
        assert sorted(found["score"], reverse=True) == want
