"""Whitening against numpy's eigenvectors and Python's whole numbers."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import queries, whitening

VECTORS = "vec_id bigint, embedding array<double>, x int, dim int, n string"


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], VECTORS)


def check(got, rows, most=16):
    """Everything the contract fixes, for vectors of one length."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in rows]
    fit = sorted(set(map(tuple, x)))
    n, d = len(fit), len(fit[0])
    sums = [sum(r[j] for r in fit) for j in range(d)]
    c = np.array([[n * r[j] - sums[j] for j in range(d)] for r in fit], object) / n
    v = c.astype(float).T @ c.astype(float) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(most, int((e > whitening.LEAST * np.trace(v)).sum()))
    by_row = defaultdict(list)
    for r in got:
        by_row[r.vec_id, r.deviation_exact].append(r)
    want = defaultdict(int)
    for (i, _), r in zip(rows, x):
        want[i, sum((n * r[j] - sums[j]) ** 2 for j in range(d))] += 1
    assert {key: len(lines) for key, lines in by_row.items()} == {q: k * m for q, m in want.items()}
    for r in got:
        assert r.n == n and r.identity_error <= 1e-4
        assert r.deviation == (r.deviation_exact if r.deviation_exact < 1 << 63 else None)
        assert r.explained == pytest.approx(e[r.component - 1] / np.trace(v), rel=1e-6)
    for j in range(k):
        axis = u[:, j] / np.sqrt(e[j])
        values = {
            (i, sum((n * r[a] - sums[a]) ** 2 for a in range(d))): float(
                np.array([n * r[a] - sums[a] for a in range(d)], float) / n @ axis
            )
            for (i, _), r in zip(rows, x)
        }
        mine = {(r.vec_id, r.deviation_exact): r.whitened for r in got if r.component == j + 1}
        keys = list(values)
        a, b = np.array([values[q] for q in keys]), np.array([mine[q] for q in keys])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6 * (1 + np.abs(a).max())


def test_given_vectors(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    got = queries.op11_whitened_vectors(spark, data).collect()
    check(got, [(r.vec_id, r.embedding) for r in rows])
    assert {r.component for r in got} == set(range(1, 17))


def test_copies_count_once_and_odd_rows_go(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(5) * [9, 5, 3, 2, 1]).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(500)] + [(7, rows[3][1]), (7, rows[4][1])]
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [nan] * 5), (4, [inf, 1.0, 1.0, 1.0, 1.0]), (5, [None] * 5), (6, [1e300] * 5)]
    got = whitening.whiten(frame_of(spark, rows + odd).repartition(5)).collect()
    assert {r.n for r in got} == {60}
    check(got, rows)
    got = whitening.whiten(frame_of(spark, rows), components=2).collect()
    check(got, rows, most=2)


def test_lengths_are_spaces_of_their_own(spark):
    rng = np.random.default_rng(3)
    rows = {d: [(100 * d + i, rng.standard_normal(d).tolist()) for i in range(20)] for d in (2, 3)}
    got = whitening.whiten(frame_of(spark, rows[2] + rows[3])).collect()
    for d in (2, 3):
        check([r for r in got if r.vec_id // 100 == d], rows[d])


def test_directions_without_variance(spark):
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    got = whitening.whiten(frame_of(spark, line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 9
    check(got, line)
    assert whitening.whiten(frame_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame_of(spark, [])).count() == 0


def test_very_large_and_unequal_components(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(3) * [2.0**46, 2.0**30, 1.0]).tolist()) for i in range(50)]
    got = whitening.whiten(frame_of(spark, rows)).collect()
    assert all(r.deviation is None for r in got)
    sums = {r.vec_id: r.deviation_exact for r in got}
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows], object)
    far = 50 * x - x.sum(axis=0)
    assert sums == {i: int((far[i] ** 2).sum()) for i in range(50)}


@pytest.mark.parametrize("d,n", [(1, 30), (7, 40), (33, 20), (64, 500)])
def test_factors_give_the_eigenvectors(d, n):
    rng = np.random.default_rng(d)
    c = rng.standard_normal((n, d)) * np.logspace(0, 4, d)
    c -= c.mean(axis=0)
    v = c.T @ c / n
    factor, order = whitening.pivoted_cholesky(v)
    assert np.allclose(factor @ factor.T, v[order][:, order], atol=1e-9 * np.trace(v))
    assert (np.triu(factor, 1) == 0).all()
    values, vectors = whitening.principal(v)
    want = np.linalg.eigvalsh(v)[::-1][: len(values)]
    assert np.allclose(values, want, rtol=1e-8, atol=1e-11 * np.trace(v))
    assert np.allclose(vectors @ vectors.T, np.eye(len(vectors)), atol=1e-11)
    assert np.allclose(vectors @ v, values[:, None] * vectors, atol=1e-11 * np.trace(v))


def test_ids_stay_when_null(spark):
    rows = [(None, [1.0, 0.0]), (None, [0.0, 3.0]), (4, [2.0, 2.0])]
    got = whitening.whiten(frame_of(spark, rows).withColumn("whitened", F.lit(1)))
    assert got.where("vec_id is null").count() == 4 and got.count() == 6
