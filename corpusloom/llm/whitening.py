"""Whitening of vectors: pivoted Cholesky, then one-sided Jacobi.

Components become whole numbers ``floor(64 c) + 1000000``. The fit list holds
each distinct vector of them once, so copies of any number count once. Its
scatter about the mean is factored as ``P L L' P'`` with the largest remaining
diagonal first; rotations from the right make the columns of the triangular
factor orthogonal. Their squared lengths are the eigenvalues of the covariance,
the columns of length one its components.

How it runs: three passes over the written fit list, each with one small matrix
per task. Tasks hand on their matrices row by row, and rows of one number are
added up where they meet, so no task and not the driver gets more than
``d x d`` numbers per vector length, however many rows there are. The first pass
gives counts and sums, the second the scatter of centred vectors, the third the
covariance of the whitened ones, which is compared with the identity. The factors
are computed on the driver from the ``d x d`` matrix and go to the tasks in
``d x 16`` numbers.

Defined cases: rows whose vector is null or empty or holds null or non-finite
entries are dropped, and so are those with a component beyond ``+-2**50``, which
has no whole number with room for exact sums. Vectors of different lengths are
different spaces: each length has a fit list, a mean and components of its own.
Repeated ids and null ids are rows of their own. Directions without variance (an
eigenvalue of at most ``LEAST`` of the trace) have no components: a fit list of
one vector gives no rows. ``deviation`` is null where it has no room in 64 bits
(``n`` is in it squared); ``deviation_exact`` has room for 38 digits. Only the
two named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.vectors_dedup import finite
from corpusloom.session import stage_table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
# Shares of the trace up to this are rounding, not variance.
LEAST = 1e-12
_BOUND = float(1 << 50)
_HALF = 32
_ROOM = 1 << 62
_SWEEPS = 40
_EPS = np.finfo(float).eps
_OUT_ROWS = 4096


def scaled(vec: str) -> Column:
    """``floor(64 c) + 1000000`` of each component, in double precision."""
    return F.transform(
        vec, lambda c: (F.floor(c.cast("double") * SCALE) + SHIFT).cast("bigint")
    )


def usable(vec: str) -> Column:
    small = F.forall(vec, lambda c: F.abs(c.cast("double")) <= _BOUND)
    return finite(vec) & (F.size(vec) > 0) & small


# -- factors -----------------------------------------------------------------


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``L, order`` with ``v[order][:, order] = L L'``, largest remaining
    diagonal first; as many columns as ``v`` has directions."""
    d = len(v)
    rest = np.diag(v).astype(float).copy()
    order = np.arange(d)
    factor = np.zeros((d, d))
    least = d * _EPS * max(rest.max(initial=0.0), 0.0)
    for k in range(d):
        best = k + int(rest[order[k:]].argmax())
        if rest[order[best]] <= least:
            return factor[:, :k], order
        order[[k, best]] = order[[best, k]]
        factor[[k, best], :k] = factor[[best, k], :k]
        pivot, below = order[k], order[k + 1 :]
        factor[k, k] = np.sqrt(rest[pivot])
        factor[k + 1 :, k] = (v[below, pivot] - factor[k + 1 :, :k] @ factor[k, :k]) / factor[k, k]
        rest[below] -= factor[k + 1 :, k] ** 2
    return factor, order


def _turns(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of ``n`` (even) columns once, in ``n - 1`` rounds of disjoint ones."""
    ring = np.arange(n)
    for _ in range(n - 1):
        yield ring[: n // 2], ring[: n // 2 - 1 : -1]
        ring = np.r_[ring[0], ring[-1], ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared lengths, falling, and directions of the columns after rotations
    that make them orthogonal."""
    d, r = factor.shape
    columns = np.zeros((r + r % 2, d))
    columns[:r] = factor.T
    for _ in range(_SWEEPS):
        rotated = False
        for p, q in _turns(len(columns)):
            x, y = columns[p], columns[q]
            a, b = (x * x).sum(axis=1), (y * y).sum(axis=1)
            c = (x * y).sum(axis=1)
            turn = np.abs(c) > _EPS * np.sqrt(a * b)
            if not turn.any():
                continue
            rotated = True
            p, q, x, y = p[turn], q[turn], x[turn], y[turn]
            zeta = (b[turn] - a[turn]) / (2 * c[turn])
            tan = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            cos = 1 / np.hypot(1, tan)
            sin = cos * tan
            columns[p] = cos[:, None] * x - sin[:, None] * y
            columns[q] = sin[:, None] * x + cos[:, None] * y
        if not rotated:
            break
    squares = (columns * columns).sum(axis=1)
    order = np.argsort(-squares, kind="stable")[:r]
    lengths = np.sqrt(squares[order])
    lengths[lengths == 0] = 1
    return squares[order], columns[order] / lengths[:, None]


def principal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (a row each) of a covariance,
    those with variance only."""
    factor, order = pivoted_cholesky(v)
    values, rows = one_sided_jacobi(factor)
    vectors = np.zeros_like(rows)
    vectors[:, order] = rows
    has = values > LEAST * max(np.trace(v), 0.0)
    return values[has], vectors[has]


# -- passes over the rows ----------------------------------------------------


def _by_length(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places and rows of the vectors of each length in a batch."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    first = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield int(d), at, flat[first[at][:, None] + np.arange(d)]


@dataclass
class _Fit:
    """What the fit list of one vector length says."""

    n: int
    sums: list[int]
    axes: np.ndarray | None = None  # a column per component, over sqrt(e)
    explained: np.ndarray | None = None
    identity_error: float = 0.0

    def spread(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact: whole numbers of 64 bits or, without room, Python's."""
        most = max(int(x.max()), -int(x.min()))
        if self.n * most + max(map(abs, self.sums)) < _ROOM:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.spread(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Squared lengths of ``n x - S``, exact."""
        far = self.spread(x)
        most = max(int(far.max()), -int(far.min()))
        if most * most * far.shape[1] >= _ROOM:
            far = far.astype(object)
        return (far * far).sum(axis=1)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.axes


def _added(
    fit: DataFrame, kind: str, part: Callable[[int, np.ndarray], np.ndarray]
) -> dict[int, np.ndarray]:
    """Per vector length the sum over all rows of a small matrix: ``part`` gives
    that of some rows (length, rows), every matrix row is added up on its own."""
    schema = f"dim int, line int, number array<{kind}>"
    own = pa.int64() if kind == "bigint" else pa.float64()
    arrow = pa.schema([("dim", pa.int32()), ("line", pa.int32()), ("number", pa.list_(own))])

    def lines(held: dict) -> Iterator[pa.RecordBatch]:
        for (dim, line), number in held.items():
            yield pa.RecordBatch.from_pylist(
                [{"dim": dim, "line": line, "number": number}], schema=arrow
            )

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _by_length(batch.column(0)):
                more = part(d, x)
                held[d] = held[d] + more if d in held else more
        yield from lines({(d, i): row for d, m in held.items() for i, row in enumerate(m)})

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for key, number in zip(keys, batch.column(2)):
                more = number.values.to_numpy(zero_copy_only=False)
                held[key] = held[key] + more if key in held else more
        yield from lines(held)

    parts = fit.select("x").mapInArrow(of_rows, schema).repartition("dim", "line")
    found: dict[int, dict[int, list]] = {}
    for row in parts.mapInArrow(of_lines, schema).collect():
        found.setdefault(row["dim"], {})[row["line"]] = row["number"]
    return {d: np.array([m[i] for i in range(len(m))]) for d, m in found.items()}


def _counted(d: int, x: np.ndarray) -> np.ndarray:
    """How many, and the sums of both halves of the numbers: all without overflow."""
    halves = [x >> _HALF, x & ((1 << _HALF) - 1)]
    return np.stack([np.full(d, len(x)), *[h.sum(axis=0) for h in halves]]).astype(np.int64)


def _scatter(fits: dict[int, _Fit]):
    def part(d: int, x: np.ndarray) -> np.ndarray:
        c = fits[d].centred(x)
        return c.T @ c

    return part


def _outcome(fits: dict[int, _Fit]):
    """Sums of the whitened rows, and of their products below."""

    def part(d: int, x: np.ndarray) -> np.ndarray:
        w = fits[d].whitened(x)
        return np.vstack([w.sum(axis=0), w.T @ w])

    return part


def fit_lengths(fit: DataFrame, components: int = COMPONENTS) -> dict[int, _Fit]:
    """Mean, components and the check of the outcome for each vector length of a
    fit list (``x``, distinct)."""
    fits = {}
    for d, (n, high, low) in _added(fit, "bigint", _counted).items():
        sums = [(int(h) << _HALF) + int(v) for h, v in zip(high, low)]
        fits[d] = _Fit(int(n[0]), sums)
    if not fits:
        return {}
    for d, scatter in _added(fit, "double", _scatter(fits)).items():
        v = scatter / fits[d].n
        v = (v + v.T) / 2
        values, vectors = principal(v)
        values, vectors = values[:components], vectors[:components]
        fits[d].axes = vectors.T / np.sqrt(values)
        fits[d].explained = values / np.trace(v) if len(values) else values
    fits = {d: f for d, f in fits.items() if f.axes.shape[1]}
    if fits:
        shown = fit.where(F.size("x").isin(list(fits)))
        for d, m in _added(shown, "double", _outcome(fits)).items():
            mean = m[0] / fits[d].n
            v = m[1:] / fits[d].n - np.outer(mean, mean)
            fits[d].identity_error = float(np.abs(v - np.eye(len(v))).max())
    return fits


# -- result ------------------------------------------------------------------

_OUT = pa.schema(
    [
        ("vec_id", pa.int64()),
        ("component", pa.int32()),
        ("n", pa.int64()),
        ("deviation", pa.int64()),
        ("deviation_exact", pa.decimal128(38, 0)),
        ("whitened", pa.float64()),
        ("explained", pa.float64()),
        ("identity_error", pa.float64()),
    ]
)
_OUT_SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, deviation_exact decimal(38,0), "
    "whitened double, explained double, identity_error double"
)


def _whole(numbers: np.ndarray, limit: int) -> list:
    return [int(v) if int(v) < limit else None for v in numbers]


def _shown(fits: dict[int, _Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _OUT_ROWS):
                batch = whole.slice(at, _OUT_ROWS)
                for d, rows, x in _by_length(batch.column(1)):
                    if d in fits:
                        yield _lines(fits[d], batch.column(0).take(pa.array(rows)), x)

    return run


def _lines(fit: _Fit, ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
    k, n = fit.axes.shape[1], len(x)
    far = fit.deviations(x)
    exact = [None if v is None else Decimal(v) for v in _whole(far, 10**38)]
    each = pa.array(np.repeat(np.arange(n), k))
    columns = [
        ids.take(each),
        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
        pa.array(np.full(n * k, fit.n)),
        pa.array(_whole(far, 1 << 63), pa.int64()).take(each),
        pa.array(exact, pa.decimal128(38, 0)).take(each),
        pa.array(fit.whitened(x).ravel()),
        pa.array(np.tile(fit.explained, n)),
        pa.array(np.full(n * k, fit.identity_error)),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_OUT)


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """``vec_id, component, n, deviation, deviation_exact, whitened, explained,
    identity_error`` for each usable row and component."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("vec")
    ).where(usable("vec"))
    rows = rows.select("vec_id", scaled("vec").alias("x"))
    fit = stage_table(rows.select("x").distinct(), "whitening-fit")
    return rows.mapInArrow(_shown(fit_lengths(fit, components)), _OUT_SCHEMA)
