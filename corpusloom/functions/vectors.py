"""Vector expressions (JVM) and the numpy helpers used inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_DIM = 384
CLIP_DIM = 512


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Inner product in double."""
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def squared_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance in double."""
    parts = F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """Unit vector in double; the zero vector stays as it is."""
    length = norm(v)
    return F.when(length == 0, as_double(v)).otherwise(
        F.transform(as_double(v), lambda x: x / length)
    )


def has_dim(v: Column, dim: int) -> Column:
    return F.coalesce(F.size(v) == dim, F.lit(False))


def zeros(dim: int) -> Column:
    """The zero vector."""
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def sanitize(v: Column, dim: int) -> Column:
    """``v`` when it has the right length, else the zero vector."""
    return F.when(has_dim(v, dim), v.cast("array<float>")).otherwise(zeros(dim))


def checksum(v: Column) -> Column:
    """One number that moves with every component and its position."""
    weighted = F.transform(as_double(v), lambda x, i: x * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda s, x: s + x), 4)


def matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    """Stack a column of equal-length vectors."""
    if len(vectors) == 0:
        return np.empty((0, dim))
    return np.vstack(vectors.to_numpy()).astype(np.float64)


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    lengths = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, lengths, out=np.zeros_like(m), where=lengths > 0)
