"""Exact top-k by inner product with a pivot-distance index.

Components are scaled to whole numbers, so scores are exact. One more
coordinate, ``sqrt(M - |x|^2)`` with ``M`` the largest squared length, turns the
largest inner product into the smallest distance. Each vector belongs to its
nearest pivot and is keyed by the distance to it; the index is stored in rings
around the pivots and sorted by distance inside them, so a run of rows is an
annulus around its pivot.

A search expands rings outwards. The triangle inequality bounds how near a ring
can come to a query. Each query begins with the rings it is nearest to and takes
further ones in order, in waves that hold ``WAVE_GROWTH`` times as many rows each;
a ring that is farther than the query's k-th best so far is left out, and the
search stops when that holds for all rings left. A wave is one job that reads only
the rings some query asks for; inside a ring annuli are left out the same way. The
k-th best of a sample gives each query a bound to begin with. Bounds only save
products: results are exact.

Queries are searched in blocks of bounded size; a task returns at most k rows per
query, and the driver sees a number per query and a row per ring (at most ``PIVOTS``
times ``RINGS``). Pivots are fitted on at most ``SAMPLE_ROWS`` rows, chosen by a
hash; every row is indexed.

Defined cases: vectors that are null, empty or hold null or non-finite components
take no part, nor do those with a component beyond ``+-2**50``, which scaled leave
no room for exact sums. Vectors of different lengths have no inner product: each
length is searched on its own. Where components are so large that a score may leave
64 bits, products and ranks are computed in whole numbers of any size; a score that
does leave them is returned as the nearest number of 64 bits. Rows with a null id
are candidates but no queries. Rows that repeat an id are queries and candidates of
their own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.vectors_dedup import finite
from corpusloom.session import fresh_path, stage_table

SCALE = 256
BOUND = float(1 << 50)
PIVOTS = 64
RINGS = 16
SAMPLE_ROWS = 2048
QUERY_BLOCK = 4096
# Rows of a query's first rings at least, and how many times more each wave takes.
FIRST_ROWS = 1024
WAVE_GROWTH = 8
SEED = 23
_ANNULUS = 512
_RING_ROWS = 4096
_EXACT = float(1 << 53)
_LONG = 1 << 63
_LOWEST = -(10**38)
_LAST_ID = _LONG - 1


def scaled(vec: str, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component, in double precision."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, as Python's own where 64 bits
    may not hold them."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < _EXACT:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < _LONG / 2:
        return a @ b.T
    return a.astype(object) @ b.T.astype(object)


def _lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    own = (rows.astype(np.float64) ** 2).sum(axis=1)
    return np.c_[rows, np.sqrt(np.maximum(longest - own, 0))]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def fit_pivots(sample: np.ndarray, longest: float, n: int = PIVOTS) -> np.ndarray:
    """Centres of the sample by a few rounds of Lloyd's algorithm."""
    points = _lifted(sample, longest)
    pick = np.random.default_rng(SEED).permutation(len(points))[:n]
    centres = points[np.sort(pick)]
    for _ in range(5):
        nearest = _distances(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centres))
        has = counts > 0
        centres[has] = sums[has] / counts[has][:, None]
    return centres


def _keyed(pivots: np.ndarray, longest: float, rings: int):
    """Pivot, distance and ring; lifted vectors are at most ``2 sqrt(M)`` apart."""
    width = max(2 * np.sqrt(longest) / rings, 1e-300)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            far = _distances(_lifted(np.stack(batch["x"].to_numpy()), longest), pivots)
            pivot = far.argmin(axis=1)
            distance = far[np.arange(len(far)), pivot]
            ring = np.minimum(distance / width, rings - 1).astype(np.int64)
            yield batch.assign(pivot=pivot, distance=distance, cell=pivot * rings + ring)

    return run


_NONE = np.zeros(0, np.int64)


class _Best:
    """The k best candidates per query: by score, then by the smaller id."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor
        self.held = [np.zeros(0, np.int64) for _ in range(3)]
        self.waiting: list = []
        self.n = 0

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        self.waiting.append((query, ids, score))
        self.n += len(query)
        if self.n > 1 << 20:
            self.prune()

    def prune(self) -> None:
        parts = [tuple(self.held), *self.waiting]
        query, ids, score = (np.concatenate([p[i] for p in parts]) for i in range(3))
        self.waiting, self.n = [], 0
        if not len(query):
            return
        order = _ranked(query, ids, score)
        query, ids, score = query[order], ids[order], score[order]
        starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        place = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
        keep = place < self.k
        self.held = [query[keep], ids[keep], score[keep]]
        last = place == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], score[last])


def _ranked(query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> np.ndarray:
    if score.dtype == object:  # lexsort takes no whole numbers of any size
        return np.array(sorted(range(len(ids)), key=lambda i: (query[i], -score[i], ids[i])), int)
    return np.lexsort((ids, -score, query))


def _gaps(to_pivot: np.ndarray, low, high) -> np.ndarray:
    """How near what lies between two distances of a pivot can come."""
    return np.maximum(np.maximum(to_pivot - high, low - to_pivot), 0)


def _most(reach: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """No vector at least so far away scores higher; the slack covers rounding."""
    return (reach - gap * gap) / 2 + 1e-6 * reach + 1


def _search(sent, k: int):
    """One pass over some rings for the queries that were sent out; ``asked`` says
    per cell which queries take it in this wave."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_row, queries, floor, pivots, longest, asked, wide = sent.value
        # A query has nothing in the coordinate that was added.
        to_pivot = _distances(np.c_[queries, np.zeros(len(queries))], pivots)
        reach = (queries.astype(np.float64) ** 2).sum(axis=1) + longest
        best = _Best(floor.copy(), k)
        for batch in batches:
            for rows in _annuli(batch):
                pivot = rows["pivot"].iloc[0]
                takes = asked.get(int(rows["cell"].iloc[0]), _NONE)
                distance = rows["distance"]
                gap = _gaps(to_pivot[takes, pivot], distance.min(), distance.max())
                live = takes[_most(reach[takes], gap) >= best.floor[takes]]
                if not len(live):
                    continue
                scores = _products(queries[live], np.stack(rows["x"].to_numpy()))
                at_row = rows["row"].to_numpy()
                x, y = np.nonzero(scores >= best.floor[live][:, None])
                other = own_row[live[x]] != at_row[y]
                x, y = x[other], y[other]
                best.add(live[x], rows["vec_id"].to_numpy()[y], scores[x, y])
                best.prune()
        best.prune()
        query, ids, score = best.held
        if wide:
            score = [Decimal(int(x)) for x in score]
        yield pd.DataFrame({"query": own_row[query], "vec_id": ids, "score": score})

    return run


def _annuli(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Runs of one pivot, of bounded length, in order of distance.

    A batch may cross files, which come in any order, so a run also ends where
    the distance falls.
    """
    pivot, distance = batch["cell"].to_numpy(), batch["distance"].to_numpy()
    new = (pivot[1:] != pivot[:-1]) | (distance[1:] < distance[:-1])
    starts = np.flatnonzero(np.r_[True, new]) if len(pivot) else []
    for start, stop in zip(starts, np.r_[starts[1:], len(pivot)] if len(pivot) else []):
        for at in range(start, stop, _ANNULUS):
            yield batch.iloc[at : min(at + _ANNULUS, stop)]


def _matrix(rows, dim: int) -> np.ndarray:
    return np.array([r["x"] for r in rows], np.int64).reshape(len(rows), dim)


def _index(rows: DataFrame, centres: np.ndarray, longest: float, rings: int) -> str:
    """Writes ``vec_id, row, x, pivot, distance`` by cell (a ring of a pivot)."""
    schema = "vec_id bigint, row bigint, x array<bigint>, pivot int, distance double, cell int"
    index = rows.select("vec_id", "row", "x").mapInPandas(_keyed(centres, longest, rings), schema)
    order = ["cell", "distance", "row"]
    path = fresh_path(rows.sparkSession, "topk-index")
    index = index.repartitionByRange(*order).sortWithinPartitions(*order)
    index.write.partitionBy("cell").parquet(path)
    return path


class _Rings:
    """What the driver knows of the index: a row per ring."""

    def __init__(self, index: DataFrame, rings: int):
        held = index.groupBy("cell").agg(
            F.min("distance").alias("low"), F.max("distance").alias("high"), F.count("*").alias("n")
        )
        found = held.toPandas()
        self.cell = found["cell"].to_numpy(np.int64)
        self.pivot = self.cell // rings
        self.low, self.high, self.n = (found[c].to_numpy() for c in ("low", "high", "n"))

    def waves(self, to_pivot: np.ndarray, reach: np.ndarray, floor):
        """Per wave ``{cell: queries}``, nearest rings first; ``floor`` is asked
        for the k-th best so far before each one."""
        gap = _gaps(to_pivot[:, self.pivot], self.low, self.high)
        most = _most(reach[:, None], gap)
        order = np.argsort(gap, axis=1, kind="stable")
        place = np.argsort(order, axis=1, kind="stable")
        # Rows in the rings before each one, in the query's own order.
        ahead = np.cumsum(self.n[order], axis=1) - self.n[order]
        ahead = np.take_along_axis(ahead, place, axis=1)
        done, size = np.zeros(gap.shape, bool), FIRST_ROWS
        while not done.all():
            open_ = ~done & (most >= floor()[:, None])
            if not open_.any():
                return  # every ring left is too far for every query
            now = open_ & (ahead < size)
            done |= (ahead < size) | ~open_
            size *= WAVE_GROWTH
            if now.any():
                yield {
                    int(c): np.flatnonzero(now[:, i]) for i, c in enumerate(self.cell) if now[:, i].any()
                }


def _best_of(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _top_of_length(
    usable: DataFrame, dim: int, is_query: Column, k: int, n_pivots: int, query_block: int
) -> DataFrame | None:
    """``query, rank, vec_id, score`` among vectors of one length."""
    spark = usable.sparkSession
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    largest = F.array_max(F.transform("x", lambda v: F.abs(v)))
    n, longest, most = usable.agg(F.count("*"), F.max(square), F.max(largest)).first()
    wide = float(most) ** 2 * dim >= _LONG / 2
    kind = object if wide else np.int64
    lowest = _LOWEST if wide else np.iinfo(np.int64).min
    turn = F.xxhash64("row", F.lit(SEED))
    sample = usable.select("vec_id", "row", "x").orderBy(turn, "row").limit(SAMPLE_ROWS).collect()
    sample_x, sample_row = _matrix(sample, dim), np.array([r["row"] for r in sample])
    # Small tables have few pivots and rings, so that none is nearly empty.
    n_pivots = int(min(n_pivots, max(1, np.ceil(np.sqrt(n) / 2))))
    rings = int(min(max(n // (n_pivots * _RING_ROWS), 4), RINGS))
    centres = fit_pivots(sample_x, longest, n_pivots)
    path = _index(usable, centres, longest, rings)
    index = spark.read.parquet(path)
    known = _Rings(index, rings)
    queries = stage_table(
        usable.where(~F.col("nameless")).where(is_query).select("row", "x"), "topk-queries"
    )
    n_blocks = -(-queries.count() // query_block)
    score = "decimal(38,0)" if wide else "bigint"
    out = None
    for block in range(n_blocks):
        in_block = F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == block
        some = queries.where(in_block).collect()
        if not some:
            continue
        x, own = _matrix(some, dim), np.array([r["row"] for r in some])
        floors = np.full(len(x), lowest, kind)
        if len(sample) > k:
            seen = _products(x, sample_x).astype(kind)
            seen[own[:, None] == sample_row] = lowest
            floors = np.sort(seen, axis=1)[:, -k]
        number = {int(r): i for i, r in enumerate(own)}
        # A query has nothing in the coordinate that was added.
        to_pivot = _distances(np.c_[x, np.zeros(len(x))], centres)
        reach = (x.astype(np.float64) ** 2).sum(axis=1) + longest
        best = None
        for asked in known.waves(to_pivot, reach, lambda: floors):
            sent = spark.sparkContext.broadcast((own, x, floors, centres, longest, asked, wide))
            rows = index.where(F.col("cell").isin(list(asked)))
            hits = rows.mapInPandas(_search(sent, k), f"query bigint, vec_id bigint, score {score}")
            if best is not None:
                hits = hits.unionByName(best.drop("rank"))
            # Written, so that a wave is over before the next one is sent.
            best = stage_table(_best_of(hits, k), "topk-best")
            sent.unpersist()
            for r in best.where(F.col("rank") == k).select("query", "score").collect():
                at = number[r["query"]]
                floors[at] = max(floors[at], int(r["score"]))
        if best is not None:
            out = best if out is None else out.unionByName(best)
    return out


def _matrix(rows, dim: int) -> np.ndarray:
    return np.array([r["x"] for r in rows], np.int64).reshape(len(rows), dim)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = SCALE,
    pivots: int = PIVOTS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row its ``k`` highest
    scores among all other rows, ties to the smaller id.

    ``is_query`` is a condition on a column named ``vec_id``.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("vec"))
    small = F.forall("vec", lambda x: F.abs(x.cast("double")) <= BOUND)
    usable = rows.where(finite("vec") & (F.size("vec") > 0) & small).select(
        # A null id goes after all others among equal scores.
        F.coalesce("vec_id", F.lit(_LAST_ID)).alias("vec_id"),
        F.col("vec_id").isNull().alias("nameless"),
        F.monotonically_increasing_id().alias("row"),
        scaled("vec", scale).alias("x"),
    )
    usable = stage_table(usable, "topk-rows")
    out = None
    for r in usable.groupBy(F.size("x").alias("dim")).count().orderBy("dim").collect():
        own = usable.where(F.size("x") == r["dim"])
        best = _top_of_length(own, r["dim"], is_query, k, pivots, query_block)
        if best is not None:
            best = best.withColumn("score", _as_long(F.col("score")))
            out = best if out is None else out.unionByName(best)
    if out is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    names = usable.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return out.join(names, "query").select(
        "query_id",
        F.col("rank").cast("int").alias("rank"),
        F.nullif("vec_id", F.lit(_LAST_ID)).alias("vec_id"),
        "score",
    )


def _as_long(score: Column) -> Column:
    bounds = [F.lit(x).cast("decimal(38,0)") for x in (str(-_LONG), str(_LONG - 1))]
    inside = F.greatest(F.least(score.cast("decimal(38,0)"), bounds[1]), bounds[0])
    return inside.cast("bigint")
