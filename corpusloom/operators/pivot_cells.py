"""Exact similarity joins of unit vectors in cells around pivots.

Every vector lives in the cell of its nearest pivot. A vector within a given
angle (the reach) of another one can only live in cells that three bounds
leave open, whatever the data:

* hyperplane: cell q holds what is nearer to q than to any other pivot, so q is
  open to x of cell p only if x is at most the reach behind the plane between p
  and q;
* far: q is no farther from x than the cell's largest angle and the reach;
* near: q is no nearer to x than the cell's smallest angle less the reach.

The number of pivots grows with the rows (``N ** 0.4``) and they are fitted to a
sample, so dense regions get more and smaller cells. Even where no bound excludes
anything, which is so for directions without any structure, a row is dealt at most
once per two bundles. Cells with more rows than fit a worker are split into blocks;
near blocks are bundled, so that a row travels once to all of a bundle. Up to as many
rows as fit the workers there are 48 bundles and rows dealt grow with their number,
at most 24 times for each; from there on more bundles are needed.

A pair meets once: of two bundles one visits the other, by turns around the ring of
bundles, so that none gets more visitors than others. Rows of a bundle come before
its visitors, which stream past in batches.

Pairs are screened in single precision, for long vectors and high thresholds by the
products along the 64 directions that hold most of a block and the Cauchy-Schwarz
bound of what is left; what is close to the threshold is confirmed in double.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import vectors

# Memory that the home rows of a block may take in a worker.
BLOCK_BYTES = 64 * 1024 * 1024
MOST_PIVOTS = 2048
_LEAST_PIVOTS = 8
# Cells are dealt in so many bundles, more where their rows would not fit a worker.
_BUNDLES = 48
_SAMPLE_ROWS = 4096
_SAMPLE_PER_PIVOT = 8
_LLOYD = 3
# Slack for the single-precision screen and for angles.
SLACK = 1e-4
_STRIPE = 256
_BLOCK = 1024
# Pairs near the threshold whose vectors are held in double at a time.
_CONFIRM = 4096
# Components of the screen, home rows it is fitted to, and spots that order rows.
_LEADING = 64
_FITTED = 2048
_SPOTS = 32
_SEED = 5


def block_rows_of(dim: int) -> int:
    return int(min(max(BLOCK_BYTES // (8 * dim), 256), 65536))


def unit_of(batch: pd.DataFrame) -> np.ndarray:
    """Unit rows of ``vec``: lists, or the bytes of single-precision components."""
    first = batch["vec"].iloc[0] if len(batch) else []
    if isinstance(first, bytes):
        rows = np.frombuffer(b"".join(batch["vec"]), np.float32).reshape(len(batch), -1)
        return vectors.unit_rows(rows.astype(np.float64))
    return vectors.unit_rows(vectors.matrix(batch["vec"], len(first)))


def mixed(pos: np.ndarray) -> np.ndarray:
    """A hash of whole numbers, not negative."""
    x = pos.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(8)).astype(np.int64)


@dataclass(frozen=True)
class Cells:
    """Pivots (unit rows) and per cell how many rows it holds, the smallest and
    largest angle to its pivot, and the number of blocks it is split into. ``bundle``
    is the bundle of each block; without it each is one of its own."""

    pivots: np.ndarray
    counts: np.ndarray
    near: np.ndarray
    far: np.ndarray
    blocks: np.ndarray
    reach: float = 0.0
    bundle: np.ndarray | None = None

    def place(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Products with the pivots, and the cell of each row."""
        dots = unit @ self.pivots.T
        return dots, dots.argmax(axis=1)

    def open(self, dots: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Which cells may hold a row within the reach, per row."""
        angles = np.arccos(np.clip(dots, -1, 1))
        own = dots[np.arange(len(home)), home][:, None]
        most = (np.sin(min(self.reach, np.pi / 2)) + SLACK) * self._apart[home]
        behind = own - dots <= most + 1e-9
        ring = (angles <= self.far + self.reach + SLACK) & (angles >= self.near - self.reach - SLACK)
        return (behind & ring | (np.arange(dots.shape[1]) == home[:, None])) & (self.counts > 0)

    @cached_property
    def _apart(self) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * (self.pivots @ self.pivots.T), 0))

    def first_block(self) -> np.ndarray:
        return np.r_[0, np.cumsum(self.blocks)]

    def own_block(self, home: np.ndarray, pos: np.ndarray) -> np.ndarray:
        return self.first_block()[home] + mixed(pos) % self.blocks[home]

    def blocks_of(self, open_: np.ndarray) -> list[np.ndarray]:
        """All blocks of the cells that are open to each row."""
        row, cell = np.nonzero(open_)
        n = self.blocks[cell]
        base = np.repeat(self.first_block()[cell] - np.cumsum(n) + n, n)
        found = base + np.arange(len(base))
        ends = np.cumsum(np.bincount(np.repeat(row, n), minlength=len(open_)))
        return np.split(found, ends[:-1])

    def dealt(
        self, unit: np.ndarray, pos: np.ndarray, goes: np.ndarray | None = None
    ) -> tuple[np.ndarray, list[np.ndarray]]:
        """Per row its bundle of blocks and those it visits so that each pair meets once.
        With ``goes`` those rows visit all bundles and the others none: pairs of the
        others alone do not meet."""
        dots, home = self.place(unit)
        open_ = self.open(dots, home)
        own = self._bundle[self.own_block(home, pos)]
        row, bundle = np.nonzero(open_ @ self._holds)
        n = self._holds.shape[1]
        if goes is None:
            ahead = (bundle - own[row]) % n
            turn = (ahead > 0) & (2 * ahead < n)
            turn |= (2 * ahead == n) & (bundle > own[row])
        else:
            turn = goes[row] & (bundle != own[row])
        ends = np.cumsum(np.bincount(row[turn], minlength=len(home)))
        return own, np.split(bundle[turn], ends[:-1])

    @property
    def _bundle(self) -> np.ndarray:
        return np.arange(self.blocks.sum()) if self.bundle is None else self.bundle

    @cached_property
    def _holds(self) -> np.ndarray:
        """Which bundles hold blocks of each cell."""
        held = np.zeros((len(self.blocks), self._bundle.max() + 1), bool)
        held[np.repeat(np.arange(len(self.blocks)), self.blocks), self._bundle] = True
        return held

    def bundled(self, block_rows: int) -> Cells:
        """``cells`` whose blocks are bundled with near ones. Decided once, on the
        driver: every task must deal in the same way."""
        cell = np.repeat(np.arange(len(self.blocks)), self.blocks)
        sizes = self.counts[cell] / self.blocks[cell]
        want = max(_BUNDLES, int(np.ceil(2 * sizes.sum() / block_rows)))
        return replace(self, bundle=_bundles(self.pivots[cell], sizes, want))

    def with_rows(self, counts, near, far, block_rows: int, threshold: float) -> Cells:
        reach = float(np.arccos(min(threshold, 1.0)))
        blocks = np.maximum(-(-counts // block_rows), 1)
        return replace(self, counts=counts, near=near, far=far, blocks=blocks, reach=reach)


def _bundles(places: np.ndarray, sizes: np.ndarray, want: int) -> np.ndarray:
    """About ``want`` bundles of near places with about equal sums of ``sizes``: the
    places are cut across the direction in which they spread most, again and again."""
    out, made, todo = np.zeros(len(sizes), np.int64), 0, [(np.arange(len(sizes)), want)]
    while todo:
        some, n = todo.pop()
        if n <= 1 or len(some) <= 1:
            out[some], made = made, made + 1
            continue
        apart = places[some] - places[some].mean(axis=0)
        along = apart @ np.linalg.svd(apart, full_matrices=False)[2][0]
        some = some[np.argsort(along, kind="stable")]
        held = np.cumsum(sizes[some])
        cut = int(np.searchsorted(held, held[-1] * (n // 2) / n)) + 1
        cut = min(max(cut, 1), len(some) - 1)
        todo += [(some[:cut], n // 2), (some[cut:], n - n // 2)]
    return out


def bare(pivots: np.ndarray) -> Cells:
    n = len(pivots)
    one = np.ones(n, np.int64)
    return Cells(np.ascontiguousarray(pivots, float), one, np.zeros(n), np.full(n, np.pi), one)


def fit_pivots(rows: DataFrame, n: int) -> np.ndarray | None:
    """Centres of a bounded sample of ``rows`` (``pos, vec``), chosen by a hash."""
    want = int(min(max(np.ceil(n**0.4), _LEAST_PIVOTS), MOST_PIVOTS, max(n, 1)))
    target = max(_SAMPLE_ROWS, _SAMPLE_PER_PIVOT * want)
    some = rows
    if n > target:
        some = rows.where(F.pmod(F.xxhash64("pos"), F.lit(n)) < target)
    sample = some.select("pos", "vec").toPandas().sort_values("pos", ignore_index=True)
    if not len(sample):
        return None
    unit = unit_of(sample)
    rng = np.random.default_rng(_SEED)
    pivots = unit[np.sort(rng.permutation(len(unit))[:want])]
    for _ in range(_LLOYD):
        home = (unit @ pivots.T).argmax(axis=1)
        sums = np.zeros_like(pivots)
        np.add.at(sums, home, unit)
        lengths = np.linalg.norm(sums, axis=1)
        has = lengths > 1e-9
        pivots[has] = sums[has] / lengths[has][:, None]
    return pivots


def measure(rows: DataFrame, cells: Cells) -> DataFrame:
    """``cell, n, near, far`` of the cells that hold rows."""

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                dots, home = cells.place(unit_of(batch))
                own = np.clip(dots[np.arange(len(home)), home], -1, 1)
                yield pd.DataFrame({"cell": home, "angle": np.arccos(own)})

    return (
        rows.select("vec")
        .mapInPandas(placed, "cell int, angle double")
        .groupBy("cell")
        .agg(F.count("*").alias("n"), F.min("angle").alias("near"), F.max("angle").alias("far"))
    )


def measured(cells: Cells, held: list, threshold: float, block_rows: int) -> Cells:
    """``cells`` with what ``measure`` found (a row per cell)."""
    n = len(cells.pivots)
    counts, near, far = np.zeros(n, np.int64), np.full(n, np.inf), np.full(n, -np.inf)
    for row in held:
        counts[row["cell"]], near[row["cell"]], far[row["cell"]] = row["n"], row["near"], row["far"]
    return cells.with_rows(counts, near, far, block_rows, threshold)


def fit(rows: DataFrame, threshold: float, block_rows: int) -> Cells | None:
    """Cells for ``rows`` (``pos, vec``); None for an empty table."""
    pivots = fit_pivots(rows, rows.count())
    if pivots is None:
        return None
    cells = bare(pivots)
    held = measure(rows, cells).collect()
    return measured(cells, held, threshold, block_rows).bundled(block_rows)


def deal(state: DataFrame, cells: Cells, few_open: bool = False) -> DataFrame:
    """``pos, vec, open, home, visits``: the bundle of each row and those it visits,
    with ``vec`` as bytes. Where few rows are undecided, these visit and the others
    stay where they live."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                goes = batch["open"].to_numpy() if few_open else None
                own, visits = cells.dealt(unit_of(batch), batch["pos"].to_numpy(), goes)
                packed = [np.asarray(v, np.float32).tobytes() for v in batch["vec"]]
                yield batch.assign(vec=packed, home=own, visits=visits)

    schema = "pos bigint, vec binary, open boolean, home int, visits array<int>"
    return state.select("pos", "vec", "open").mapInPandas(run, schema)


def gathered(placed: DataFrame) -> DataFrame:
    """A row per bundle that a row lives in or visits, home rows first."""
    ways = F.array(
        F.struct(F.lit(True).alias("lives"), F.array("home").alias("blocks")),
        F.struct(F.lit(False).alias("lives"), F.col("visits").alias("blocks")),
    )
    return (
        placed.select("pos", "vec", "open", F.inline(ways))
        .select("pos", "vec", "open", "lives", F.explode("blocks").alias("block"))
        .repartition("block")
        .sortWithinPartitions("block", F.desc("lives"))
    )


# -- inside a block ----------------------------------------------------------


@dataclass(frozen=True)
class _Side:
    """Some rows in an order in which near ones are close together: their places,
    themselves, and what bounds their products (None: nothing does)."""

    at: np.ndarray
    rows: np.ndarray
    bound: np.ndarray | None

    def some(self, which) -> _Side:
        bound = None if self.bound is None else self.bound[which]
        return _Side(self.at[which], self.rows[which], bound)


class _Screen:
    """Which pairs with the home rows of a block may be over the threshold. The bound
    is taken along the directions in which the home rows are longest."""

    def __init__(self, home: np.ndarray, threshold: float):
        self.least = threshold - SLACK
        self.turn = None
        if home.shape[1] >= 2 * _LEADING and threshold >= 0.8 and len(home) >= _BLOCK:
            some = home[:: -(-len(home) // _FITTED)]
            self.turn = np.linalg.eigh(some.T @ some)[1][:, -_LEADING:]
            self._spots = some[:: -(-len(some) // _SPOTS)] @ self.turn

    def load(self, rows: np.ndarray) -> _Side:
        if self.turn is None:
            return _Side(np.arange(len(rows)), rows.astype(np.float32), None)
        lead = rows @ self.turn
        order = np.argsort((lead @ self._spots.T).argmax(axis=1), kind="stable")
        lead = lead[order]
        rest = np.sqrt(np.maximum(1 - (lead * lead).sum(axis=1), 0))
        bound = np.column_stack([lead, rest]).astype(np.float32)
        return _Side(order, rows[order].astype(np.float32), bound)

    def near(self, a: _Side, b: _Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of pairs that may be over the threshold, and their products."""
        if a.bound is not None:
            may = a.bound @ b.bound.T > self.least
            a, b = a.some(may.any(axis=1)), b.some(may.any(axis=0))
        products = a.rows @ b.rows.T
        i, j = np.nonzero(products > self.least)
        return a.at[i], b.at[j], products[i, j]


class Block:
    """The home rows of one block. ``pairs`` gives what they and other rows have
    over the threshold."""

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.rows, self.pos, self.open = None, np.zeros(0, np.int64), np.zeros(0, bool)
        self._loaded = self._undecided = self._screen = None

    def live(self, part: pd.DataFrame) -> None:
        rows = unit_of(part)
        self.rows = rows if self.rows is None else np.concatenate([self.rows, rows])
        self.pos = np.r_[self.pos, part["pos"].to_numpy()]
        self.open = np.r_[self.open, part["open"].to_numpy()]
        self._loaded = None

    def pairs(self, part: pd.DataFrame | None) -> Iterator[tuple]:
        """``a, b, pos, open``: places of pairs among ``part``, or among the home
        rows each once when it is None, and in the home rows; positions and states
        of what ``a`` points at. The later row of a pair is undecided."""
        if self.rows is None:
            return
        if self._loaded is None:
            self._screen = _Screen(self.rows, self.threshold)
            self._loaded = self._screen.load(self.rows)
            self._undecided = self._loaded.some(self.open[self._loaded.at])
        same = part is None
        rows = self.rows if same else unit_of(part)
        pos = self.pos if same else part["pos"].to_numpy()
        open_ = self.open if same else part["open"].to_numpy()
        # What is decided already is only compared with what is not.
        if same:
            sides = [(self._undecided, self._loaded)]
        else:
            mine = self._screen.load(rows)
            waits = open_[mine.at]
            sides = [(mine.some(waits), self._loaded), (mine.some(~waits), self._undecided)]
        for left, right in sides:
            for a, b, product in self._near(left, right, same):
                later = np.where(pos[a] > self.pos[b], open_[a], self.open[b])
                a, b, product = a[later], b[later], product[later]
                sure = product > self.threshold + SLACK
                for k in range(0, len(a), _CONFIRM):
                    i = np.flatnonzero(~sure[k : k + _CONFIRM]) + k
                    exact = np.einsum("ij,ij->i", rows[a[i]], self.rows[b[i]])
                    sure[i] = exact > self.threshold
                yield a[sure], b[sure], pos, open_

    def _near(self, left: _Side, right: _Side, same: bool) -> Iterator[tuple]:
        turn = np.empty(len(self.rows), np.int64)
        turn[self._loaded.at] = np.arange(len(self.rows))
        for i in range(0, len(left.at), _STRIPE):
            some = left.some(slice(i, i + _STRIPE))
            for j in range(0, len(right.at), _BLOCK):
                other = right.some(slice(j, j + _BLOCK))
                if not same:
                    yield self._screen.near(some, other)
                    continue
                # Two undecided rows meet both ways; one of them is taken.
                if turn[other.at[-1]] < turn[some.at[0]] and self.open[other.at].all():
                    continue
                a, b, product = self._screen.near(some, other)
                once = (turn[a] < turn[b]) | ~self.open[b]
                a, b, product = a[once], b[once], product[once]
                yield np.minimum(a, b), np.maximum(a, b), product


def meet(threshold: float, found):
    """Goes through gathered rows block by block; ``found(block, part)`` yields
    frames for visitors, and with ``part`` None for the home rows alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, block = None, None
        for batch in batches:
            for group, rows in batch.groupby("block", sort=False):
                if group != at:
                    if block is not None:
                        yield from found(block, None)
                    at, block = group, Block(threshold)
                lives = rows["lives"].to_numpy()
                if lives.any():
                    block.live(rows[lives])
                if not lives.all():
                    yield from found(block, rows[~lives])
        if block is not None:
            yield from found(block, None)

    return run


def dealing(rows: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """One row: ``vectors, cells, blocks, rows_dealt`` of the join of ``rows``
    (``pos, vec``) with itself; what is shuffled, counted without shuffling it."""
    spark = rows.sparkSession
    cells = fit(rows, threshold, block_rows)
    schema = "vectors bigint, cells bigint, blocks bigint, rows_dealt bigint"
    if cells is None:
        return spark.createDataFrame([(0, 0, 0, 0)], schema)
    placed = deal(rows.withColumn("open", F.lit(True)), cells)
    return placed.agg(
        F.count("*").alias("vectors"),
        F.lit(len(cells.pivots)).cast("bigint").alias("cells"),
        F.lit(int(cells.blocks.sum())).cast("bigint").alias("blocks"),
        F.sum(F.size("visits") + F.lit(1)).alias("rows_dealt"),
    )
