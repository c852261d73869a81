"""Comparing the rows of a bucket with each other, in cells of bounded size.

A row is a node that stands in one bucket per table. A bucket with more than
``BLOCK`` rows is cut into blocks by a hash of the node; every pair of its
blocks is one cell, so all pairs of a bucket are compared, in as many tasks as
it needs. A cell returns what each of its nodes found (links, and one star
link towards the smallest node it reaches there), never its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.rows import salted_join
from corpusloom.session import stage_table

BLOCK = 1024
BLOCK_BYTES = 16 << 20
# Rows of a cell compared at a time with the rest of it.
_STRIPE = 256
# Cells up to this size are compared together, shifted against themselves.
_SMALL = 24
FOUND = "node bigint, links bigint, root bigint"

# near(a, b) says which pairs link: a and b are positions in the columns
# given to it, either of equal length (pairwise) or, with outer=True, all of a
# against all of b. It returns a boolean vector or matrix.
Near = Callable[..., np.ndarray]


def crowd(bytes_: Column, block: int) -> Column:
    """``n`` of a bucket, an aggregate: its rows, or so many that blocks stay under
    ``BLOCK_BYTES`` as well."""
    full = F.ceil(F.sum(bytes_) * block / BLOCK_BYTES)
    return F.greatest(F.count("*"), full).cast("bigint")


def compare(
    rows: DataFrame, load: Callable[[pd.DataFrame], Near], block: int = BLOCK
) -> DataFrame:
    """``node, links, root`` for each node that links in some cell.

    ``rows``: ``bucket`` (int, the table), ``key`` (long), ``node`` (long),
    ``weight`` (long, what a link to the node counts) and whatever ``load``
    reads. A column ``n`` (long) says how many rows a row's bucket has, where that is
    known, or more than that to have smaller blocks (``crowd``). ``load`` gets the rows of some cells and returns ``near``. ``links``
    sums the weights of the nodes linked in that cell.
    """
    if "n" in rows.columns:
        found = rows
    else:
        large = rows.groupBy("bucket", "key").agg(F.count("*").alias("n")).where(F.col("n") > block)
        large = stage_table(large, "large-buckets")
        found = salted_join(rows, large, ["bucket", "key"], "node")
    blocks = F.coalesce(F.ceil(F.col("n") / block), F.lit(1))
    own = F.pmod(F.xxhash64("node", "bucket"), F.col("blocks"))
    cells = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
        lambda j: F.struct(F.least("own", j).alias("lo"), F.greatest("own", j).alias("hi")),
    )
    dealt = (
        found.withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("cell", F.explode(cells))
        .withColumns({"lo": F.col("cell.lo"), "hi": F.col("cell.hi")})
        .drop("n", "blocks", "cell")
    )
    keys = ["bucket", "key", "lo", "hi"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "own", "node")
    return dealt.mapInPandas(_cells(load), FOUND)


def _cells(load):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for batch in batches:
            if not len(batch):
                continue
            held = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            starts = _starts(held)
            cut = starts[-1]  # the last cell may go on in the next batch
            rest = held.iloc[cut:]
            if cut:
                yield _found(held.iloc[:cut], starts[:-1], load)
        if rest is not None:
            yield _found(rest, np.array([0]), load)

    return run


def _starts(held: pd.DataFrame) -> np.ndarray:
    keys = held[["bucket", "key", "lo", "hi"]].to_numpy()
    return np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])


def _found(held: pd.DataFrame, starts: np.ndarray, load) -> pd.DataFrame:
    near = load(held)
    node, weight = held["node"].to_numpy(), held["weight"].to_numpy()
    second = held["own"].to_numpy() == held["hi"].to_numpy()
    crossed = held["lo"].to_numpy() != held["hi"].to_numpy()
    sizes = np.diff(np.r_[starts, len(held)])
    links, label = np.zeros(len(held), np.int64), np.arange(len(held))
    for a, b in _linked_pairs(near, starts, sizes, second, crossed):
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        _spread(label, node, a, b)
    linked = links > 0
    return pd.DataFrame(
        {"node": node[linked], "links": links[linked], "root": node[label[linked]]}
    )


def _linked_pairs(near, starts, sizes, second, crossed):
    """Linked pairs of positions: of all small cells at once, then cell by cell."""
    small = np.repeat(sizes <= _SMALL, sizes)
    ends = np.repeat(starts + sizes, sizes)
    at = np.arange(len(small))
    found = []
    for shift in range(1, int(sizes[sizes <= _SMALL].max(initial=0))):
        a = at[small & (at + shift < ends)]
        b = a + shift
        open_ = ~crossed[a] | (second[a] != second[b])
        a, b = a[open_], b[open_]
        if len(a):
            hit = near(a, b)
            found.append((a[hit], b[hit]))
    if found:
        yield np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
    for start, size in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL]):
        rows = np.arange(start, start + size)
        if crossed[start]:
            left, right = rows[~second[rows]], rows[second[rows]]
        else:
            left = right = rows
        for i in range(0, len(left), _STRIPE):
            stripe = left[i : i + _STRIPE]
            other = right if crossed[start] else right[i:]
            x, y = np.nonzero(near(stripe, other, outer=True))
            x, y = stripe[x], other[y]
            if not crossed[start]:
                x, y = x[x < y], y[x < y]
            yield x, y


def _spread(label: np.ndarray, node: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Label every linked position with that of the smallest node it reaches."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return
        x, y = x[open_], y[open_]
        less = node[x] < node[y]
        low, high = np.where(less, x, y), np.where(less, y, x)
        order = np.argsort(-node[low], kind="stable")
        label[high[order]] = low[order]
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped
