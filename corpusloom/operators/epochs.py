"""Epoch order without a sort: a keyed bijection over positions.

An epoch goes through shards in a shuffled order and through the rows of each shard
in an order of their own, so a loader opens one shard after the other. Both orders
are bijections that are computed, not stored: a position becomes a pair (left, right)
in a grid of about ``sqrt(n) x sqrt(n)`` cells, and in turn a hash of one half is added
to the other (a Feistel network over the halves' own sizes). The grid has a few cells
more than there are positions; a result outside is sent through again until it falls
inside, which keeps the map a bijection.

So ``position_of`` a row and ``row_at`` a position cost the same few hashes wherever
they are: an epoch resumes anywhere in constant time, nothing is shuffled or sorted,
and two loaders with the same seed agree without talking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 6
# A position outside the grid's use comes back at most as often as the grid has spare
# cells, which are fewer than its side: this covers sides up to it, and beyond it has
# a chance under side ** -32 to fail.
_WALKS = 32


def _whole(x: Column | int) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("bigint")


def _noise(key: Column, step: Column, half: Column) -> Column:
    """32 bits of a hash."""
    mark = F.md5(F.concat_ws(":", key, step.cast("string"), half.cast("string")))
    return F.conv(F.substring(mark, 1, 8), 16, 10).cast("bigint")


def _sides(n: Column) -> tuple[Column, Column]:
    a = F.greatest(F.ceil(F.sqrt(n)).cast("bigint"), F.lit(1).cast("bigint"))
    return a, F.ceil(n / a).cast("bigint")


def _once(x: Column, n: Column, key: Column, back: bool) -> Column:
    """One pass through the network, forwards or back: in turn the hash of one half
    is added to the other, or taken away."""
    a, b = _sides(n)
    sign = F.lit(-1 if back else 1).cast("bigint")

    def turned(p: Column, step: Column) -> Column:
        left = F.pmod(p["l"] + sign * _noise(key, step, p["r"]), a)
        right = F.pmod(p["r"] + sign * _noise(key, step, p["l"]), b)
        even = step % 2 == 0
        return F.struct(
            F.when(even, left).otherwise(p["l"]).alias("l"),
            F.when(even, p["r"]).otherwise(right).alias("r"),
        )

    steps = [F.lit(k) for k in range(_STEPS)]
    pair = F.struct(F.floor(x / b).cast("bigint").alias("l"), F.pmod(x, b).alias("r"))
    return F.aggregate(
        F.array(*(reversed(steps) if back else steps)), pair, turned, lambda p: p["l"] * b + p["r"]
    )


def _walked(x: Column, n: Column, key: Column, back: bool) -> Column:
    walks = F.sequence(F.lit(1), F.lit(_WALKS))
    return F.aggregate(
        walks, _once(x, n, key, back), lambda y, _: F.when(y < n, y).otherwise(_once(y, n, key, back))
    )


def permuted(x: Column, n: Column | int, key: Column) -> Column:
    """A bijection of 0 … n - 1 that ``key`` (a string) chooses."""
    return _walked(_whole(x), _whole(n), key, back=False)


def unpermuted(y: Column, n: Column | int, key: Column) -> Column:
    """The ``x`` that ``permuted`` sends to ``y``."""
    return _walked(_whole(y), _whole(n), key, back=True)


class Epoch:
    """One epoch over ``n`` rows in shards of ``shard_size``, the last one maybe
    shorter. Rows are named by their position in the version."""

    def __init__(self, n: int, shard_size: int, seed: int, epoch: int):
        if n < 0 or shard_size < 1:
            raise ValueError("needs rows and a shard size of at least 1")
        self.n, self.size = n, shard_size
        self.shards = -(-n // shard_size)
        self.short = self.shards * shard_size - n  # what the last shard lacks
        self.key = f"{seed}:{epoch}"

    def _inner(self, shard: Column) -> tuple[Column, Column]:
        """Rows of a shard, and the key of their order."""
        last = shard == self.shards - 1
        held = F.when(last, F.lit(self.size - self.short)).otherwise(F.lit(self.size))
        return held.cast("bigint"), F.concat_ws(":", F.lit(self.key), shard.cast("string"))

    def _last_place(self) -> Column:
        """Where the last shard, the short one, stands in the order of shards."""
        return unpermuted(F.lit(self.shards - 1), self.shards, F.lit(self.key))

    def position_of(self, row: Column) -> Column:
        """Where a row stands in the epoch."""
        row = _whole(row)
        shard = F.floor(row / self.size).cast("bigint")
        place = unpermuted(shard, self.shards, F.lit(self.key))
        missing = F.when(self._last_place() < place, F.lit(self.short)).otherwise(F.lit(0))
        held, key = self._inner(shard)
        return place * self.size - missing + unpermuted(row - shard * self.size, held, key)

    def row_at(self, position: Column) -> Column:
        """The row at a position of the epoch."""
        position = _whole(position)
        # Behind the short shard everything stands ``short`` earlier.
        last = self._last_place()
        behind = position >= last * self.size + (self.size - self.short)
        even = F.when(behind, position + self.short).otherwise(position)
        place = F.floor(even / self.size).cast("bigint")
        shard = permuted(place, self.shards, F.lit(self.key))
        held, key = self._inner(shard)
        return shard * self.size + permuted(even - place * self.size, held, key)


def epoch_rows(
    items: DataFrame, n: int, shard_size: int, seed: int, epoch: int, resume_at: int = 0
) -> DataFrame:
    """``items`` (``pos`` from 0 to n - 1) with ``shard_idx`` and ``epoch_pos``, those
    from ``resume_at`` on. A projection and a filter: rows stay where they are."""
    order = Epoch(n, shard_size, seed, epoch)
    if not n:
        none = F.lit(None).cast("bigint")
        return items.withColumns({"shard_idx": none, "epoch_pos": none}).where(F.lit(False))
    placed = items.withColumns(
        {
            "shard_idx": F.floor(F.col("pos") / shard_size).cast("bigint"),
            "epoch_pos": order.position_of(F.col("pos")),
        }
    )
    return placed.where(F.col("epoch_pos") >= resume_at)


def loader_plan(
    items: DataFrame, n: int, shard_size: int, seed: int, epoch: int, start: int, count: int
) -> DataFrame:
    """``epoch_pos`` and the item at each of ``count`` positions from ``start`` on:
    what a loader reads next, found from the positions and not from the rows."""
    spark = items.sparkSession
    stop = min(start + count, n)
    order = Epoch(n, shard_size, seed, epoch)
    if start >= stop:
        wanted = spark.createDataFrame([], "epoch_pos bigint, pos bigint")
    else:
        wanted = spark.range(start, stop).select(
            F.col("id").alias("epoch_pos"), order.row_at(F.col("id")).alias("pos")
        )
    return wanted.join(items, "pos")
