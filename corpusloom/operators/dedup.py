"""Exact and near-duplicate removal, keeping the first occurrence.

Near-duplicate rule: go through the rows in order; a row is dropped when its
cosine with some row *kept* before it exceeds the threshold. Rows similar only
to a dropped row stay.

How it runs. Equal vectors share one fate, so they are collapsed first by a
partially aggregated group-by; a group of copies of any size becomes one row
there. Distinct vectors meet in cells around pivots (``pivot_cells``), each pair
that can be over the threshold in one block; a task returns at most two positions
per row and batch (its first similar row that is kept, and that is undecided),
never its pairs.

Rounds go on until nothing is undecided: a row without an earlier similar row is
kept; one whose first similar row is kept is dropped; the others wait. Only
waiting rows and those just kept are compared again. Each round is written to
the shared folder, so a lost executor repeats tasks of the current round only.
Once at most ``TAIL_ROWS`` rows wait, one task decides them in order.
The driver sees counts, a bounded sample, the pivots and two angles per pivot.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import vectors
from corpusloom.operators import pivot_cells
from corpusloom.operators.ranking import first_per_key, salted_lookup
from corpusloom.session import stage_table

THRESHOLD = 0.92
# So few waiting rows are decided in one task.
TAIL_ROWS = 1024
_ROUND = "pos bigint, vec array<float>, best bigint, wait bigint"
_NEVER = (1 << 63) - 1


# Room for the pieces of one source row in ``order_key``.
_SUB_BITS = 20


def order_key(idx: str = "idx", sub_idx: str = "sub_idx") -> Column:
    """One number that orders rows by ``idx`` and then ``sub_idx``. It is all
    the order near-dedup needs; no ranking over the table takes place. Values
    without room (``idx`` from 2**43, ``sub_idx`` from 2**20, negative ones)
    are an error: two rows never share a number."""
    i, j = F.col(idx).cast("long"), F.col(sub_idx).cast("long")
    fits = i.between(0, (1 << 63 - _SUB_BITS) - 1) & j.between(0, (1 << _SUB_BITS) - 1)
    number = F.shiftleft(i, _SUB_BITS).bitwiseOR(j)
    problem = F.concat_ws(" ", F.lit("no order key for"), i, j)
    return F.when(fits, number).otherwise(F.raise_error(problem).cast("long"))


def exact_dedup(
    df: DataFrame, key: str = "content_hash", order: tuple[str, ...] = ("idx", "sub_idx", "id")
) -> DataFrame:
    """Keep the first row of every content hash."""
    return first_per_key(df, [key], list(order))


def decide_in_order(
    rows: np.ndarray, threshold: float, best: np.ndarray, pos: np.ndarray
) -> np.ndarray:
    """Greedy rule inside one small batch in order of ``pos``. ``best`` is each
    row's first similar row kept elsewhere; the result is the first one of all,
    ``_NEVER`` for the rows that stay."""
    near = rows @ rows.T > threshold
    out = best.copy()
    for i in range(len(rows)):
        kept = np.flatnonzero(near[i, :i] & (out[:i] == _NEVER))
        if len(kept):
            out[i] = min(out[i], pos[kept[0]])
    return out


def usable(df: DataFrame, pos: str, vec: str, dim: int) -> DataFrame:
    """Rows with a full-size vector that has a direction."""
    full = df.where(vectors.has_dim(F.col(vec), dim))
    pointing = F.exists(vec, lambda x: x != 0)
    return full.where(pointing).select(
        F.col(pos).cast("long").alias("pos"), F.col(vec).cast("array<float>").alias("vec")
    )


def _collapse_copies(rows: DataFrame) -> DataFrame:
    """First position of every distinct vector."""
    return rows.groupBy("vec").agg(F.min("pos").alias("pos")).select("pos", "vec")


def _earlier(block: pivot_cells.Block, part: pd.DataFrame | None) -> Iterator[pd.DataFrame]:
    """``pos, kept, wait`` per undecided row of the pairs that meet in a block."""
    met = [block.pos] if part is None else [block.pos, part["pos"].to_numpy()]
    lowest = [(pos, *(np.full(len(pos), _NEVER) for _ in range(2))) for pos in met]
    for a, b, pos, open_ in block.pairs(part):
        home = pos[a] < block.pos[b]
        for late, early, waits, (_, kept, wait) in (
            (b[home], pos[a[home]], open_[a[home]], lowest[0]),
            (a[~home], block.pos[b[~home]], block.open[b[~home]], lowest[-1]),
        ):
            np.minimum.at(wait, late[waits], early[waits])
            np.minimum.at(kept, late[~waits], early[~waits])
    for pos, kept, wait in lowest:
        found = np.minimum(kept, wait) != _NEVER
        if found.any():
            yield pd.DataFrame({"pos": pos[found], "kept": kept[found], "wait": wait[found]})


def _earliest(
    state: DataFrame, threshold: float, cells: pivot_cells.Cells, few_open: bool
) -> DataFrame:
    """``pos, kept, wait`` of undecided rows: the first earlier similar row that
    is kept, and that is undecided (``_NEVER`` for none)."""
    dealt = pivot_cells.gathered(pivot_cells.deal(state, cells, few_open))
    met = dealt.mapInPandas(
        pivot_cells.meet(threshold, _earlier), "pos bigint, kept bigint, wait bigint"
    )
    return met.groupBy("pos").agg(F.min("kept").alias("kept"), F.min("wait").alias("wait"))


def _tail(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            rows = pd.concat(parts).sort_values("pos", ignore_index=True)
            pos = rows["pos"].to_numpy()
            unit = pivot_cells.unit_of(rows)
            first = decide_in_order(unit, threshold, rows["best"].to_numpy(), pos)
            yield rows[["pos", "vec"]].assign(best=first, wait=_NEVER)

    return run


def _run_rounds(
    todo: DataFrame, threshold: float, block_rows: int, tail_rows: int = TAIL_ROWS
) -> DataFrame:
    """Decide distinct vectors (``pos, vec``); returns ``pos, dup_of, kept,
    vec`` where ``dup_of`` is the first kept position that drops the row, null
    for rows that stay.

    A round is one table: what it decided is read from it at the end, what waits
    and what it kept is read by the next round.
    """
    spark = todo.sparkSession
    never = F.lit(_NEVER)
    stays = (F.col("best") == never) & (F.col("wait") == never)
    goes = F.col("best") < F.col("wait")
    state = todo.select("pos", "vec", never.alias("best"), F.lit(True).alias("open"))
    cells = pivot_cells.fit(todo, threshold, block_rows)
    rounds = [spark.createDataFrame([], _ROUND)]
    n_open, few_open = None, False
    while cells is not None and n_open != 0:
        found = _earliest(state, threshold, cells, few_open)
        judged = state.where("open").join(found, "pos", "left").select(
            "pos",
            "vec",
            F.least("best", F.coalesce("kept", never)).alias("best"),
            F.coalesce("wait", never).alias("wait"),
        )
        if n_open is not None and n_open <= tail_rows:
            judged = judged.select("pos", "vec", "best").repartition(1)
            judged = judged.mapInPandas(_tail(threshold), _ROUND)
        judged = stage_table(judged, "round")
        rounds.append(judged.where(stays | goes))
        state = judged.where(~goes).select("pos", "vec", "best", (~stays).alias("open"))
        n_rows, n_open = state.agg(F.count("*"), F.count_if("open")).first()
        few_open = 2 * n_open < n_rows
    return reduce(DataFrame.unionByName, rounds).select(
        "pos",
        F.when(goes, F.col("best")).alias("dup_of"),
        stays.alias("kept"),
        F.when(stays, F.col("vec")).alias("vec"),
    )


def _check(threshold: float) -> None:
    if threshold < 0:
        raise ValueError("the threshold must not be negative")


def near_dup_links(
    df: DataFrame,
    pos: str,
    vec: str,
    dim: int,
    threshold: float = THRESHOLD,
    block_rows: int | None = None,
    tail_rows: int = TAIL_ROWS,
) -> DataFrame:
    """``pos, dup_of`` for every dropped row; ``dup_of`` is the first kept row
    above the threshold."""
    _check(threshold)
    whole = usable(df, pos, vec, dim)
    if threshold >= 1:
        return whole.select("pos", F.col("pos").alias("dup_of")).where(F.lit(False))
    firsts = stage_table(_collapse_copies(whole), "distinct-vectors")
    decided = _run_rounds(firsts, threshold, block_rows or pivot_cells.block_rows_of(dim), tail_rows)
    fate = decided.select(
        F.col("pos").alias("first_pos"), F.coalesce("dup_of", "pos").alias("dup_of")
    )
    # 96 bits name a vector, so that copies meet neither on it nor in one task.
    name = [F.xxhash64("vec").alias("h1"), F.hash("vec").alias("h2")]
    named = firsts.select(F.col("pos").alias("first_pos"), *name).join(fate, "first_pos")
    members = salted_lookup(whole.select("pos", *name), named.drop("first_pos"), ["h1", "h2"], "pos")
    return members.where("pos <> dup_of").select("pos", "dup_of")


def kept_vectors(
    df: DataFrame,
    pos: str,
    vec: str,
    dim: int,
    threshold: float = THRESHOLD,
    block_rows: int | None = None,
    tail_rows: int = TAIL_ROWS,
) -> DataFrame:
    """``pos, vec`` of the rows with a usable vector that stay."""
    _check(threshold)
    whole = usable(df, pos, vec, dim)
    if threshold >= 1:
        return whole
    firsts = stage_table(_collapse_copies(whole), "distinct-vectors")
    decided = _run_rounds(firsts, threshold, block_rows or pivot_cells.block_rows_of(dim), tail_rows)
    return decided.where("kept").select("pos", "vec")


def near_dedup(
    df: DataFrame,
    pos: str,
    vec: str,
    dim: int,
    threshold: float = THRESHOLD,
    block_rows: int | None = None,
    tail_rows: int = TAIL_ROWS,
) -> DataFrame:
    """The rows of ``df`` that stay. Rows without a usable vector survive;
    ``pos`` gives the order and identifies rows."""
    kept = kept_vectors(df, pos, vec, dim, threshold, block_rows, tail_rows)
    whole = usable(df, pos, vec, dim).select("pos")
    dropped = whole.join(kept.select("pos"), "pos", "left_anti")
    return df.join(dropped.withColumnRenamed("pos", pos), pos, "left_anti")


def _hits(block: pivot_cells.Block, part: pd.DataFrame | None) -> Iterator[pd.DataFrame]:
    """Visitors of a block of kept rows that one of them is similar to."""
    if part is not None:
        hit = np.zeros(len(part), bool)
        for a, _, _, _ in block.pairs(part):
            hit[a] = True
        if hit.any():
            yield pd.DataFrame({"pos": part["pos"].to_numpy()[hit]})


def reached_cells(rows: DataFrame, cells: pivot_cells.Cells) -> DataFrame:
    """``pos, vec, open, visits, reached``: the blocks and cells that a row
    similar to ``rows`` (``pos, vec``) may live in."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                may = cells.open(*cells.place(pivot_cells.unit_of(batch)))
                reached = [np.flatnonzero(x) for x in may]
                yield batch.assign(open=True, visits=cells.blocks_of(may), reached=reached)

    schema = "pos bigint, vec array<float>, open boolean, visits array<int>, reached array<int>"
    return rows.select("pos", "vec").mapInPandas(run, schema)


def matched_by(
    reached: DataFrame, kept: DataFrame, cells: pivot_cells.Cells, threshold: float
) -> DataFrame:
    """Positions of ``reached`` rows similar to some row of ``kept`` (``pos, vec,
    cell``). Visitors are always later: a kept row is only ever compared with them."""
    first, blocks = cells.first_block()[:-1].tolist(), cells.blocks.tolist()

    def at(numbers: list[int]) -> Column:
        return F.element_at(F.lit(np.array(numbers, np.int64)), F.col("cell") + 1)

    block = at(first) + F.pmod(F.xxhash64("pos"), at(blocks))
    homes = kept.select(
        F.lit(-(1 << 63)).cast("bigint").alias("pos"),
        "vec",
        F.lit(False).alias("open"),
        F.lit(True).alias("lives"),
        block.cast("int").alias("block"),
    )
    visitors = reached.select(
        "pos", "vec", "open", F.lit(False).alias("lives"), F.explode("visits").alias("block")
    )
    met = (
        homes.unionByName(visitors)
        .repartition("block")
        .sortWithinPartitions("block", F.desc("lives"))
        .mapInPandas(pivot_cells.meet(threshold, _hits), "pos bigint")
    )
    return met.distinct()


def distinct_vectors(df: DataFrame, pos: str, vec: str, dim: int) -> DataFrame:
    """``pos, vec``: the first row of every usable vector, written out."""
    return stage_table(_collapse_copies(usable(df, pos, vec, dim)), "distinct-vectors")


def decide_fresh(
    fresh: DataFrame, threshold: float, block_rows: int, tail_rows: int = TAIL_ROWS
) -> DataFrame:
    """``pos, vec`` of the distinct vectors that stay among themselves."""
    return _run_rounds(fresh, threshold, block_rows, tail_rows).where("kept").select("pos", "vec")


def kept_of_batch(
    batch: DataFrame,
    kept: DataFrame,
    pos: str,
    vec: str,
    dim: int,
    threshold: float = THRESHOLD,
    block_rows: int | None = None,
) -> DataFrame:
    """Incremental form: ``pos, vec`` of the new rows that stay, given the
    vectors kept so far (``pos, vec``). Append the result to ``kept`` before the
    next batch. ``kept_store`` keeps them by cell and reads only what a batch
    can reach; here all of ``kept`` is dealt."""
    _check(threshold)
    size = block_rows or pivot_cells.block_rows_of(dim)
    if threshold >= 1:
        return usable(batch, pos, vec, dim)
    firsts = distinct_vectors(batch, pos, vec, dim)
    kept = kept.select("pos", "vec")
    cells = pivot_cells.fit(kept, threshold, size)
    if cells is not None:

        def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                if len(rows):
                    yield rows.assign(cell=cells.place(pivot_cells.unit_of(rows))[1])

        homes = kept.mapInPandas(placed, "pos bigint, vec array<float>, cell int")
        known = matched_by(reached_cells(firsts, cells), homes, cells, threshold)
        firsts = stage_table(firsts.join(known, "pos", "left_anti"), "batch-fresh")
    return decide_fresh(firsts, threshold, size)


def dedup_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows after the gate, near duplicates removed and rows left."""
    both = before.select(F.lit(0).alias("left")).unionAll(
        after.select(F.lit(1).alias("left"))
    )
    counts = both.agg(
        F.count_if(F.col("left") == 0).alias("rows_after_quality"),
        F.count_if(F.col("left") == 1).alias("rows_final"),
    )
    return counts.select(
        "rows_after_quality",
        (F.col("rows_after_quality") - F.col("rows_final")).alias("near_duplicates_removed"),
        "rows_final",
    )
