"""Kept vectors of a growing corpus, stored by the cell of their nearest pivot.

    <store>/generations/0000000001.json             which layout is in use
    <store>/<layout>/pivots                         cell, vec
    <store>/<layout>/kept/batch_id=…/cell=…         pos, vec
    <store>/<layout>/edges/batch_id=…               cell, n, near, far

A new batch is compared only with kept vectors that it can reach: the bounds of
``pivot_cells`` on the stored edges of each cell say which cells those are, and only
their folders are read. What stays is then decided inside the batch and stored by
cell beside the rest.

Pivots are fitted to the first batch that has vectors. When ``GROWTH`` times as many
are kept, the store is dealt anew around more pivots: all of it is written to a new
layout, and a pointer created after that switches to it. So a vector is rewritten a
number of times that grows with the logarithm of the store.

A batch writes under its own id and reads the batches before it, so running it again
decides it the same way and replaces its own output.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import dedup, pivot_cells, snapshots
from corpusloom.session import discard, fresh_name, list_folder, stage_table

# The store is dealt anew when it has grown by this factor.
GROWTH = 4
_KEPT = "pos bigint, vec array<float>, batch_id bigint, cell int"
_EDGES = "cell int, n bigint, near double, far double, batch_id bigint"
_PIVOTS = "cell int, vec array<double>"
# The batch id of what a new layout took over.
_FOLDED = -1


@dataclass(frozen=True)
class Layout:
    number: int
    name: str
    fitted: int


class KeptStore:
    """The kept vectors under ``path``, for vectors of ``dim`` components."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        dim: int,
        threshold: float = dedup.THRESHOLD,
        block_rows: int | None = None,
        tail_rows: int = dedup.TAIL_ROWS,
        growth: int = GROWTH,
    ):
        if threshold < 0:
            raise ValueError("the threshold must not be negative")
        self.spark, self.path, self.dim = spark, path.rstrip("/"), dim
        self.threshold, self.growth, self.tail_rows = threshold, growth, tail_rows
        self.block_rows = block_rows or pivot_cells.block_rows_of(dim)

    # -- layouts ---------------------------------------------------------------

    def layout(self) -> Layout | None:
        """The layout in use; None before the first vector."""
        folder = f"{self.path}/generations"
        names = [p.rsplit("/", 1)[1] for p in list_folder(self.spark, folder)]
        for name in sorted((n for n in names if n.endswith(".json")), reverse=True):
            try:
                held = json.loads(snapshots.read_text(self.spark, f"{folder}/{name}"))
            except ValueError:
                continue
            return Layout(int(name.removesuffix(".json")), held["name"], held["fitted"])
        return None

    def _switch(self, before: Layout | None, name: str, fitted: int) -> Layout:
        number = before.number + 1 if before else 1
        held = json.dumps({"name": name, "fitted": fitted})
        at = f"{self.path}/generations/{number:010d}.json"
        if not snapshots.create_if_absent(self.spark, at, held):
            raise snapshots.Conflict(f"another writer has changed {self.path}")
        return Layout(number, name, fitted)

    def _fit(self, rows: DataFrame, n: int) -> tuple[str, pivot_cells.Cells]:
        """A new layout's name and its cells, empty so far."""
        name, pivots = fresh_name("layout"), pivot_cells.fit_pivots(rows, n)
        lines = [(i, p.tolist()) for i, p in enumerate(pivots)]
        self.spark.createDataFrame(lines, _PIVOTS).coalesce(1).write.parquet(
            f"{self.path}/{name}/pivots"
        )
        return name, pivot_cells.bare(pivots)

    def _cells(self, layout: Layout) -> pivot_cells.Cells:
        got = self.spark.read.schema(_PIVOTS).parquet(f"{self.path}/{layout.name}/pivots").collect()
        return pivot_cells.bare(np.array([r["vec"] for r in sorted(got, key=lambda r: r["cell"])]))

    def _table(self, layout: Layout, name: str, kind: str) -> DataFrame:
        path = f"{self.path}/{layout.name}/{name}"
        if not list_folder(self.spark, path):
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(path)

    # -- reading ---------------------------------------------------------------

    def kept(self, before: int | None = None) -> DataFrame:
        """``pos, vec, batch_id`` (-1 for what a new layout took over) of all that
        is kept, or of the batches before one."""
        layout = self.layout()
        if layout is None:
            return self.spark.createDataFrame([], _KEPT).drop("cell")
        rows = self._table(layout, "kept", _KEPT).drop("cell")
        return rows if before is None else rows.where(F.col("batch_id") < before)

    def cells(self, before: int) -> pivot_cells.Cells | None:
        """The cells with what the batches before one have put into them."""
        layout = self.layout()
        if layout is None:
            return None
        edges = self._table(layout, "edges", _EDGES).where(F.col("batch_id") < before)
        held = edges.groupBy("cell").agg(
            F.sum("n").alias("n"), F.min("near").alias("near"), F.max("far").alias("far")
        )
        bare = self._cells(layout)
        return pivot_cells.measured(bare, held.collect(), self.threshold, self.block_rows)

    def homes(self, reached: DataFrame, before: int) -> DataFrame:
        """``pos, vec, cell``: kept rows of the cells that ``reached`` names. Only
        their folders are read; at most one number per pivot reaches the driver."""
        layout = self.layout()
        cells = [r[0] for r in reached.select(F.explode("reached")).distinct().collect()]
        rows = self._table(layout, "kept", _KEPT)
        near = rows.where((F.col("batch_id") < before) & F.col("cell").isin(cells))
        return near.select("pos", "vec", "cell")

    # -- writing ---------------------------------------------------------------

    def add(self, batch: DataFrame, batch_id: int, pos: str, vec: str) -> None:
        """Decide a batch and keep what stays of it."""
        if batch_id < 0:
            raise ValueError("batch ids start at 0")
        if self.threshold >= 1:
            fresh = dedup.usable(batch, pos, vec, self.dim)
        else:
            firsts = dedup.distinct_vectors(batch, pos, vec, self.dim)
            fresh = self._fresh(firsts, batch_id)
        fresh = stage_table(fresh, "batch-kept")
        layout = self.layout()
        if layout is None:
            n = fresh.count()
            if not n:
                return
            name, _ = self._fit(fresh, n)
            layout = self._switch(None, name, n)
        self._write(fresh, layout.name, self._cells(layout), batch_id)
        self._grow(layout, batch_id)

    def _fresh(self, firsts: DataFrame, batch_id: int) -> DataFrame:
        """Distinct vectors of a batch that stay."""
        cells = self.cells(batch_id)
        if cells is not None and cells.counts.any():
            reached = stage_table(dedup.reached_cells(firsts, cells), "batch-reached")
            homes = self.homes(reached, batch_id)
            known = dedup.matched_by(reached, homes, cells, self.threshold)
            left = reached.select("pos", "vec").join(known, "pos", "left_anti")
            firsts = stage_table(left, "batch-fresh")
        return dedup.decide_fresh(firsts, self.threshold, self.block_rows, self.tail_rows)

    def _write(
        self, rows: DataFrame, name: str, cells: pivot_cells.Cells, batch_id: int
    ) -> None:
        at = f"{self.path}/{name}"

        def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield batch.assign(cell=cells.place(pivot_cells.unit_of(batch))[1])

        rows = rows.select("pos", "vec")
        by_cell = rows.mapInPandas(placed, "pos bigint, vec array<float>, cell int")
        # Few files per cell, crowded cells still in several tasks.
        by_cell = by_cell.hint("rebalance", "cell")
        by_cell.write.mode("overwrite").partitionBy("cell").parquet(f"{at}/kept/batch_id={batch_id}")
        edges = pivot_cells.measure(rows, cells)
        edges.coalesce(1).write.mode("overwrite").parquet(f"{at}/edges/batch_id={batch_id}")

    def _grow(self, layout: Layout, batch_id: int) -> None:
        """Deal the store anew once it has outgrown its pivots."""
        edges = self._table(layout, "edges", _EDGES).where(F.col("batch_id") <= batch_id)
        n = edges.agg(F.sum("n")).first()[0] or 0
        if n < self.growth * layout.fitted:
            return
        # The batch that just ended may run again, so it stays one of its own.
        every = self._table(layout, "kept", _KEPT).where(F.col("batch_id") <= batch_id)
        own = F.col("batch_id") == batch_id
        name, cells = self._fit(every.select("pos", "vec"), n)
        self._write(every.where(~own), name, cells, _FOLDED)
        self._write(every.where(own), name, cells, batch_id)
        self._switch(layout, name, n)
        self._forget(keep={layout.name, name})

    def _forget(self, keep: set[str]) -> None:
        """Layouts before the last one have no readers any more."""
        for path in list_folder(self.spark, self.path):
            name = path.rsplit("/", 1)[1]
            if name.startswith("layout-") and name not in keep:
                discard(self.spark, path)
