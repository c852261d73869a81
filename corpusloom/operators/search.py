"""Nearest-neighbour search, per group and top-k, over the whole table.

Searching is an exact scan. The queries are the small side: they are sent to
every task as a matrix, each task keeps its own k best per query and group,
and only those leave the task, so the catalog is neither shuffled nor paired
up row by row. The queries' size is checked first; more of them than are to be
sent are written out once, and shares of them meet shares of the rows in one job.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas
from corpusloom.functions import paths
from corpusloom.session import stage_table

# So many queries are sent to every task as one matrix (64 MB at 512 components).
MAX_QUERIES = 16384
# Cells per core in which more queries than that meet the rows.
_CELLS_PER_CORE = 4
# Queries are compared with a batch this many at a time.
_QUERY_BLOCK = 256
# and rows this many, the first ones of all fewer.
_ROW_BLOCK = 4096
_FIRST_ROWS = 256
# Distances are compared to this many digits, so that equal vectors tie and
# the id decides.
DIGITS = 9

TEXT_SPACE = ["text", "audio"]
CLIP_SPACE = ["image", "video"]


def route_vector(modality: Column, text_vector: Column, clip_vector: Column) -> Column:
    """The vector column a modality is searched in."""
    return F.when(modality.isin(TEXT_SPACE), text_vector).when(
        modality.isin(CLIP_SPACE), clip_vector
    )


def _distances(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    products = queries @ rows.T
    if metric == "l2sq":
        squares = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None, :]
        return np.round(np.maximum(squares - 2 * products, 0.0), DIGITS)
    lengths = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(rows, axis=1)
    cosine = np.divide(products, lengths, out=np.zeros_like(products), where=lengths > 0)
    return np.round(1.0 - cosine, DIGITS)


def _may_be_near(queries: np.ndarray, rows: np.ndarray, worst: np.ndarray) -> np.ndarray:
    """Pairs whose squared distance may be at most ``worst`` of the query: one product
    and one comparison each. The slack covers rounding, here and in ``_distances``."""
    asked, held = (queries**2).sum(1), (rows**2).sum(1)
    slack = 10.0**-DIGITS + 1e-12 * (asked + held.max(initial=0.0))
    near = queries @ rows.T
    near -= held / 2
    return near >= ((asked - worst - slack) / 2)[:, None]


class _Best:
    """The k nearest ids per query seen so far."""

    def __init__(self, n_queries: int, k: int) -> None:
        self.k = k
        self.ids: list[list] = [[] for _ in range(n_queries)]
        self.distances = [np.empty(0) for _ in range(n_queries)]
        self.worst = np.full(n_queries, np.inf)

    def scan(self, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, metric: str) -> None:
        # The first rows give bounds, which spare most of the others.
        first = _FIRST_ROWS if np.isinf(self.worst).any() else 0
        cuts = [0, *range(first, len(rows), _ROW_BLOCK), len(rows)]
        for low, high in zip(cuts, cuts[1:]):
            for start in range(0, len(queries), _QUERY_BLOCK):
                some = queries[start : start + _QUERY_BLOCK]
                self._scan_block(start, some, rows[low:high], ids[low:high], metric)

    def _scan_block(self, start: int, queries, rows, ids, metric: str) -> None:
        # Rows farther than the k-th best so far change nothing.
        worst = self.worst[start : start + len(queries)]
        if metric == "l2sq" and np.isfinite(worst).all():
            near = _may_be_near(queries, rows, worst)
            for at in np.flatnonzero(near.any(axis=1)):
                held = np.flatnonzero(near[at])
                distances = _distances(queries[at : at + 1], rows[held], metric)[0]
                self._merge(start + at, distances, ids[held])
        else:
            block = _distances(queries, rows, metric)
            for at in np.flatnonzero((block <= worst[:, None]).any(axis=1)):
                self._merge(start + at, block[at], ids)

    def _merge(self, q: int, row: np.ndarray, ids: np.ndarray) -> None:
        bound = self.worst[q]
        if len(row) > self.k:
            bound = min(bound, np.partition(row, self.k - 1)[self.k - 1])
        at = np.flatnonzero(row <= bound)
        every = np.concatenate([self.distances[q], row[at]])
        names = self.ids[q] + list(ids[at])
        order = sorted(range(len(names)), key=lambda i: (every[i], names[i]))[: self.k]
        self.distances[q] = every[order]
        self.ids[q] = [names[i] for i in order]
        if len(order) == self.k:
            self.worst[q] = self.distances[q][-1]


def _scan_part(matrix: np.ndarray, found: _Best, part: pd.DataFrame, metric: str) -> None:
    # A vector of another length has no distance to the queries.
    part = part[part["vec"].map(len) == matrix.shape[1]]
    if len(part):
        rows = np.vstack(part["vec"].to_numpy()).astype(np.float64)
        found.scan(matrix, rows, part["id"].to_numpy(), metric)


def _by_group(queries: pd.DataFrame) -> dict:
    """Ids and matrix of the queries of each group."""
    return {
        g: (p["query_id"].tolist(), np.vstack(p["vec"].to_numpy()).astype(np.float64))
        for g, p in queries.groupby("grp", sort=False)
    }


def _scan(sent, k: int, metric: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_group = sent.value
        best: dict = {}
        for batch in batches:
            for group, part in batch.groupby("grp", sort=False):
                if group not in by_group:
                    continue
                query_ids, matrix = by_group[group]
                found = best.setdefault(group, _Best(len(query_ids), k))
                _scan_part(matrix, found, part, metric)
        for group, found in best.items():
            if any(found.ids):
                yield _hits(by_group[group][0], group, found)

    return run


def _hits(query_ids, group, found: _Best) -> pd.DataFrame:
    sizes = [len(x) for x in found.ids]
    return pd.DataFrame(
        {
            "query_id": np.repeat(np.asarray(query_ids, dtype=object), sizes),
            "grp": group,
            "id": [i for ids in found.ids for i in ids],
            "distance": np.concatenate(found.distances) if sizes else [],
        }
    )


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 5,
    metric: str = "l2sq",
    max_queries: int = MAX_QUERIES,
) -> DataFrame:
    """The ``k`` nearest rows of every query inside its group.

    ``rows`` holds ``id, grp, vec`` and ``queries`` ``query_id, grp, vec``;
    queries of one group have one length, rows of another one are passed over.
    Returns ``query_id, grp, rank, id,
    distance`` (squared L2, or one minus cosine), ties in order of id.
    """
    if metric not in ("l2sq", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    spark = rows.sparkSession
    kind = {f.name: f.dataType.simpleString() for f in queries.schema}
    id_kind = rows.schema["id"].dataType.simpleString()
    grp_kind = rows.schema["grp"].dataType.simpleString()
    schema = f"query_id {kind['query_id']}, grp {grp_kind}, id {id_kind}, distance double"
    rows = rows.where(F.size("vec") > 0).select("id", "grp", "vec")
    queries = queries.select("query_id", "grp", "vec")

    small = queries.limit(max_queries + 1).toPandas()
    if len(small) <= max_queries:
        sent = spark.sparkContext.broadcast(_by_group(small))
        hits = rows.mapInPandas(_scan(sent, k, metric), schema)
    else:
        hits = _nearest_cells(rows, queries, k, metric, schema)
    order = W.partitionBy("query_id", "grp").orderBy("distance", "id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "grp", "rank", "id", "distance")


def _nearest_cells(
    rows: DataFrame, queries: DataFrame, k: int, metric: str, schema: str
) -> DataFrame:
    """Many queries in one job: shares of them meet shares of the rows in cells.

    A share of queries is planned at half of what fits a task; the rows stream past
    it. Rows are dealt once per share of queries, queries once per share of rows.
    """
    spark = rows.sparkSession
    queries = stage_table(queries, "queries")
    n_asked = math.ceil(2 * queries.count() / MAX_QUERIES)
    n_rows = math.ceil(_CELLS_PER_CORE * spark.sparkContext.defaultParallelism / n_asked)
    asked = queries.select(
        "query_id",
        _unused(rows.schema["id"].dataType).alias("id"),
        "grp",
        "vec",
        F.lit(True).alias("asks"),
        F.pmod(F.xxhash64("query_id", "grp"), F.lit(n_asked)).alias("_a"),
        F.explode(F.expr(f"sequence(0L, {n_rows - 1}L)")).alias("_r"),
    )
    held = rows.select(
        _unused(queries.schema["query_id"].dataType).alias("query_id"),
        "id",
        "grp",
        "vec",
        F.lit(False).alias("asks"),
        F.explode(F.expr(f"sequence(0L, {n_asked - 1}L)")).alias("_a"),
        F.pmod(F.xxhash64("id"), F.lit(n_rows)).alias("_r"),
    )
    cell = (F.col("_a") * n_rows + F.col("_r")).alias("cell")
    met = asked.unionAll(held).select("query_id", "id", "grp", "vec", "asks", cell)
    return (
        met.repartition("cell")
        .sortWithinPartitions("cell", F.desc("asks"))
        .mapInPandas(_scan_cells(k, metric), schema)
    )


def _unused(kind: T.DataType) -> Column:
    """Some value of a type. Nulls among numbers would make them all floats."""
    number = isinstance(kind, (T.NumericType, T.BooleanType))
    return F.lit(0).cast(kind) if number else F.lit(None).cast(kind)


def _scan_cells(k: int, metric: str):
    """Goes through dealt rows cell by cell, the queries of a cell first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, asked, best = None, [], {}
        for batch in batches:
            for cell, part in batch.groupby("cell", sort=False):
                if cell != at:
                    yield from _found(best)
                    at, asked, best = cell, [], {}
                asks = part["asks"].to_numpy()
                if asks.any():
                    asked.append(part.loc[asks, ["query_id", "grp", "vec"]])
                if asks.all():
                    continue
                if asked:
                    best = {g: (*x, _Best(len(x[0]), k)) for g, x in _by_group(pd.concat(asked)).items()}
                    asked = []
                for group, some in part[~asks].groupby("grp", sort=False):
                    if group in best:
                        _, matrix, found = best[group]
                        _scan_part(matrix, found, some, metric)
        yield from _found(best)

    return run


def _found(best: dict) -> Iterator[pd.DataFrame]:
    for group, (query_ids, _, found) in best.items():
        if any(found.ids):
            yield _hits(query_ids, group, found)


# Hits up to this many rows are sent to the table they are looked up in.
_FEW_HITS = 200_000


def with_details(hits: DataFrame, details: DataFrame, on: list[str]) -> DataFrame:
    """Look further columns of the hits up in a large table.

    The hits are written out and counted. A few are broadcast, so that the
    table is only scanned; more than that are joined by shuffle.
    """
    found = stage_table(hits, "hits")
    few = found.limit(_FEW_HITS + 1).count() <= _FEW_HITS
    return (F.broadcast(found) if few else found).join(details, on)


def catalog_rows(catalog: DataFrame, modalities: list[str] | None = None) -> DataFrame:
    """Searchable rows of a catalog: ``id, grp, vec``, only those embedded."""
    some = catalog.where("has_embedding")
    if modalities:
        some = some.where(F.col("modality").isin(modalities))
    vec = route_vector(F.col("modality"), F.col("text_vector"), F.col("clip_vector"))
    return some.select("id", F.col("modality").alias("grp"), vec.alias("vec"))


def search_all(
    catalog: DataFrame, queries: DataFrame, k: int = 5, caption_chars: int | None = None
) -> DataFrame:
    """Per-modality result lists, never merged: distances of different models
    do not compare.

    ``queries`` holds ``query_id, modality, vec``. The scan reads ids and
    vectors; the descriptive columns are joined to the hits alone. Captions are
    whole unless ``caption_chars`` cuts them for display.
    """
    asked = queries.select("query_id", F.col("modality").alias("grp"), "vec")
    hits = nearest(catalog_rows(catalog), asked, k).withColumnRenamed("grp", "modality")
    caption = F.col("caption")
    if caption_chars is not None:
        caption = F.substring(caption, 1, caption_chars)
    details = catalog.select(
        "id",
        "modality",
        caption.alias("caption"),
        "content_path",
        "source",
        "metadata_json",
        "quality_status",
        "license",
        "content_hash",
    )
    url = F.when(F.col("modality") != "text", paths.asset_url(F.col("id")))
    return with_details(hits, details, ["id", "modality"]).withColumn("asset_url", url)


def search_each(
    catalog: DataFrame, queries: DataFrame, k: int = 5, modalities: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``search_all`` with every modality on its own: the hits, and ``modality,
    status, reason, n_hits`` of each one.

    A modality is one job whose hits are written before the next one begins. What
    fails there, such as queries of another length than its vectors, is its outcome
    and leaves the lists of the others as they are.
    """
    spark = catalog.sparkSession
    found, outcomes = None, []
    for modality in modalities or schemas.MODALITIES:
        asked = queries.where(F.col("modality") == modality)
        try:
            _check_lengths(catalog_rows(catalog, [modality]), asked, modality)
            own = catalog.where(F.col("modality") == modality)
            hits = stage_table(search_all(own, asked, k), f"hits-{modality}")
            outcomes.append((modality, "ok", "", hits.count()))
            found = hits if found is None else found.unionByName(hits)
        except Exception as e:  # whatever it is, it is this modality's outcome
            outcomes.append((modality, "error", str(e).split("\n")[0][:300], 0))
    kind = "modality string, status string, reason string, n_hits bigint"
    told = spark.createDataFrame(outcomes, kind)
    if found is None:
        found = search_all(catalog.where(F.lit(False)), queries.where(F.lit(False)), k)
    return found, told


def _check_lengths(rows: DataFrame, asked: DataFrame, modality: str) -> None:
    """All queries of a modality have the length of its vectors."""
    lengths = [
        {r[0] for r in df.select(F.size("vec")).distinct().collect()} for df in (rows, asked)
    ]
    if lengths[0] and lengths[1] - lengths[0]:
        raise ValueError(
            f"{modality}: queries of length {sorted(lengths[1])}, vectors of {sorted(lengths[0])}"
        )


def search_texts(
    catalog: DataFrame, probes: DataFrame, text_model, clip_model, k: int = 5
) -> DataFrame:
    """Search by query text: ``probes`` holds ``query_id, query``."""
    return search_all(catalog, text_queries(probes, text_model, clip_model), k)


def text_queries(probes: DataFrame, text_model, clip_model) -> DataFrame:
    """``query_id, modality, vec`` of query texts. A text is embedded once for each
    of the two vector spaces."""
    from corpusloom.operators.embed import embed_text

    words = F.trim(F.coalesce(F.col("query"), F.lit("")))
    checked = probes.withColumn(
        "query",
        F.when(words != "", words).otherwise(
            F.raise_error(F.lit("Please provide a non-empty query."))
        ),
    )
    both = checked.select(
        "query_id",
        embed_text(F.col("query"), text_model).alias("in_text"),
        embed_text(F.col("query"), clip_model).alias("in_clip"),
    )
    targets = F.explode(F.array(*[F.lit(m) for m in schemas.MODALITIES]))
    spread = both.withColumn("modality", targets)
    vec = route_vector(F.col("modality"), F.col("in_text"), F.col("in_clip"))
    return spread.select("query_id", "modality", vec.alias("vec"))
