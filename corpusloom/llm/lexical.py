"""Ranked lexical search with norm buckets (after LEMP, Teflioudi et al. 2015).

A document is a vector of whole-number impacts, one per term that it holds of
those the items ask for; an item is a vector of term weights. Scores are inner
products. The vectors of documents are ordered by length and searched from the
longest on:

* Cauchy-Schwarz prunes buckets. No vector of a bucket scores more than the
  item's length times the longest length in the bucket; where that is below the
  item's k-th best score, the bucket is left out, and once it is for all items,
  so is all that follows.
* Coordinate bounds filter inside a bucket. An item's heaviest terms are its
  focus: as few as leave a rest that cannot reach the k-th best score on its own.
  So only documents with a term of the focus are looked at, and of those only
  the ones whose focus part plus the Cauchy-Schwarz bound of the rest reaches it.
* Survivors are scored anew over all terms in whole numbers.

Bounds only save products; results are exact.

How it runs: one pass over the texts counts the terms the items ask for; counts
of documents, tokens and documents per term come from its table. The index holds
impacts, written in waves of falling length, each four times the one before. A
wave is one job that reads only its own files; a task returns at most k documents
per item, and the k-th best so far goes out with the next wave. Items go out in
blocks of at most ``ITEMS`` items and about ``TERMS`` terms, chosen by a hash, so
what is sent does not grow with their number. A term that stands in every document
costs a number in each index row and, being light, is soon out of every focus.

Defined cases: null texts, texts without terms and items without terms take part
in nothing (a null text has no terms); items that repeat an id are ranked each; a
document with a null id is ranked after the others of equal score and returned with
null; rows that repeat a ``doc_id`` are documents of their own and take a rank each.
Only the named columns are read. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.session import fresh_path, stage_table

K = 50
# What is sent out at a time: items, and terms of all of them.
ITEMS = 1024
TERMS = 200_000
# Rows of the first wave at least, and how much longer each next one is.
FIRST_WAVE = 8192
WAVE_GROWTH = 4
_LEVELS = 8  # per doubling of the length
_BUCKET = 2048
_PARTS = 16
_LAST_ID = (1 << 63) - 1
_SLACK = 1e-9
_HITS = "query int, doc_id bigint, score bigint"

# Ends of terms become blanks, A-Z become a-z; bytes from 0x80 belong to terms.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of letters, digits and all beyond ASCII."""
    return text.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# -- counting ----------------------------------------------------------------

_COUNTED = "doc_id bigint, n bigint, terms array<int>, tf array<bigint>"
_COUNTED_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("terms", pa.list_(pa.int32())),
        ("tf", pa.list_(pa.int64())),
    ]
)


def _counted(sent):
    """Terms of the vocabulary in each text with terms, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                found = Counter(terms_of(text.as_py()))
                if found:
                    hits = sorted((known[t], found[t]) for t in found.keys() & known.keys())
                    out.append((doc_id.as_py(), found.total(), hits))
            columns = [
                [i for i, _, _ in out],
                [n for _, n, _ in out],
                [[t for t, _ in hits] for _, _, hits in out],
                [[c for _, c in hits] for _, _, hits in out],
            ]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, _COUNTED_ARROW)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_COUNTED_ARROW)

    return run


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int], doc_col: str, text_col: str):
    """``doc_id, n, terms, tf`` of each document with terms, written out."""
    rows = docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(doc_col).cast("bigint"), F.lit(_LAST_ID)).alias("doc_id"),
        F.col(text_col).cast("binary").alias("text"),
    )
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    counted = stage_table(rows.mapInArrow(_counted(sent), _COUNTED), "lexical-terms")
    sent.unpersist()
    return counted


def _impacts(counted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """``doc_id, terms, impacts, norm, level`` of documents that can score."""
    # In 38 digits: the product of three counts may leave 64 bits.
    share = f"cast({50 * n_docs} as decimal(20,0)) * cast(n as decimal(18,0)) div {n_terms}"
    m = f"(100 - 50 + {share})"
    impacts = F.expr("transform(tf, t -> (1000000000L * t) div (1000L * t + m20))")
    square = F.aggregate(
        "impacts", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")
    )
    return (
        counted.where(F.size("terms") > 0)
        .withColumn("m20", F.expr(f"cast({m} * 20 as bigint)"))
        .select("doc_id", "terms", impacts.alias("impacts"))
        .withColumn("norm", F.sqrt(square))
        .where("norm > 0")
        .withColumn("level", F.floor(F.log2("norm") * _LEVELS).cast("int"))
    )


# -- index -------------------------------------------------------------------


def _waves(levels: list[tuple[int, int]], first: int) -> list[int]:
    """Lowest level of each wave, from the longest vectors on."""
    cuts, held, size = [], 0, first
    for level, n in sorted(levels, reverse=True):
        held += n
        if held >= size:
            cuts.append(level)
            held, size = 0, size * WAVE_GROWTH
    if held:
        cuts.append(min(level for level, _ in levels))
    return cuts


def build_index(impacts: DataFrame, first_wave: int) -> tuple[str, list[float]]:
    """Writes the index by wave; its path and the longest length of each wave."""
    spark = impacts.sparkSession
    per_level = impacts.groupBy("level").agg(F.count("*").alias("n"), F.max("norm").alias("norm"))
    # At most a few hundred levels, whatever the number of documents.
    levels = per_level.collect()
    cuts = _waves([(r["level"], r["n"]) for r in levels], first_wave)
    longest = [0.0] * len(cuts)
    for r in levels:
        at = next(i for i, cut in enumerate(cuts) if r["level"] >= cut)
        longest[at] = max(longest[at], r["norm"])
    wave = F.coalesce(*[F.when(F.col("level") >= c, F.lit(i)) for i, c in enumerate(cuts)])
    order = ["wave", F.desc("norm"), "turn"]  # copies are of one length: the turn deals them
    path = fresh_path(spark, "lexical-index")
    indexed = impacts.withColumns(
        {"wave": wave, "turn": F.xxhash64(F.monotonically_increasing_id())}
    )
    indexed = indexed.repartitionByRange(*order).sortWithinPartitions(*order)
    indexed.drop("level", "turn").write.partitionBy("wave").parquet(path)
    return path, longest


# -- search ------------------------------------------------------------------


class _Item:
    """An item's terms, heaviest first, and the length of what follows each."""

    def __init__(self, terms: list[int], weights: list[int]):
        order = np.argsort(-np.array(weights, np.int64), kind="stable")
        self.terms = np.array(terms, np.int64)[order]
        self.weights = np.array(weights, np.int64)[order]
        squares = self.weights.astype(np.float64) ** 2
        # rest[i]: length of the item without its i heaviest terms.
        self.rest = np.sqrt(np.r_[np.cumsum(squares[::-1])[::-1], 0.0])

    def length(self) -> float:
        return float(self.rest[0])

    def focus(self, longest: float, floor: int) -> int:
        """How many terms leave a rest that cannot reach the floor."""
        reach = self.rest * longest * (1 + _SLACK)
        return int(np.flatnonzero(reach < max(floor, 1))[0])


class _Bucket:
    """Documents of similar length, their numbers sorted by term."""

    def __init__(self, doc_id, norm, sizes, terms, impacts):
        self.doc_id, self.norm = doc_id, norm
        self.longest = float(norm.max())
        doc = np.repeat(np.arange(len(doc_id)), sizes)
        order = np.argsort(terms, kind="stable")
        self.terms, self.impacts, self.doc = terms[order], impacts[order], doc[order]

    def postings(self, item: _Item, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the numbers of some of an item's terms, and their weights."""
        terms = item.terms[first:last]
        start = np.searchsorted(self.terms, terms)
        n = np.searchsorted(self.terms, terms, "right") - start
        base = np.repeat(start - np.cumsum(n) + n, n)
        return base + np.arange(len(base)), np.repeat(item.weights[first:last], n)

    def search(self, item: _Item, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of all documents that reach the floor, and maybe others."""
        n_focus, n = item.focus(self.longest, floor), len(self.doc_id)
        at, weights = self.postings(item, 0, n_focus)
        if not len(at):
            return self.doc_id[:0], self.doc_id[:0]
        doc, impact = self.doc[at], self.impacts[at].astype(np.float64)
        part = np.bincount(doc, impact * weights, n)
        square = np.bincount(doc, impact * impact, n)
        rest = item.rest[n_focus] * np.sqrt(np.maximum(self.norm**2 - square, 0))
        # The slack covers rounding.
        maybe = (part + rest) * (1 + _SLACK) + item.rest[n_focus] * 1e-3 + 1 >= floor
        maybe &= part > 0
        if not maybe.any():
            return self.doc_id[:0], self.doc_id[:0]
        more, more_weights = self.postings(item, n_focus, len(item.terms))
        at, weights = np.r_[at, more], np.r_[weights, more_weights]
        kept = maybe[self.doc[at]]
        score = np.zeros(n, np.int64)
        np.add.at(score, self.doc[at[kept]], self.impacts[at[kept]] * weights[kept])
        hit = np.flatnonzero(score >= max(floor, 1))
        return self.doc_id[hit], score[hit]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _buckets(batch: pa.RecordBatch) -> Iterator[_Bucket]:
    for at in range(0, batch.num_rows, _BUCKET):
        doc_id, norm, terms, impacts = batch.slice(at, _BUCKET).columns
        yield _Bucket(
            doc_id.to_numpy(),
            norm.to_numpy(),
            terms.value_lengths().to_numpy(),
            terms.flatten().to_numpy(),
            impacts.flatten().to_numpy(),
        )


def _searched(sent, k: int):
    schema = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value  # number, item, floor
        held = {q: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for q, _, _ in queries}
        floors = {q: floor for q, _, floor in queries}
        for batch in batches:
            for bucket in _buckets(batch):
                for q, item, _ in queries:
                    if item.length() * bucket.longest * (1 + _SLACK) < max(floors[q], 1):
                        continue
                    ids, scores = bucket.search(item, floors[q])
                    if not len(ids):
                        continue
                    mine = held[q]
                    held[q] = _best(np.r_[mine[0], ids], np.r_[mine[1], scores], k)
                    if len(held[q][1]) == k:
                        floors[q] = max(floors[q], int(held[q][1][-1]))
        for q, (ids, scores) in held.items():
            if len(ids):
                number = pa.array(np.full(len(ids), q, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [number, pa.array(ids), pa.array(scores)], schema=schema
                )

    return run


def _top(hits: DataFrame, k: int) -> DataFrame:
    """The k best per item; first among parts of an item's hits, so that no task
    gets those of every task for an item that many documents fit."""

    def best(rows: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    parts = hits.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS)))
    return best(best(parts, "query", "part").drop("part", "rank"), "query")


def search_index(
    spark: SparkSession, path: str, longest: list[float], items: dict[int, _Item], k: int
) -> DataFrame | None:
    """``query, rank, doc_id, score`` of the best documents per item."""
    best, floors = None, dict.fromkeys(items, 0)
    for wave, length in enumerate(longest):
        live = [
            (q, item, floors[q])
            for q, item in items.items()
            if item.length() * length * (1 + _SLACK) >= max(floors[q], 1)
        ]
        if not live:
            break  # what follows is shorter still
        sent = spark.sparkContext.broadcast(live)
        rows = spark.read.parquet(f"{path}/wave={wave}").select("doc_id", "norm", "terms", "impacts")
        hits = rows.mapInArrow(_searched(sent, k), _HITS)
        if best is not None:
            hits = hits.unionByName(best.drop("rank"))
        best = stage_table(_top(hits, k), "lexical-best")
        sent.unpersist()
        # A number per item of this block.
        full = best.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        floors |= {r["query"]: r["least"] for r in full.where(F.col("n") == k).collect()}
    return best


def _ranked(
    docs: DataFrame, items: DataFrame, k: int, doc_col: str, text_col: str, first_wave: int
) -> DataFrame | None:
    """The ranking for one block of items (``query``, ``text``)."""
    spark = docs.sparkSession
    asked = {r["query"]: sorted(set(terms_of(bytes(r["text"])))) for r in items.collect()}
    vocabulary = {t: i for i, t in enumerate(sorted({t for ts in asked.values() for t in ts}))}
    if not vocabulary:
        return None
    counted = count_terms(docs, vocabulary, doc_col, text_col)
    n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    df = counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
    weights = {r["t"]: weight(n_docs, r["count"]) for r in df}
    wanted = {}
    for query, terms in asked.items():
        own = [vocabulary[t] for t in terms if weights.get(vocabulary[t], 0) > 0]
        if own:
            wanted[query] = _Item(own, [weights[t] for t in own])
    path, longest = build_index(_impacts(counted, n_docs, n_terms), first_wave)
    return search_index(spark, path, longest, wanted, k)


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    doc_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    first_wave: int = FIRST_WAVE,
    most_items: int = ITEMS,
    most_terms: int = TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the ``k`` documents of the
    highest scores above 0, ties to the smaller id."""
    spark = docs.sparkSession
    text = F.col(item_text_col).cast("binary")
    asked = items.where(F.col(item_text_col).isNotNull()).select(
        F.col(item_col).alias("item_id"),
        text.alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    asked = stage_table(asked, "lexical-items")
    # A term has a byte and a blank at least.
    n, size = asked.agg(F.count("*"), F.sum(F.octet_length("text") / 2)).first()
    n_blocks = max(-(-n // most_items), math.ceil((size or 0) / most_terms))
    out = None
    for block in range(n_blocks):
        chosen = asked.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == block)
        numbered = chosen.select(
            "item_id", "text", F.row_number().over(Window.orderBy("row")).alias("query")
        )
        numbered = stage_table(numbered, "lexical-block")
        best = _ranked(docs, numbered.select("query", "text"), k, doc_col, text_col, first_wave)
        if best is None:
            continue
        named = best.join(numbered.select("query", "item_id"), "query").select(
            "item_id",
            F.col("rank").cast("int").alias("rank"),
            F.nullif("doc_id", F.lit(_LAST_ID)).alias("doc_id"),
            "score",
        )
        out = named if out is None else out.unionByName(named)
    if out is None:
        kind = items.schema[item_col].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return out
