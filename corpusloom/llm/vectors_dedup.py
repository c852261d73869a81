"""Near-duplicate vectors by random-hyperplane signs in several tables.

Each table gives a vector the signs of its products with ``bits`` random
planes as bucket key. Two vectors at angle t share a key with probability
(1 - t/pi) ** bits, so of the pairs at the threshold 0.95 itself ``1 - (1 -
0.8989**14)**16`` = 98 % meet in one of 16 tables of 14 bits, and of closer
pairs more. Every pair that meets is verified by its cosine in double
precision; none below the threshold links. A pair is counted in the first
table where it meets. ``bits`` should grow with the logarithm of the number of
distinct vectors and ``tables`` with it; both are parameters, the recall of the
defaults is tested against brute force.

Equal vectors are one class, so a group of copies of any size is one row per
table; crowded buckets are compared in cells of bounded size (``cells``).
Links form components by rounds of joins (``components``).

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; their component is their own id. Vectors of
different lengths link with their own length only. A row with a null id links like
any other and belongs to the component of the smallest id it reaches; where all of
them are null, the component is null and all its rows count as kept. Rows that
repeat an id are vectors of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.cells import compare
from corpusloom.llm.components import components
from corpusloom.llm.rows import salted_lookup
from corpusloom.session import stage_table

THRESHOLD = 0.95
TABLES = 16
BITS = 14  # at most 32, a key is packed into four bytes
SEED = 17


def finite(vec: str) -> Column:
    """Whether no component is null, NaN or infinite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vec).isNotNull() & ~bad


def _sign_keys(tables: int, bits: int, seed: int):
    schema = "node bigint, weight bigint, vec array<double>, signs binary"
    powers = (1 << np.arange(bits)).astype(np.int64)
    planes: dict[int, np.ndarray] = {}

    def run(batches):
        for batch in batches:
            sizes = batch["vec"].map(len).to_numpy()
            for dim in np.unique(sizes):
                if dim not in planes:
                    rng = np.random.default_rng(seed)
                    planes[dim] = rng.standard_normal((dim, tables * bits))
                out = batch.loc[sizes == dim, ["node", "weight", "vec"]].copy()
                unit = _unit(np.stack(out["vec"].to_numpy()))
                signs = (unit @ planes[dim] > 0).reshape(len(out), tables, bits)
                keys = (signs @ powers).astype("<u4")
                out["signs"] = [row.tobytes() for row in keys]
                yield out

    return run, schema


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    # Scaled first: squares of very large or small components would overflow.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _near(threshold: float, tables: int):
    def load(held: pd.DataFrame):
        sizes = held["vec"].map(len)
        vecs, most = held["vec"].to_numpy(), sizes.max()
        if (sizes != most).any():
            # Cells hold vectors of one length; zeros make those of several one matrix.
            vecs = [np.pad(v, (0, most - len(v))) for v in vecs]
        unit = _unit(np.stack(vecs))
        signs = np.frombuffer(b"".join(held["signs"]), "<u4").reshape(len(held), tables)
        bucket = held["bucket"].to_numpy()

        def first_here(a, b):
            """Whether no earlier table has the pair in one bucket."""
            earlier = np.arange(tables) < bucket[a][:, None]
            return ~((signs[a] == signs[b]) & earlier).any(axis=1)

        def near(a, b, outer=False):
            if not outer:
                hit = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
                at = np.flatnonzero(hit)
                hit[at] = first_here(a[at], b[at])
                return hit
            hits = unit[a] @ unit[b].T >= threshold
            x, y = np.nonzero(hits)
            hits[x, y] = first_here(a[x], b[y])
            return hits

        return near

    return load


def vector_links(
    classes: DataFrame, threshold: float, tables: int, bits: int, seed: int
) -> DataFrame:
    """What the nodes of ``classes`` (``node, weight, vec``; distinct vectors)
    find: ``node, links, root``, a node possibly several times."""
    run, schema = _sign_keys(tables, bits, seed)
    signed = classes.mapInPandas(run, schema)
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(tables - 1)),
        # Four bytes of each table, as text and back, stay a built-in expression;
        # above them the length, so that only vectors of one length meet.
        lambda t: F.conv(F.hex(F.substring("signs", t * 4 + 1, F.lit(4))), 16, 10).cast("bigint")
        + F.shiftleft(F.size("vec").cast("bigint"), 32),
    )
    rows = signed.select("node", "weight", "vec", "signs", F.posexplode(keys).alias("bucket", "key"))
    return compare(rows, _near(threshold, tables))


def near_dedup(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = THRESHOLD,
    tables: int = TABLES,
    bits: int = BITS,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors``.

    ``n_links`` counts the other rows linked directly, copies included;
    ``component_id`` is the smallest id reachable by links.
    """
    if not 0 < bits <= 32 or tables < 1 or not 0 < threshold <= 1:
        raise ValueError("needs 1 to 32 bits, a table and a threshold in (0, 1]")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"))
    usable = finite("vec") & F.exists("vec", lambda x: x != 0)
    # 96 bits name a vector where only its class is looked up.
    name = [F.xxhash64("vec").alias("h1"), F.hash("vec").alias("h2")]
    order = [F.col("first_id").asc_nulls_last(), "h1", "h2"]
    classes = (
        rows.where(usable)
        .select("vec_id", "vec", *name)
        .groupBy("h1", "h2", "vec")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        # Numbers in the order of the ids: the smallest node has the smallest id.
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = stage_table(classes, "vector-classes")
    found = vector_links(
        classes.select("node", "weight", F.col("vec").cast("array<double>").alias("vec")),
        threshold,
        tables,
        bits,
        seed,
    )
    found = stage_table(found, "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found, "node", "root")
    heads = classes.select(F.col("node").alias("root"), F.col("first_id").alias("component_id"))
    member = (
        classes.select("h1", "h2", "node", "first_id", "weight")
        .join(links, "node", "left")
        .join(salted_lookup(roots, heads, ["root"], "node").drop("root"), "node", "left")
        .select(
            "h1",
            "h2",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component_id", "first_id").alias("component_id"),
        )
    )
    keyed = rows.select("vec_id", *[F.when(usable, h).alias(n) for h, n in zip(name, ("h1", "h2"))])
    return salted_lookup(keyed, member, ["h1", "h2"], "vec_id").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
