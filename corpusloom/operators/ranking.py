"""Global positions and first-rows without a single-partition sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.session import stage_table

# monotonically_increasing_id() = partition number << 33 | row in partition.
_ROW_BITS = 33
# Rows of one key are spread over so many tasks in ``salted_lookup``.
_SALTS = 256


def with_position(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """Number rows 0, 1, 2, … in the given total order.

    The rows are range-partitioned and sorted once, numbered within their
    partition, and written to the shared folder so that the numbering cannot
    change under a recomputation. The partition offsets are then a table with
    one row per partition, which is the only thing broadcast. ``order`` must
    identify rows (end it with the id) so that no range holds too many.
    """
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    staged = (
        stage_table(numbered, "positions")
        .withColumn("_part", F.shiftright("_at", _ROW_BITS))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    )
    sizes = staged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        staged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_part", "_row", "_at", "_offset")
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row of every key.

    ``row_number = 1`` lets Spark cut each key to one row per map task before
    the shuffle, so a key that holds most of the table costs no more than any
    other.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def salted_lookup(rows: DataFrame, table: DataFrame, keys: list[str], salt: str) -> DataFrame:
    """``rows`` left-joined to ``table`` (one row per ``keys``).

    A key may hold a third of ``rows``. They are dealt by key and a hash of the
    unique column ``salt``; the table is joined to the distinct (key, hash)
    pairs first, of which a key has at most ``_SALTS``.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(_SALTS)))
    pairs = salted.select(*keys, "_salt").distinct().join(table, keys)
    return salted.join(pairs, [*keys, "_salt"], "left").drop("_salt")


def limit_per_group(
    df: DataFrame, column: str, values: list[str], order: list[str], n: int | None
) -> DataFrame:
    """First ``n`` rows of each listed group.

    One distributed top-n per group: a window per group would put a whole
    modality into one task once ``n`` is large.
    """
    chosen = df.where(F.col(column).isin(values))
    if n is None:
        return chosen
    parts = [df.where(F.col(column) == v).orderBy(*order).limit(n) for v in values]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
