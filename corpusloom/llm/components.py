"""Connected components of a link table, as rounds of joins.

Large-star and small-star steps alternate (Kiveris et al., 2014): the first
links every larger neighbour of a node to the node's smallest neighbour, the
second every smaller one. The table shrinks to stars whose centres are the
smallest nodes. Each round is written to the shared folder, so a lost executor
repeats tasks of that round only; nothing but a row count and a checksum
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.rows import salted_join
from corpusloom.session import discard, fresh_path, release, stage_at

# A hub's links are dealt to so many tasks.
_SPREAD = 8


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that ``links`` joins to another one;
    ``root`` is the smallest node of its component.

    Nodes are longs. Self links, links with a null and repeated links change
    nothing; an empty table gives an empty result.
    """
    spark = links.sparkSession
    hi, lo = F.greatest(a, b), F.least(a, b)
    pairs = links.where(F.col(a) != F.col(b)).select(hi.alias("u"), lo.alias("v")).distinct()
    path = fresh_path(spark, "stars")
    pairs = stage_at(pairs, path)
    before = _mark(pairs)
    while True:
        next_path = fresh_path(spark, "stars")
        stars = stage_at(_small_star(_large_star(pairs)), next_path)
        discard(spark, path)
        after = _mark(stars)
        # Every round is a plan of its own.
        release(spark)
        if after == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        pairs, path, before = stars, next_path, after


def _mark(pairs: DataFrame) -> tuple:
    return tuple(
        pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first()
    )


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each row with ``m``, the smallest of its ``u`` and that one's ``v``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return salted_join(pairs, least, ["u"], "v", _SPREAD)


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    larger = _with_least(both).where("v > u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    found = _with_least(pairs)
    centre = found.select("u", F.col("m").alias("v"))
    others = found.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return centre.unionByName(others).distinct()
