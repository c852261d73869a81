"""Mix sources to target weights under a token budget.

Weights stand on the nodes of a tree (domain, language, source by default). A
node's budget is split among its children by weight. A child that cannot use
its part, because it has too few tokens even when repeated, takes what it can;
the shortage goes to its siblings, and to the siblings of an ancestor only when
the whole subtree is used up. Splits are in whole tokens and add up exactly.

A leaf then takes its tokens from a sequence of seeded epochs: as many complete
ones as fit, and the beginning of one more, in which documents are ordered by a
hash of seed, epoch and id. The document at the cut gives only its first
tokens.

How it runs: leaves are sums, so the tree is small. To find the cut of a leaf,
its documents are summed into as many buckets of the hash as the square root of
their number; running sums over buckets find the one with the cut, and only its
documents are ranked. No task sees a whole leaf.

Defined cases: null level values count as the empty string; documents without
tokens (null and blank texts) are never chosen; a null id hashes as the empty
string; rows that repeat an id are documents of their own; ties in the hash go
by id and then by row. Only the named columns are read. An empty table, or a
budget of zero, gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.rows import ROW, lasting, only, salted_join, with_row
from corpusloom.session import stage_table

SEED = 11
MAX_EPOCHS = 4
_BIG = "decimal(38,0)"


def words(text_col: str = "text") -> Column:
    """Tokens of a text, counted as words between ASCII blanks."""
    return F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def fill(nodes: DataFrame, parents: list[str], key: str) -> DataFrame:
    """``nodes`` (``cap``, ``weight`` and their parent's ``budget``) with
    ``take``: the parent's budget by weight, none above its ``cap``, shortages
    to the siblings. What whole numbers leave over goes to the first by
    ``key``. One row per node; children of a parent share a window."""
    family = Window.partitionBy(*(parents or [F.lit(0)]))
    before = family.orderBy("ratio", key).rowsBetween(Window.unboundedPreceding, -1)

    def so_far(c: str) -> Column:
        return F.coalesce(F.sum(c).over(before), F.lit(0)).cast(_BIG)

    big = {c: F.col(c).cast(_BIG) for c in ("cap", "weight", "budget")}
    ordered = (
        nodes.withColumn("ratio", F.col("cap").cast("double") / F.col("weight").cast("double"))
        .withColumns(big)
        .withColumn("left", F.col("budget") - so_far("cap"))
        .withColumn("heavy", F.sum("weight").over(family).cast(_BIG) - so_far("weight"))
        .withColumn("full", F.col("left") * F.col("weight") >= F.col("cap") * F.col("heavy"))
    )
    part = F.when(F.col("full"), F.col("cap")).otherwise(
        F.expr("cast(rest * weight div nullif(open_weight, 0) as decimal(38,0))")
    )
    split = (
        ordered.withColumn("spent", F.sum(F.when(F.col("full"), F.col("cap"))).over(family))
        .withColumn("rest", (F.col("budget") - F.coalesce("spent", F.lit(0))).cast(_BIG))
        .withColumn(
            "open_weight", F.sum(F.when(~F.col("full"), F.col("weight"))).over(family).cast(_BIG)
        )
        .withColumn("part", part)
        .withColumn("placed", F.sum("part").over(family))
        .withColumn("turn", F.row_number().over(family.orderBy("full", key)))
    )
    extra = (~F.col("full") & (F.col("turn") <= F.col("budget") - F.col("placed"))).cast("int")
    take = (F.col("part") + extra).cast("bigint")
    return split.select(*nodes.columns[: nodes.columns.index("cap")], take.alias("take"))


def _weight(weights: dict[tuple[str, ...], int], path: list[str]) -> Column:
    own = {"\x1f".join(p): w for p, w in weights.items() if len(p) == len(path)}
    one = F.lit(1).cast("bigint")
    if not own:
        return one
    given = F.create_map(*[F.lit(x) for item in own.items() for x in item])
    found = F.try_element_at(given, F.concat_ws("\x1f", *path))
    return F.coalesce(found.cast("bigint"), one)


def allocate(
    leaves: DataFrame,
    levels: list[str],
    weights: dict[tuple[str, ...], int],
    budget: int,
    max_epochs: int,
) -> DataFrame:
    """``leaves`` (the level columns, ``tokens``, ``docs``) with ``take``.

    ``weights`` gives a whole number per node, named by its path; a node that
    it does not name weighs 1, one of weight 0 gets nothing.
    """
    for path, weight in weights.items():
        if weight < 0:
            raise ValueError(f"the weight of {path} is negative")
        if weight == 0:
            inside = [F.col(c) == value for c, value in zip(levels, path)]
            leaves = leaves.where(~reduce(Column.__and__, inside))
    above = None
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("cap"))
        nodes = nodes.withColumn("weight", _weight(weights, path))
        if above is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("bigint"))
        else:
            nodes = nodes.join(above.withColumnRenamed("take", "budget"), levels[: depth - 1])
        nodes = nodes.select(*path, "cap", "weight", F.least("budget", F.sum("cap").over(
            Window.partitionBy(*(levels[: depth - 1] or [F.lit(0)])))).alias("budget"))
        above = fill(nodes, levels[: depth - 1], levels[depth - 1])
    return leaves.join(above, levels)


def mix(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[tuple[str, ...], int],
    share: float = 1.0,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
    tokens: Column | None = None,
) -> DataFrame:
    """Chosen documents: ``ROW``, ``doc_id``, the level columns, ``epoch`` and
    ``tokens`` (how many of its first tokens the epoch takes).

    ``levels`` maps names to columns from the root down. The budget is
    ``share`` times all tokens, rounded down; no leaf is repeated more than
    ``max_epochs`` times.
    """
    names = list(levels)
    counted = with_row(
        docs,
        F.col(id_col).alias("doc_id"),
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()],
        (words() if tokens is None else tokens).alias("tokens"),
    )
    counted = stage_table(counted.where("tokens > 0"), "mix-tokens")
    leaves = counted.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    leaves = stage_table(leaves, "mix-leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = allocate(leaves, names, weights, int(total * share), max_epochs).select(
        *names,
        F.expr("take div tokens").alias("epochs"),
        F.expr("take % tokens").alias("rest"),
        F.ceil(F.sqrt("docs")).alias("buckets"),
    )
    plan = stage_table(plan, "mix-plan")
    rows = stage_table(salted_join(counted, plan, names, ROW[1]), "mix-rows")
    out = [*ROW, "doc_id", *names]
    complete = rows.where("epochs > 0").select(
        *out, F.explode(F.expr("sequence(0L, epochs - 1)")).alias("epoch"), "tokens"
    )
    own = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # The first 32 bits of the hash, cut into the leaf's buckets.
    early = "cast(conv(substr(turn, 1, 8), 16, 10) as bigint)"
    ordered = (
        rows.where("rest > 0")
        .withColumn("turn", F.md5(F.concat_ws(":", F.lit(str(seed)), "epochs", own)))
        .withColumn("bucket", F.expr(f"{early} * buckets div 4294967296"))
    )
    sums = ordered.groupBy(*names, "bucket").agg(
        F.sum("tokens").alias("filled"), F.first("rest").alias("limit")
    )
    until = (Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*names).orderBy("bucket").rowsBetween(*until)
    sums = sums.withColumn("start", F.coalesce(F.sum("filled").over(earlier), F.lit(0)))
    sums = sums.where("start < limit").select(*names, "bucket", "start", "filled")
    begun = ordered.join(sums, [*names, "bucket"])
    last = F.col("epochs").alias("epoch")
    whole = begun.where("start + filled <= rest").select(*out, last, "tokens")
    in_turn = Window.partitionBy(*names, "bucket").orderBy("turn", "doc_id", *ROW)
    ahead = F.coalesce(F.sum("tokens").over(in_turn.rowsBetween(*until)), F.lit(0))
    cut = (
        begun.where("start + filled > rest")
        .withColumn("room", F.col("rest") - F.col("start") - ahead)
        .where("room > 0")
        .select(*out, last, F.least("tokens", "room").alias("tokens"))
    )
    return complete.unionByName(whole).unionByName(cut)


def select_documents(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[tuple[str, ...], int],
    share: float = 1.0,
    max_epochs: int = 1,
    seed: int = SEED,
) -> DataFrame:
    """Whole rows of ``docs`` that the mix takes tokens from, once per epoch."""
    docs = lasting(docs)
    taken = mix(docs, levels, weights, share, max_epochs, seed)
    return only(docs, stage_table(taken.select(*ROW), "mix-chosen"))
