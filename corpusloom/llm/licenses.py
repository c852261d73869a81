"""Licence scan: ordered signature rules over whole texts.

A text becomes its words, lower case, with one blank between them. Hundreds of
rules (``license_rules``) are regular expressions, each looked for only in
texts that hold one of its keywords. Overlapping detections are resolved by priority and
containment: one that lies inside another of at least its strength is
suppressed, and so is one around another that is stronger. Of equal ones the
stronger or, among equals, the one of the earlier rule stays.

Three base phrases are reported besides, whatever the rules find. Everything is
built from DataFrame functions; a text is handled by the task that reads it, no
row is shuffled.

Defined cases: a null text counts as empty, has no words, no labels and score
0; repeated rows are scanned each. Only the named columns are read. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.license_rules import Rule, rules
from corpusloom.llm.rows import ascii_lower, let, places, running, whole_text

# The base phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
BASE_SCORE = 0.5
_FAR = 1 << 40


def words_of(text: Column) -> Column:
    """The words with one blank between them and at both ends; a text without
    words is one blank."""
    between = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return F.regexp_replace(F.concat(F.lit(" "), ascii_lower(text), F.lit(" ")), between, " ")


def _whole_words(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _base(words: Column) -> Column:
    """``n, first, last, labels`` of the base phrases."""
    found = places(words, _whole_words("|".join(PHRASES)), lambda hit: hit)
    named = F.create_map(*[F.lit(x) for item in PHRASES.items() for x in item])

    def index(start: Column) -> Column:
        return (_blanks(F.substring(words, F.lit(1), start.cast("int"))) - 1).cast("bigint")

    def told(hits: Column) -> Column:
        return F.struct(
            F.size(hits).cast("bigint").alias("n"),
            index(F.element_at(hits, 1)["start"]).alias("first"),
            index(F.element_at(hits, -1)["start"]).alias("last"),
            F.array_distinct(F.transform(hits, lambda x: named[x["value"]])).alias("labels"),
        )

    nothing = F.struct(
        F.lit(0).cast("bigint").alias("n"),
        F.lit(None).cast("bigint").alias("first"),
        F.lit(None).cast("bigint").alias("last"),
        F.array().cast("array<string>").alias("labels"),
    )
    holds = F.lit(False)
    for phrase in PHRASES:
        holds = holds | F.contains(words, F.lit(f" {phrase} "))
    return F.when(holds, let(found, told)).otherwise(nothing)


def _most(numbers: Column) -> Column:
    return F.coalesce(F.array_max(numbers), F.lit(-_FAR))


def _least(numbers: Column) -> Column:
    return F.coalesce(F.array_min(numbers), F.lit(_FAR))


def _unsuppressed(found: Column, priorities: list[int]) -> Column:
    """Of detections in order of start (and longest first) those that stay."""

    def ends(hits: Column, priority: int, other: int) -> Column:
        return F.transform(
            hits, lambda x: F.when(x["priority"] == priority, x["end"]).otherwise(F.lit(other))
        )

    def limits(hits: Column) -> Column:
        # Before a detection stand those that start no later, after it those
        # that start no earlier: the farthest and nearest ends tell.
        around = [running(ends(hits, p, -_FAR), _most).alias(f"far{p}") for p in priorities]
        inside = [
            F.reverse(running(F.reverse(ends(hits, p, _FAR)), _least)).alias(f"near{p}")
            for p in priorities
        ]
        return F.struct(hits.alias("hits"), *around, *inside)

    def stays(s: Column):
        def one(x: Column, k: Column) -> Column:
            covered, surrounds = F.lit(False), F.lit(False)
            for p in priorities:
                covered = covered | ((x["priority"] >= p) & (s[f"far{p}"][k] >= x["end"]))
                surrounds = surrounds | ((x["priority"] > p) & (s[f"near{p}"][k] <= x["end"]))
            return ~(covered | surrounds)

        return F.filter(s["hits"], one)

    return let(found, lambda hits: let(limits(hits), stays))


def _detections(words: Column, known: list[Rule]) -> Column:
    """``labels`` and ``score`` of what the rules find and keep."""
    table = F.array(
        *[
            F.struct(
                F.array(*[F.lit(f" {k} ") for k in r.keyword.split()]).alias("keywords"),
                F.lit(_whole_words(r.pattern)).alias("pattern"),
                F.lit(r.priority).alias("priority"),
                F.lit(i).alias("rule"),
                F.lit(r.label).alias("label"),
                F.lit(r.weight).alias("weight"),
            )
            for i, r in enumerate(known)
        ]
    )

    def hits_of(r: Column) -> Column:
        return F.transform(
            places(words, r["pattern"], lambda hit: hit),
            lambda x: F.struct(
                x["start"].alias("start"),
                (-x["end"]).alias("minus_end"),
                r["priority"].alias("priority"),
                r["rule"].alias("rule"),
                x["end"].alias("end"),
                r["label"].alias("label"),
                r["weight"].alias("weight"),
            ),
        )

    gated = F.filter(table, lambda r: F.exists(r["keywords"], lambda k: F.contains(words, k)))
    found = F.array_sort(F.flatten(F.transform(gated, hits_of)))
    priorities = sorted({r.priority for r in known})
    nothing = F.struct(
        F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score")
    )

    def told(kept: Column) -> Column:
        weights = F.transform(kept, lambda x: x["weight"])
        return F.struct(
            F.array_distinct(F.transform(kept, lambda x: x["label"])).alias("labels"),
            F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"),
        )

    # One look for all keywords spares most texts the rules.
    some = _whole_words("|".join(sorted({k for r in known for k in r.keyword.split()})))
    return F.when(words.rlike(some), let(_unsuppressed(found, priorities), told)).otherwise(nothing)


def scan(
    docs: DataFrame,
    known: list[Rule] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), words_of(whole_text(text_col)).alias("words"))
    words = F.col("words")
    told = rows.select(
        "doc_id",
        (_blanks(words) - 1).cast("bigint").alias("n_words"),
        _base(words).alias("base"),
        _detections(words, rules() if known is None else known).alias("method"),
    )

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(labels), ",")

    return told.select(
        "doc_id",
        "n_words",
        F.col("base.n").alias("n_base"),
        F.col("base.first").alias("first_word"),
        F.col("base.last").alias("last_word"),
        joined(F.col("base.labels")).alias("base_labels"),
        joined(F.array_union("base.labels", "method.labels")).alias("labels"),
        F.greatest(
            F.when(F.col("base.n") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0)), "method.score"
        ).alias("score"),
    )
