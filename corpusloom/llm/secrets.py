"""Secret scan with corpus-wide ownership frequency.

Three patterns find candidates in every text, in built-in expressions only.
Candidate values are hashed and counted over the corpus by distinct owners and
repositories. A value under many owners is a widely copied example (a
documentation key, a template); a value that only a few owners hold and that
looks random is a live credential.

Defined cases: a null text counts as empty and has no spans; null owners and
repositories count as one owner and one repository of their own; repeated rows
are scanned as rows of their own and count once per owner and repository. Only
the named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.rows import ROW, let, places, salted_join, whole_text, with_row
from corpusloom.session import stage_table

ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# The shorter runs that the base patterns also match are dropped anyway.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_VALUE = 6
KINDS = ["assign", "access", "hex", "live", "copied"]

# Values under at least so many owners are widely copied.
COPIED_OWNERS = 4
# A random-looking value has so many different characters and no such word.
LIVE_CHARACTERS = 8
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]?|xxxx|redacted"


def _group(hit: Column) -> Column:
    return F.regexp_extract(hit, ASSIGN, 2)


def base_spans(text: Column) -> Column:
    """Array of ``start, kind, end, value_start, value`` of one text, by start
    and then kind; ``kind`` is the place in ``KINDS``."""

    def of(kind: int, pattern: str, value) -> Column:
        def shaped(x: Column) -> Column:
            return F.struct(
                x["start"].alias("start"),
                F.lit(kind).alias("kind"),
                x["end"].alias("end"),
                (x["end"] - F.length(x["value"])).alias("value_start"),
                x["value"].alias("value"),
            )

        found = F.filter(places(text, pattern, value), lambda x: F.length(x["value"]) >= MIN_VALUE)
        return F.when(text.rlike(pattern), F.transform(found, shaped)).otherwise(empty)

    empty = F.array().cast(
        "array<struct<start:bigint,kind:int,end:bigint,value_start:bigint,value:string>>"
    )
    whole = F.concat(of(0, ASSIGN, _group), of(1, ACCESS, lambda h: h), of(2, HEX, lambda h: h))
    return F.array_sort(whole)


def _written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", kinds[x["kind"]], x["start"], x["end"])), ","
    )


def _looks_live(value: Column) -> Column:
    varied = F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARACTERS
    return varied & value.rlike("[0-9]") & ~value.rlike(PLACEHOLDER)


def ownership(candidates: DataFrame) -> DataFrame:
    """``value_hash, owners, repositories`` from ``value_hash, owner,
    repository`` rows. Copies inside a repository fold into one row before
    the shuffle."""
    pairs = candidates.groupBy("value_hash", "owner").agg(
        F.count_distinct(F.coalesce("repository", F.lit(""))).alias("repositories")
    )
    return pairs.groupBy("value_hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories")
    )


def scan(
    docs: DataFrame,
    owner: Column,
    repository: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    copied_owners: int = COPIED_OWNERS,
) -> DataFrame:
    """One row per document: ``ROW``, ``doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_live, n_copied, most_owners``.

    ``spans`` holds the base spans and, for each candidate value, a span of kind
    ``live`` or ``copied``, or none if it is neither.
    """
    text = whole_text(text_col)
    scanned = with_row(
        docs,
        F.col(id_col).alias("doc_id"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        base_spans(text).alias("base"),
    )
    scanned = stage_table(scanned, "secret-spans")
    candidates = scanned.where(F.size("base") > 0).select(
        *ROW, "owner", "repository", F.explode("base").alias("span")
    )
    candidates = candidates.select(
        *ROW,
        "owner",
        "repository",
        "span.value_start",
        "span.end",
        F.sha2("span.value", 256).alias("value_hash"),
        _looks_live(F.col("span.value")).alias("random"),
    )
    seen = salted_join(candidates, ownership(candidates), ["value_hash"], ROW[1])
    copied = F.col("owners") >= copied_owners
    kind = F.when(copied, F.lit(4)).when(F.col("random"), F.lit(3))
    judged = seen.select(
        *ROW,
        "owners",
        F.when(
            kind.isNotNull(),
            F.struct(
                F.col("value_start").alias("start"), kind.alias("kind"), F.col("end").alias("end")
            ),
        ).alias("added"),
    )
    judged = judged.groupBy(*ROW).agg(
        F.collect_set("added").alias("added"), F.max("owners").alias("most_owners")
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    base = F.transform("base", lambda x: F.struct(x["start"], x["kind"], x["end"]))

    def count(column: str, kind: int) -> Column:
        return F.size(F.filter(column, lambda x: x["kind"] == kind)).cast("bigint")

    joined = scanned.join(judged, ROW, "left").withColumns(
        {"base": base, "added": F.coalesce("added", none)}
    )
    return joined.select(
        *ROW,
        "doc_id",
        count("base", 0).alias("n_assign"),
        count("base", 1).alias("n_access"),
        count("base", 2).alias("n_hex"),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        let(F.array_sort(F.concat("base", "added")), _written).alias("spans"),
        count("added", 3).alias("n_live"),
        count("added", 4).alias("n_copied"),
        F.coalesce("most_owners", F.lit(0)).cast("bigint").alias("most_owners"),
    )


def leaking(scanned: DataFrame) -> DataFrame:
    """``ROW`` of documents that hold a live-looking credential."""
    return scanned.where("n_live > 0").select(*ROW)
