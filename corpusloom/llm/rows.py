"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage_table

# Rows of one key spread over so many tasks where a table is joined to them.
SALTS = 256
# Names a row: the file it stands in and its place there.
ROW = ["_row_file", "_row_place"]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each made longer until no column of ``df`` is called so, in
    either case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def lasting(df: DataFrame, label: str = "rows") -> DataFrame:
    """A frame whose rows ``with_row`` names alike in every scan: ``df`` itself
    where it reads files with row numbers, else ``df`` written once."""
    return df if _placed(df) else stage_table(df, label)


def _placed(df: DataFrame) -> bool:
    try:
        df.select(df.metadataColumn("_metadata")["row_index"]).schema  # is resolved here
    except AnalysisException:
        return False
    return True


def with_row(df: DataFrame, *columns: Column, names: list[str] = ROW) -> DataFrame:
    """``columns`` of ``df`` and columns ``names`` that name each row.

    Rows of files are named by file and place, which no task layout changes, so
    a decision on a row finds it again in a second scan even if executors came
    or went in between. Ids may be null or repeat, so they can't do this. Other
    rows are numbered as they stand in this one scan; who scans twice makes the
    frame ``lasting`` first. Beside all columns of a frame ``names`` have to be
    free ones (``free_names``).
    """
    if _placed(df):
        file = df.metadataColumn("_metadata")
        place = [F.xxhash64(file["file_path"]), file["row_index"]]
    else:
        place = [F.lit(0).cast("bigint"), F.monotonically_increasing_id()]
    return df.select(*columns, *[p.alias(n) for p, n in zip(place, names)])


def _beside(df: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
    """Whole rows of ``df`` joined to the ``ROW`` columns of ``chosen``.

    ``chosen`` grows with ``df``, so it is never broadcast; it is the side that
    is hashed, so the wide rows are dealt once and not sorted.
    """
    names = free_names(df, *ROW)
    keys = [F.col(r).alias(n) for r, n in zip(ROW, names)]
    named = chosen.select(*keys).hint("shuffle_hash")
    return with_row(df, F.col("*"), names=names).join(named, names, how).drop(*names)


def without(df: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``df`` (``lasting``) that ``gone`` does not name."""
    return _beside(df, gone, "left_anti")


def only(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``df`` (``lasting``) that ``chosen`` names, as often as it does."""
    return _beside(df, chosen, "inner")


def salted_lookup(rows: DataFrame, table: DataFrame, keys: list[str], salt: str) -> DataFrame:
    """``rows`` left-joined to ``table`` (one row per ``keys``).

    A key may hold a third of ``rows``. Rows are dealt by key and a hash of the
    ``salt`` column; the table is first joined to the distinct (key, salt)
    pairs, at most ``SALTS`` per key, so no task gets a whole key.
    """
    (name,) = free_names(rows.join(table, keys), "_salt")
    salted = rows.withColumn(name, F.pmod(F.xxhash64(F.col(salt)), F.lit(SALTS)))
    pairs = salted.select(*keys, name).distinct().join(table, keys)
    return salted.join(pairs, [*keys, name], "left").drop(name)


def salted_join(
    rows: DataFrame, table: DataFrame, keys: list[str], salt: str, n: int = 16
) -> DataFrame:
    """``rows`` left-joined to a narrow ``table`` (one row per ``keys``) that
    is repeated ``n`` times, so that a hot key's rows meet in ``n`` tasks."""
    (name,) = free_names(rows.join(table, keys), "_salt")
    salts = F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>")
    copies = table.withColumn(name, F.explode(salts))
    salted = rows.withColumn(name, F.pmod(F.xxhash64(F.col(salt)), F.lit(n)))
    return salted.join(copies, [*keys, name], "left").drop(name)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def whole_text(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(numbers: Column) -> Column:
    """Sum of an array, 0 for an empty one."""
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: a + x)


def running(numbers: Column, fold: Callable[[Column], Column] = total) -> Column:
    """For each number of an array ``fold`` of those before it: by default
    their sum; any fold of folds of parts will do.

    In blocks of about the square root of the length, so that a text with very
    many places does not cost their square.
    """

    def in_blocks(s: Column) -> Column:
        n, step = s["numbers"], s["step"]
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(n) - 1) / step).cast("int")),
            lambda b: fold(F.slice(n, b * step + 1, step)),
        )
        return let(blocks, lambda folds: let(bases(folds), lambda base: all_of(n, step, base)))

    def bases(folds: Column) -> Column:
        return F.transform(folds, lambda _, b: fold(F.slice(folds, F.lit(1), b)))

    def all_of(n: Column, step: Column, base: Column) -> Column:
        def before(_, k):
            block = F.floor(k / step).cast("int")
            own = fold(F.slice(n, block * step + 1, k - block * step))
            return fold(F.array(F.get(base, block), own))

        return F.transform(n, before)

    def whole(n: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(n))).cast("int")
        inner = let(F.struct(n.alias("numbers"), step.alias("step")), in_blocks)
        return F.when(F.size(n) > 0, inner).otherwise(F.array().cast("array<bigint>"))

    return let(numbers, whole)


def places(text: Column, pattern: Column | str, value: Callable[[Column], Column]) -> Column:
    """All leftmost, non-overlapping matches of a regular expression as an
    array of ``start, end, value`` (code points, end exclusive).

    The engine gives the matches and the text between them; their lengths give
    the places. ``value`` is computed from the matched string.
    """
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern

    def placed(s: Column) -> Column:
        gaps, hits = s["gaps"], s["hits"]
        steps = F.transform(
            hits, lambda h, k: (F.length(gaps[k]) + F.length(h)).cast("bigint")
        )
        return let(running(steps), lambda before: F.transform(hits, span(gaps, before)))

    def span(gaps: Column, before: Column):
        def one(h: Column, k: Column) -> Column:
            start = before[k] + F.length(gaps[k])
            return F.struct(
                start.alias("start"), (start + F.length(h)).alias("end"), value(h).alias("value")
            )

        return one

    parts = F.struct(
        F.split(text, regex, -1).alias("gaps"),
        F.regexp_extract_all(text, regex, F.lit(0)).alias("hits"),
    )
    return let(parts, placed)
