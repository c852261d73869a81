"""Quality rules: a threshold table compiled into one projection.

``TABLE`` lists rules as data: a ratio of two counts, in hundredths, and the
range that good texts keep to. ``judge`` compiles it into columns of one
projection over the texts: lengths, symbols, stop words, lines and repetition
are counted with built-in functions, the ratios are compared in whole numbers.
There is no user function, no shuffle and no second scan; a row is judged where
it is read, so copies and hot sources cost what other rows do.

Two rules come first and fail a text whatever the table says: too few words, and
too many words in windows of five that stand twice or more in the text.

Defined cases: a null text has no words, counts of 0 and fails the first rule, as
does an empty one; rules of the table whose divisor is 0, or that start at more
words than a text has, are passed. Repeated rows are judged each. Whole texts are
judged; the windows of one text are held in memory while it is. Only the named
columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.rows import let, total

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # hundredths of the words
SYMBOLS = "#*$%&|<>"
_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"

# Frequent function words, which running text of any subject has; in lower case.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as by be this are at from or not",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch",
    "fr": "de la le et les des en un du une que pour est dans qui par sur pas au avec ce il",
    "es": "de la que el en y los se las del un por con no una su para al es lo como",
}


@dataclass(frozen=True)
class Rule:
    """``count`` may be ``least`` to ``most`` hundredths of ``of`` in texts of
    ``from_words`` words and more; None for no limit."""

    name: str
    count: str
    of: str
    least: int | None = None
    most: int | None = None
    from_words: int = 0


# Counts that rules may name: see ``counts``.
TABLE = [
    Rule("word_length", "word_chars", "n_words", least=250, most=1200),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("letters", "n_letter_words", "n_words", least=60),
    Rule("stop_words", "n_stop_words", "n_words", least=4, from_words=20),
    Rule("dup_lines", "n_dup_lines", "n_lines", most=40),
    Rule("dup_line_chars", "dup_line_chars", "line_chars", most=20),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=90),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=30),
]
COUNTED = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words",
    "n_letter_words", "n_lines", "line_chars", "dup_line_chars", "n_bullet_lines",
    "n_ellipsis_lines",
]


def all_stop_words() -> list[str]:
    return sorted({w for words in STOP_WORDS.values() for w in words.split()})


def _long(n: Column) -> Column:
    return n.cast("bigint")


def _repeat_words(words: Column) -> Column:
    """Words in windows that stand twice or more in the text."""

    def covered(places: Column) -> Column:
        # Each window adds what the next one does not cover.
        steps = F.transform(
            places, lambda p, k: F.least(F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return total(_longs(steps))

    def repeated(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda x, k: F.coalesce(F.get(ordered, k - 1)["w"] == x["w"], F.lit(False))
            | F.coalesce(F.get(ordered, k + 1)["w"] == x["w"], F.lit(False)),
        )
        return let(F.array_sort(F.transform(same, lambda x: x["at"])), covered)

    def among(windows: Column) -> Column:
        placed = F.transform(windows, lambda w, k: F.struct(w.alias("w"), k.alias("at")))
        found = let(F.array_sort(placed), repeated)
        # Most texts repeat no window: a set of them tells that without a sort.
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), found).otherwise(_zero())

    # Word by word: a slice would copy the whole list for every window.
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(WINDOW)]),
    )
    return F.when(F.size(words) > WINDOW, let(windows, among)).otherwise(_zero())


def _longs(numbers: Column) -> Column:
    return F.transform(numbers, _long)


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _chars(strings: Column) -> Column:
    return total(F.transform(strings, lambda x: _long(F.length(x))))


def _of_words(words: Column, stop_words: list[str]) -> Column:
    stops = F.filter(words, lambda w: F.lower(w).isin(stop_words))
    letters = F.filter(words, lambda w: w.rlike(r"\p{L}"))
    return F.struct(
        _long(F.size(words)).alias("n_words"),
        _repeat_words(words).alias("n_repeat_words"),
        _long(F.size(stops)).alias("n_stop_words"),
        _long(F.size(letters)).alias("n_letter_words"),
    )


def _of_lines(lines: Column) -> Column:
    def told(distinct: Column) -> Column:
        bullets = F.filter(lines, lambda x: x.rlike(rf"^{_BLANK}*[-*•]"))
        dots = F.filter(lines, lambda x: x.rlike(rf"(?:\.\.\.|…){_BLANK}*\z"))
        return F.struct(
            _long(F.size(lines)).alias("n_lines"),
            _long(F.size(lines) - F.size(distinct)).alias("n_dup_lines"),
            _chars(lines).alias("line_chars"),
            (_chars(lines) - _chars(distinct)).alias("dup_line_chars"),
            _long(F.size(bullets)).alias("n_bullet_lines"),
            _long(F.size(dots)).alias("n_ellipsis_lines"),
        )

    return let(F.array_distinct(lines), told)


def counts(text: Column, stop_words: list[str]) -> dict[str, Column]:
    """Structs of the counts that rules may name.

    ``word_chars``: code points in words; ``n_letter_words``: words with a
    letter; ``n_dup_lines``: lines with a word that equal an earlier one, their
    length in ``dup_line_chars``; ``n_lines``, ``line_chars``: of lines with a word.
    """
    words = F.filter(F.split(text, f"{_BLANK}+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(_WORD))
    plain = F.length(F.regexp_replace(text, f"{_BLANK}+", ""))
    symbols = F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))
    chars = F.struct(_long(plain).alias("word_chars"), _long(symbols).alias("n_symbols"))
    return {
        "chars": chars,
        "words": let(words, lambda w: _of_words(w, stop_words)),
        "lines": let(lines, _of_lines),
    }


def fails(rule: Rule) -> Column:
    """Whether a row of counts breaks a rule."""
    share, of = F.col(rule.count) * 100, F.col(rule.of)
    broken = F.lit(False)
    if rule.least is not None:
        broken = broken | (share < of * rule.least)
    if rule.most is not None:
        broken = broken | (share > of * rule.most)
    return (of > 0) & (F.col("n_words") >= rule.from_words) & broken


def judge(
    docs: DataFrame,
    table: list[Rule] | None = None,
    stop_words: list[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and ``failed`` (names of
    the table's broken rules, comma-joined) for each row."""
    rules = TABLE if table is None else table
    stops = all_stop_words() if stop_words is None else stop_words
    parts = counts(F.coalesce(F.col(text_col), F.lit("")), stops)
    counted = docs.select(F.col(id_col).alias("doc_id"), *[c.alias(n) for n, c in parts.items()])
    counted = counted.select("doc_id", *[F.col(f"{n}.*") for n in parts])
    base = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED
    )
    names = [F.when(fails(r), F.lit(r.name)) for r in rules]
    judged = counted.withColumns({"base_failed": base, "failed": F.concat_ws(",", *names)})
    kept = ~F.col("base_failed") & (F.col("failed") == "")
    return judged.select("doc_id", *COUNTED, "base_failed", kept.alias("kept"), "failed")
