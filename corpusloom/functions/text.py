"""Text expressions that agree with Python's string methods, run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what str.split() treats as a separator. Java's (?U)\s lacks the
# four control characters 1C-1F.
_SPACE = "\\s\\x1c-\\x1f"
_WHITESPACE = f"(?U)[{_SPACE}]+"


def normalize_ws(c: Column) -> Column:
    """Every whitespace run becomes one space, ends trimmed; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), _WHITESPACE, " "))


def truncate(c: Column, n: int | None) -> Column:
    """First ``n`` code points; ``None`` keeps the whole text."""
    return c if n is None else F.substring(c, 1, n)


def compact(c: Column, max_len: int = 160) -> Column:
    """Shorten with a trailing '...' so the result has at most ``max_len``."""
    return F.when(F.length(c) <= max_len, c).otherwise(
        F.concat(F.substring(c, 1, max_len - 3), F.lit("..."))
    )


def word_count(normalized: Column) -> Column:
    """Words of a whitespace-normalised text.

    Counts separators instead of building the array of words. A cut can leave
    one trailing space, which is no word boundary.
    """
    c = F.rtrim(normalized)
    spaces = F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))
    return F.when(c == "", F.lit(0)).otherwise(spaces + 1)


def at_least_words(c: Column, n: int) -> Column:
    """Whether any text, normalised or not, has ``n`` words or more. Reading
    stops at the n-th word, which makes this the cheap form of a length rule."""
    if n <= 0:
        return F.lit(True)
    word = f"[^{_SPACE}]++[{_SPACE}]++"
    pattern = f"(?U)^[{_SPACE}]*+(?:{word}){{{n - 1}}}[^{_SPACE}]"
    return F.coalesce(c.rlike(pattern), F.lit(False))


def letter_count(c: Column) -> Column:
    """Characters that are Unicode letters."""
    return F.length(F.regexp_replace(c, "[^\\p{L}]+", ""))


def alpha_ratio(c: Column) -> Column:
    """Share of letters; null for an empty text, which no ratio rule judges."""
    return F.when(F.length(c) > 0, letter_count(c) / F.length(c))


def content_hash(c: Column) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 bytes (or of a binary column)."""
    return F.sha2(c, 256)


def padded_id(prefix: str, width: int, number: Column) -> Column:
    """``prefix`` followed by ``number`` zero-padded to ``width``."""
    return F.format_string(f"{prefix}%0{width}d", number)


def int_or(c: Column, default: Column) -> Column:
    """``c`` unless it is null or zero: zero falls through to the default too."""
    return F.when(c.isNull() | (c == 0), default).otherwise(c)


def first_nonempty(*cols: Column) -> Column:
    """First column whose text is neither null nor ''; '' when there is none."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def clean_list(arr: Column) -> Column:
    """Trim every element and drop the empty ones."""
    stripped = F.transform(
        arr, lambda x: F.regexp_replace(x, f"^{_WHITESPACE}|{_WHITESPACE}$", "")
    )
    return F.filter(stripped, lambda x: x != "")
