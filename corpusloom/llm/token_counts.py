"""Token counts by merging ragged arrays rank by rank.

The distinct pieces of many texts stand in one array of symbols, first their
bytes, with a number for the piece each belongs to. In each round every piece
looks for its pair of neighbours with the lowest rank and merges all places of
that pair, all pieces at the same time; what has no pair left is done. The
symbols that survive are the tokens.

Counts of pieces are remembered within bounds, so a frequent word is merged
once per worker.

Defined cases: a null text counts as empty and has no bytes and no tokens;
special strings of the vocabulary inside a text are one token each; lone
surrogates cannot occur in a column of strings; rows that repeat an id are
counted each. Only the named columns are read. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.pretokens import (
    PATTERN,
    Memo,
    blocks,
    byte_letters,
    merge_pairs,
    read_json,
    special_strings,
    vocabulary_path,
)

LIMIT = 512
# Blocks a worker remembers per generation, and texts it handles at a time.
MEMO = 400_000
_TEXTS = 512
# Bytes of pieces merged at a time; one longer piece is merged alone.
_ROUND_BYTES = 1 << 21
_NONE = np.int64(1 << 40)


class Merges:
    """Ranks of pairs as open-addressed arrays: a pair of symbols is looked up
    for a whole array of pairs at once."""

    def __init__(self, spec: dict):
        vocabulary = spec["model"]["vocab"]
        letters = byte_letters()
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocabulary[letter]
        pairs = merge_pairs(spec)
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.made = made
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, np.int64)
        codes = (left << 20) | right
        rank = np.arange(len(pairs))
        slot = self._slot(codes)
        while len(codes):
            free = self.keys[slot] == -1
            # Of those that want one slot, one gets it; the rest go on.
            self.keys[slot[free]] = codes[free]
            placed = self.keys[slot] == codes
            self.ranks[slot[placed]] = rank[placed]
            codes, rank, slot = codes[~placed], rank[~placed], slot[~placed]
            slot = (slot + 1) & ((1 << self.bits) - 1)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` for those that never merge."""
        codes = (left << 20) | right
        slot = self._slot(codes)
        out = np.full(len(codes), _NONE, np.int64)
        open_ = np.arange(len(codes))
        while len(open_):
            held = self.keys[slot]
            hit = held == codes
            out[open_[hit]] = self.ranks[slot[hit]]
            on = ~hit & (held != -1)
            open_, codes = open_[on], codes[on]
            slot = (slot[on] + 1) & ((1 << self.bits) - 1)
        return out


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    return Merges(read_json(path))


def count_pieces(pieces: list[bytes], merges: Merges) -> np.ndarray:
    """Surviving symbols of each piece."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    counts = np.zeros(len(pieces), np.int64)
    ends = np.cumsum(lengths)
    at = 0
    while at < len(pieces):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + _ROUND_BYTES, "right")))
        counts[at:stop] = _merge(pieces[at:stop], lengths[at:stop], merges)
        at = stop
    return counts


def _merge(pieces: list[bytes], lengths: np.ndarray, merges: Merges) -> np.ndarray:
    symbols = merges.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), lengths)
    counts = np.zeros(len(pieces), np.int64)
    rank = _pair_ranks(symbols, owner, merges)
    while len(symbols):
        best = np.full(len(pieces), _NONE, np.int64)
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        own = owner[starts]
        best[own] = np.minimum.reduceat(rank, starts)
        # Pieces without a pair are done: their symbols are counted and leave.
        finished = best[own] == _NONE
        if finished.any():
            sizes = np.diff(np.r_[starts, len(symbols)])
            counts[own[finished]] = sizes[finished]
            stay = np.repeat(~finished, sizes)
            symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
            if not len(symbols):
                break
        here = rank == best[owner]
        here = _every_other(here)
        first = np.flatnonzero(here)
        symbols[first] = merges.made[rank[first]]
        keep = np.ones(len(symbols), bool)
        keep[first + 1] = False
        # A pair whose left or right symbol changed gets a new rank.
        touched = here[keep]
        symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
        again = touched.copy()
        again[:-1] |= touched[1:]
        spots = np.flatnonzero(again)
        rank[spots] = _ranks_at(spots, symbols, owner, merges)
    return counts


def _every_other(here: np.ndarray) -> np.ndarray:
    """Of pairs that overlap in a row (``aaa``), the first, third and so on."""
    if not (here[1:] & here[:-1]).any():
        return here
    at = np.arange(len(here))
    begins = here & ~np.r_[False, here[:-1]]
    start = np.maximum.accumulate(np.where(begins, at, 0))
    return here & ((at - start) % 2 == 0)


def _pair_ranks(symbols: np.ndarray, owner: np.ndarray, merges: Merges) -> np.ndarray:
    return _ranks_at(np.arange(len(symbols)), symbols, owner, merges)


def _ranks_at(spots, symbols, owner, merges) -> np.ndarray:
    """Rank of the pair that starts at each spot; none at the end of a piece."""
    out = np.full(len(spots), _NONE, np.int64)
    inner = spots + 1 < len(symbols)
    inner[inner] = owner[spots[inner] + 1] == owner[spots[inner]]
    at = spots[inner]
    out[inner] = merges.rank(symbols[at], symbols[at + 1])
    return out


class Counter:
    """Counts the tokens of texts with one vocabulary file."""

    def __init__(self, path: str, memo: int = MEMO):
        self.merges = merges_of(path)
        special = special_strings(read_json(path))
        self.special = (
            regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))))
            if special
            else None
        )
        self.memo = Memo(memo)

    def counts(self, texts: list[str]) -> np.ndarray:
        parts, extra = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = self.special.split(text) if self.special else [text]
            extra[i] = len(found) - 1
            parts.append([b for x in found for b in blocks(x)])
        fresh = self.memo.missing(x for part in parts for x in part)
        if fresh:
            pieces = [PATTERN.findall(x) for x in fresh]
            flat = [p.encode("utf-8", "replace") for found in pieces for p in found]
            sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
            sums = np.r_[0, np.cumsum(count_pieces(flat, self.merges))]
            ends = np.cumsum(sizes)
            self.memo.add(fresh, (sums[ends] - sums[ends - sizes]).tolist())
        known = self.memo.new.__getitem__
        out = np.fromiter((sum(map(known, part)) for part in parts), np.int64, len(parts))
        self.memo.turn()
        return out + extra


def _counter(path: str):
    @F.pandas_udf("bigint")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(path)
        for texts in parts:
            rows = ["" if t is None else t for t in texts]
            made = [counter.counts(rows[i : i + _TEXTS]) for i in range(0, len(rows), _TEXTS)]
            yield pd.Series(np.concatenate(made) if made else np.zeros(0, np.int64))

    return run


def token_counts(
    docs: DataFrame,
    path: str | None = None,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``."""
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes"),
        _counter(path or vocabulary_path())(F.col(text_col)).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
