"""Pack tokenised documents into windows by the sum of squares.

Each task keeps a level array: how many of its open windows are filled to each
level. A document goes to the level (or a new window) that makes the sum of
squared counts smallest afterwards, which keeps windows of all levels at hand
(Csirik et al., 2006). Documents longer than a window are cut into full windows
first; the rest is placed.

When a task has ended, or holds more than ``MAX_OPEN`` open windows, the
emptiest ones are cut up to fill the fullest. What remains, less than one
window per task, is cut into sequences whose lengths are powers of two, which
need no padding.

A task packs the rows it reads, without a shuffle; it holds open windows and
one batch. Which rows share a sequence follows the layout of the input files; a
task that is repeated gives the same sequences.

Defined cases: a null text counts as empty and is its closing id alone; rows
that repeat an id, or have none, are documents of their own. Only the named
columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.pretokens import (
    PIECES,
    Memo,
    blocks,
    byte_letters,
    merge_pairs,
    read_json,
    vocabulary_path,
)

WINDOW = 1024
CLOSING_ID = 0
MAX_OPEN = 4096
MEMO = 300_000
_TEXTS = 512
_OUT_ROWS = 20_000
# A blank with a word behind it and no other blank.
_WORD = re.compile(r" [^\s\x85][^ ]*\Z")


class Piece:
    """Some successive ids of a document."""

    __slots__ = ("doc", "start", "ids", "doc_tokens")

    def __init__(self, doc, start: int, ids: np.ndarray, doc_tokens: int):
        self.doc, self.start, self.ids, self.doc_tokens = doc, start, ids, doc_tokens

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, self.ids[:at], self.doc_tokens),
            Piece(self.doc, self.start + at, self.ids[at:], self.doc_tokens),
        )


class Packer:
    """Places pieces; ``closed`` collects the sequences that are complete."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.closed: list[list[Piece]] = []
        self._reset()

    def _reset(self) -> None:
        self.levels = np.zeros(self.window + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(self.window + 1)]
        self.n_open = 0

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for at in range(0, whole, self.window):
            self.closed.append([Piece(doc, at, ids[at : at + self.window], len(ids))])
        if whole < len(ids):
            # A copy, so that the window does not hold on to the whole document.
            self._place(Piece(doc, whole, ids[whole:].copy(), len(ids)))
        if self.n_open > self.max_open:
            self._even_out()

    def level_for(self, size: int) -> int:
        """The level to fill up by ``size``; 0 is a new window."""
        n, top = self.levels, self.window
        before, after = n[: top - size + 1], n[size:]
        change = 2 * (after - before) + 2
        change[0] = 2 * n[size] + 1
        change[top - size] = (0 if size == top else -2 * n[top - size]) + 1
        change[1:][before[1:] == 0] = np.iinfo(np.int64).max
        # Of equally good ones the fullest.
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def _place(self, piece: Piece) -> None:
        size = len(piece.ids)
        level = self.level_for(size)
        if level:
            content = self.open[level].pop()
            self.levels[level] -= 1
        else:
            content = []
            self.n_open += 1
        content.append(piece)
        self._put(content, level + size)

    def _put(self, content: list[Piece], level: int) -> None:
        if level == self.window:
            self.closed.append(content)
            self.n_open -= 1
        else:
            self.open[level].append(content)
            self.levels[level] += 1

    def _even_out(self) -> None:
        """Fill the fullest open windows with what the emptiest hold; at most
        one stays open."""
        held = [(at, c) for at in range(self.window, 0, -1) for c in self.open[at]]
        self._reset()
        first, last = 0, len(held) - 1
        while first < last:
            level, content = held[first]
            from_level, rest = held[last]
            piece = rest.pop()
            if len(piece.ids) > self.window - level:
                piece, left = piece.cut(self.window - level)
                rest.append(left)
            size = len(piece.ids)
            content.append(piece)
            held[first] = (level + size, content)
            held[last] = (from_level - size, rest)
            if level + size == self.window:
                self.closed.append(content)
                first += 1
            if not rest:
                last -= 1
        if first == last:
            self.n_open = 1
            level, content = held[first]
            self._put(content, level)

    def finish(self) -> None:
        self._even_out()
        left = [p for at in self.open for c in at for p in c]
        self._reset()
        total = sum(len(p.ids) for p in left)
        while total:
            size = 1 << (total.bit_length() - 1)
            total -= size
            sequence = []
            while size:
                piece = left.pop(0)
                if len(piece.ids) > size:
                    piece, rest = piece.cut(size)
                    left.insert(0, rest)
                size -= len(piece.ids)
                sequence.append(piece)
            self.closed.append(sequence)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _ranked(path: str):
    """The same vocabulary for tiktoken, which encodes a short text in a quarter
    of the time. It merges by id, so ids must be in order of rank; None if not."""
    spec = read_json(path)
    letters, vocabulary = byte_letters(), spec["model"]["vocab"]
    made = [vocabulary[a + b] for a, b in merge_pairs(spec)]
    if any(a >= b for a, b in zip(made, made[1:])):
        return None
    import tiktoken

    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
    return tiktoken.Encoding("ranked", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _sizes(path: str) -> np.ndarray:
    """How many bytes each id of ``_ranked`` stands for."""
    ranked = _ranked(path)
    out = np.zeros(ranked.n_vocab, np.int64)
    for token in ranked.token_byte_values():
        out[ranked.encode_single_token(token)] = len(token)
    return out


class Encoder:
    """Ids of texts as the tokenizers library gives them. Each block of text
    that is remembered is encoded once; texts with special strings go through
    the library whole."""

    def __init__(self, path: str, memo: int = MEMO):
        self.library, self.ranked = _tokenizer(path), _ranked(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.n_bytes = None if self.ranked is None else _sizes(path)
        self.memo = Memo(memo)

    def _by_library(self, texts: list[str]) -> list[bytes]:
        made = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in made]

    def _by_rank(self, blocks: list[str]) -> Iterator[bytes]:
        """Ids of each block. Blocks of a blank and a word stand in a text as they do
        one after the other, so all of them are encoded as one text and their ids are
        told apart by the bytes they cover."""
        ends = np.fromiter(accumulate((len(x.encode()) for x in blocks), initial=0), np.int64)
        ids = np.array(self.ranked.encode_ordinary("".join(blocks)), "<u4")
        covered = np.concatenate([[0], np.cumsum(self.n_bytes[ids])])
        at = np.searchsorted(covered, ends)
        if not np.array_equal(covered[at], ends):
            raise AssertionError("an id crosses two blocks")
        data = ids.tobytes()
        return (data[a:b] for a, b in pairwise((4 * at).tolist()))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        has_special = [any(s in t for s in self.special) for t in texts]
        parts = [blocks(t) if t and not x else [] for t, x in zip(texts, has_special)]
        fresh = self.memo.missing(chain.from_iterable(parts))
        if self.ranked is None:
            self.memo.add(fresh, self._by_library(fresh))
        else:
            words, others = [], []
            for block in fresh:
                (words if _WORD.match(block) else others).append(block)
            self.memo.add(words, self._by_rank(words))
            self.memo.add(others, (next(self._by_rank([x])) for x in others))
        known = self.memo.new.__getitem__
        out = [b"".join(map(known, part)) for part in parts]
        for i in np.flatnonzero(has_special):
            out[i] = self._by_library([texts[i]])[0]
        self.memo.turn()
        return out


def _pack(path: str, schema: pa.Schema, window: int):
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = Encoder(path), Packer(window)
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 33
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                some = batch.slice(at, _TEXTS)
                docs = some.column(0).to_pylist()
                texts = [t or "" for t in some.column(1).to_pylist()]
                for doc, data in zip(docs, encoder.encode(texts)):
                    packer.add(doc, np.frombuffer(data + closing, "<u4"))
                if sum(map(len, packer.closed)) >= _OUT_ROWS:
                    yield _rows(packer.closed, number, schema)
                    number += len(packer.closed)
                    packer.closed = []
        packer.finish()
        if packer.closed:
            yield _rows(packer.closed, number, schema)

    return run


def _rows(sequences: list[list[Piece]], number: int, schema: pa.Schema) -> pa.RecordBatch:
    rows = []
    for i, sequence in enumerate(sequences):
        offset = 0
        for p in sequence:
            digest = zlib.crc32(p.ids.tobytes())
            rows.append((p.doc, p.start, len(p.ids), digest, p.doc_tokens, number + i, offset))
            offset += len(p.ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema
    )


def pack(
    docs: DataFrame,
    path: str | None = None,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``."""
    kind = docs.schema[id_col].dataType
    out = T.StructType([T.StructField("doc_id", kind)])
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        out.add(name, T.LongType())
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in out.fields])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_pack(path or vocabulary_path(), arrow, window), out)
