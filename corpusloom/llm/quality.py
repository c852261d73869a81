"""Quality scores from two zstandard dictionaries.

One dictionary is built from good and one from bad labelled texts. A text is
compressed with both, piece by piece; what the bad one needs more than the good
one, per byte, is high for texts like the good ones. A logistic curve fitted on
other labelled texts turns that difference into a probability.

The model is fitted on a bounded sample: at most ``SAMPLE_ROWS`` labelled
documents per label and use, chosen by a hash of the id, and at most
``SAMPLE_PIECES`` pieces of ``PIECE`` bytes of them per label; that is what the
driver holds. Every document is scored, over its whole text.

Defined cases: a null or empty text has difference zero; labels other than 0
and 1 and rows with a null label or id are not learned from; without any
labelled text of one of the labels every score is the share of good labels, 0.5
without labels. A document that carries both labels is learned as both. Rows
that repeat an id are scored each. Only the named columns are read. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 4096
DICTIONARY = 112_640
LEVEL = 3
SAMPLE_ROWS = 1200
SAMPLE_PIECES = 3000
# Bytes added to a text's length, so that very short ones stay near zero.
SMOOTH = 100
SEED = 5
CUT = 0.3


@dataclass(frozen=True)
class Model:
    """Two dictionaries (empty where there was nothing to learn) and the curve
    ``1 / (1 + exp(-(slope * difference + shift)))``."""

    good: bytes
    bad: bytes
    slope: float
    shift: float

    def differences(self, texts) -> np.ndarray:
        if not (self.good and self.bad):
            return np.zeros(len(texts))
        good, bad = _compressor(self.good), _compressor(self.bad)
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            data = (text or "").encode("utf-8", "replace")
            gain = 0
            for at in range(0, len(data), PIECE):
                piece = data[at : at + PIECE]
                gain += len(bad.compress(piece)) - len(good.compress(piece))
            out[i] = gain / (len(data) + SMOOTH)
        return out

    def scores(self, texts) -> np.ndarray:
        return _curve(self.slope * self.differences(texts) + self.shift)


def _curve(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    words = zstandard.ZstdCompressionDict(content)
    words.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False
    )


def pieces(text: str) -> list[bytes]:
    data = text.encode("utf-8", "replace")
    return [data[at : at + PIECE] for at in range(0, len(data), PIECE)]


def train_dictionary(texts: list[str], foreign: set[str]) -> bytes:
    """A dictionary of ``texts`` without the lines in ``foreign``: what both
    labels share says nothing about either."""
    kept = ["\n".join(x for x in t.split("\n") if x not in foreign) for t in texts]
    samples = [piece for t in kept for piece in pieces(t)]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        # Too little text to choose from: all of it is the dictionary.
        return b"\n".join(samples)[-DICTIONARY:]


def fit_curve(x: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps on scaled input."""
    if not len(x):
        return 0.0, 0.0
    share = np.clip(good.mean(), 1e-6, 1 - 1e-6)
    scale = x.std()
    if good.min() == good.max() or scale == 0:
        return 0.0, float(np.log(share / (1 - share)))
    rows = np.c_[x / scale, np.ones(len(x))]
    weights = np.zeros(2)
    ridge = np.diag([1e-2, 1e-6])
    for _ in range(60):
        p = _curve(rows @ weights)
        slope = rows.T @ (good - p) - ridge @ weights
        step = np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + ridge, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0] / scale), float(weights[1])


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept out of learning: its id's CRC-32 modulo 5 is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(
    docs: DataFrame,
    labels: DataFrame,
    use: int,
    rows: int,
    id_col: str,
    text_col: str,
    label_col: str,
) -> DataFrame:
    """``text, label`` of at most ``rows`` labelled documents per label. The
    two uses (dictionaries 0, curve 1) never share a document."""
    turn = F.xxhash64(F.col(id_col), F.lit(SEED))
    usable = labels.select(id_col, F.col(label_col).alias("label")).where(
        F.col(id_col).isNotNull() & F.col("label").isin(0, 1) & ~held_out(id_col)
    )
    usable = usable.where(F.pmod(F.shiftright(turn, 32), F.lit(2)) == use).distinct()
    chosen = [usable.where(F.col("label") == k).orderBy(turn, id_col).limit(rows) for k in (0, 1)]
    # Never more than twice ``rows`` narrow rows.
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))
    return docs.select(id_col, text_col).join(picked, id_col).select(
        F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"), "label"
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = SAMPLE_ROWS,
    most_pieces: int = SAMPLE_PIECES,
) -> Model:
    """The model; see the module for what it is fitted on."""
    args = (rows, id_col, text_col, label_col)
    # Cut in Spark, so that one very long text cannot fill the driver.
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int")),
        lambda k: F.substring("text", k * PIECE + 1, F.lit(PIECE)),
    )
    some = sample(docs, labels, 0, *args).where(F.length("text") > 0)
    parts = some.select("label", "id", F.posexplode(cut))
    texts: dict[int, list[str]] = {}
    for label in (0, 1):
        turn = [F.xxhash64("id", "pos"), "id", "pos", "col"]
        chosen = parts.where(F.col("label") == label).orderBy(*turn).limit(most_pieces)
        texts[label] = [r["col"] for r in chosen.collect()]
    lines = [{x for t in texts[k] for x in t.split("\n")} for k in (0, 1)]
    shared = lines[0] & lines[1]
    good, bad = (train_dictionary(texts[k], shared) for k in (1, 0))
    model = Model(good, bad, 0.0, 0.0)
    found = sample(docs, labels, 1, *args).select(_difference(model)("text").alias("x"), "label")
    known = found.toPandas()
    slope, shift = fit_curve(known["x"].to_numpy(float), known["label"].to_numpy(float))
    return Model(good, bad, slope, shift)


def _difference(model: Model):
    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(model.differences(texts.to_numpy()))

    return run


def score(model: Model, text_col: str = "text") -> Column:
    """A document's score, 0 to 1; higher means that label 1 is likelier."""

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(model.scores(texts.to_numpy()))

    return run(F.col(text_col))


def classify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``."""
    scored = docs.select(F.col(id_col).alias("doc_id"), score(model, text_col).alias("score"))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )
