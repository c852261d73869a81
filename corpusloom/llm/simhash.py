"""Near-duplicate texts by SimHash fingerprints and pigeonhole blocks.

A text's fingerprint has one bit per position: set where over half of the
hashes of its word shingles have it set. Fingerprints are split into blocks of
bits. Two that differ in at most ``distance`` bits agree in at least one of
``distance + 1`` blocks, so joining on each block and verifying the Hamming
distance finds every such pair. Linked fingerprints form components.

For a Jaccard similarity J of the shingle sets about a share ``acos(2 J / (1 +
J)) / pi`` of the bits differs, 15 % at J = 0.8. To find such pairs, fingerprints
may be wider than 64 bits (further words are mixed from the same hash) and have
fewer blocks than ``distance + 1``; what share of pairs then meets in a block is
in ``found_share``, what share is also within the distance in ``kept_share``. Block bits should grow with the
logarithm of the number of texts.

With a ``similarity`` the bits only choose candidates. Repeated shingles count
once, and texts of one shingle set are one class. A pair links exactly if its
Jaccard similarity is that or more. Candidates form groups, and what is wanted is
which of them links join: so each candidate is first compared with the smallest one
that it meets in a block, which joins a group of near copies of any size in as many
comparisons as it has members. Only in groups that are not one component then,
pairs of different components are compared, in cells bounded in rows and bytes.

Texts with one fingerprint (or shingle set) are one class, so a group of copies
of any size is one row in the join. A crowded block value is compared in cells of bounded
size (``cells``).

Defined cases: a null text counts as empty; a text without words has
fingerprint zero and links like any other; a null ``doc_id`` is never a
component's id unless all of the component's are null; rows that repeat a
``doc_id`` are rows of their own. Columns other than the two named are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.cells import compare, crowd
from corpusloom.llm.components import components
from corpusloom.llm.rows import ROW, lasting, salted_join, salted_lookup, with_row
from corpusloom.session import stage_table

SEED = 42
# Shingles whose bits are counted at a time: 64 bytes each.
_COUNT = 65536
# Shingles of a cell held as bits at a time, and elements looked up at a time.
_COLUMNS = 4096
_LOOKUPS = 1 << 17
# Rows with shingle sets that a cell's side holds at most.
_SET_BLOCK = 128


@dataclass(frozen=True)
class Scheme:
    """How texts are compared: shingles of ``words`` words, fingerprints of 64
    times ``size`` bits, links at ``distance`` differing bits or fewer, found
    through ``blocks`` blocks of ``block_bits`` bits (0: as even as can be).
    With a ``similarity`` such links are candidates, decided by the Jaccard
    similarity of the shingle sets."""

    words: int = 3
    size: int = 1
    distance: int = 2
    blocks: int = 3
    block_bits: int = 0
    similarity: float | None = None

    def edges(self) -> list[tuple[int, int]]:
        """First bit and end of each block."""
        if self.block_bits:
            return [(i * self.block_bits, (i + 1) * self.block_bits) for i in range(self.blocks)]
        cuts = [64 * self.size * i // self.blocks for i in range(self.blocks + 1)]
        return list(zip(cuts, cuts[1:]))

    def found_share(self, differing: float) -> float:
        """Share of pairs that meet in a block when a share ``differing`` of
        their bits differs, each bit on its own."""
        missed = 1.0
        for first, end in self.edges():
            missed *= 1 - (1 - differing) ** (end - first)
        return 1 - missed

    def kept_share(self, differing: float) -> float:
        """Share of pairs within ``distance`` under the same assumption."""
        n = 64 * self.size
        return sum(
            math.comb(n, d) * differing**d * (1 - differing) ** (n - d)
            for d in range(self.distance + 1)
        )


# Differing in 2 of 64 bits: three blocks find every such pair.
CLOSE = Scheme()
# Five words, similarity 0.8 or more: 58 of 384 bits differ on average at 0.8,
# with a deviation of 7, and 72 with one of 8 for four shingles of five, the
# smallest sets that can link. The distance is the latter plus four deviations.
# Of pairs at 0.8 99.97 % meet in a block, of the smallest sets 99.4 %.
SIMILAR = Scheme(words=5, size=6, distance=104, blocks=38, block_bits=10, similarity=0.8)


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further 64 bits per hash (the finaliser of SplitMix64); word 0 is the hash."""
    if not word:
        return hashes
    x = hashes + np.uint64(word * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, scheme: Scheme = CLOSE) -> np.ndarray:
    """Hashes of the word shingles in their order; under a scheme
    with a similarity each once and sorted."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    whole = b" ".join(words)
    digest, each = xxhash.xxh64_intdigest, scheme.words
    if len(words) <= each:
        return np.array([digest(whole, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = len(words) - each + 1
    pieces = map(slice, starts[:n].tolist(), ends[each - 1 :].tolist())
    hashes = np.fromiter((digest(whole[piece], SEED) for piece in pieces), np.uint64, n)
    return hashes if scheme.similarity is None else np.unique(hashes)


def fingerprint(text: str | None, scheme: Scheme = CLOSE) -> bytes:
    """The fingerprint of one text, as big-endian 64-bit words."""
    return _bits(shingles(text, scheme), scheme)


def _bits(hashes: np.ndarray, scheme: Scheme) -> bytes:
    counts = np.zeros((scheme.size, 64), np.int64)
    for at in range(0, len(hashes), _COUNT):
        for word in range(scheme.size):
            part = _mixed(hashes[at : at + _COUNT], word).astype(">u8").view(np.uint8)
            bits = np.unpackbits(part.reshape(-1, 8), axis=1)
            counts[word] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), axis=1).tobytes()


def _of_texts(scheme: Scheme, value):
    @F.pandas_udf("binary")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([value(shingles(t, scheme), scheme) for t in texts], dtype=object)

    return run


def _class(hashes: np.ndarray, scheme: Scheme) -> bytes:
    """What texts of one class have in common: the fingerprint and, where the
    shingle set decides, its digest."""
    bits = _bits(hashes, scheme)
    if scheme.similarity is None:
        return bits
    return bits + xxhash.xxh3_128_digest(hashes.tobytes())


def _packed(hashes: np.ndarray, scheme: Scheme) -> bytes:
    return hashes.tobytes()


def _keys(scheme: Scheme):
    edges = scheme.edges()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            data = np.frombuffer(b"".join(batch["fp"]), np.uint8).reshape(len(batch), -1)
            bits = np.unpackbits(data, axis=1).astype(np.int64)
            keys = np.stack(
                [bits[:, a:b] @ (1 << np.arange(b - a, dtype=np.int64)) for a, b in edges], axis=1
            )
            yield batch.assign(keys=list(keys))

    return run


def _near(scheme: Scheme):
    def load(held: pd.DataFrame):
        prints = np.frombuffer(b"".join(held["fp"]), np.uint64).reshape(len(held), -1)

        def near(a, b, outer=False):
            shape = (len(a), len(b)) if outer else len(a)
            differing = np.zeros(shape, np.int16)
            for word in range(scheme.size):
                left = prints[a, word]
                left = left[:, None] if outer else left
                differing += np.bitwise_count(left ^ prints[b, word])
            return differing <= scheme.distance

        return near

    return load


def _similar(scheme: Scheme):
    """Jaccard similarity of the shingle sets of a cell's rows of unlike labels."""

    def load(held: pd.DataFrame):
        label = held["label"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in held["shingles"]]
        sizes = np.array([len(x) for x in sets], np.int64)
        first = np.cumsum(sizes) - sizes
        values, ids = np.unique(np.concatenate(sets), return_inverse=True)
        n_values = max(1, len(values))
        # Sorted, as rows ascend and each row's numbers do.
        keys = np.repeat(np.arange(len(sets)), sizes) * n_values + ids

        def elements(rows):
            """The numbers of some rows' shingles, and the place of the row."""
            n = sizes[rows]
            place = np.repeat(np.arange(len(rows)), n)
            within = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
            return ids[first[rows][place] + within], place

        def common(a, b):
            out = np.zeros(len(a), np.int64)
            part = np.cumsum(sizes[a]) // _LOOKUPS
            for k in np.unique(part):
                pairs = np.flatnonzero(part == k)
                number, place = elements(a[pairs])
                want = b[pairs][place] * n_values + number
                at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                out[pairs] = np.bincount(place[keys[at] == want], minlength=len(pairs))
            return out

        def common_all(a, b):
            out = np.zeros((len(a), len(b)), np.int64)
            number, times = np.unique(elements(np.union1d(a, b))[0], return_counts=True)
            shared = number[times > 1]
            sides = [(len(rows), *elements(rows)) for rows in (a, b)]
            for at in range(0, len(shared), _COLUMNS):
                part = shared[at : at + _COLUMNS]
                left, right = (_has(n, *side, part) for n, *side in sides)
                for i in range(len(a)):
                    out[i] += np.bitwise_count(left[i] & right).sum(axis=1, dtype=np.int64)
            return out

        def near(a, b, outer=False):
            if outer:
                both, total = common_all(a, b), sizes[a][:, None] + sizes[b]
            else:
                both, total = np.zeros(len(a), np.int64), sizes[a] + sizes[b]
                least, most = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
                open_ = least >= scheme.similarity * most * (1 - 1e-9)
                both[open_] = common(a[open_], b[open_])
            hit = both / np.maximum(total - both, 1) >= scheme.similarity
            # What is one component already gains nothing.
            return hit & (label[a][:, None] != label[b] if outer else label[a] != label[b])

        return near

    return load


def _has(n: int, number: np.ndarray, place: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """A bit per row and column: set where the row has the column's number."""
    at = np.minimum(np.searchsorted(columns, number), len(columns) - 1)
    found = columns[at] == number
    out = np.zeros((n, _COLUMNS), bool)
    out[place[found], at[found]] = True
    return np.packbits(out, axis=1).view(np.uint64)


def _links(scheme: Scheme):
    """Whether two shingle sets reach the similarity."""

    @F.pandas_udf("boolean")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in parts:
            out = np.zeros(len(left), bool)
            for i, (a, b) in enumerate(zip(left, right)):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                if min(len(x), len(y)) >= scheme.similarity * max(len(x), len(y)) * (1 - 1e-9):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    out[i] = both / max(len(x) + len(y) - both, 1) >= scheme.similarity
            yield pd.Series(out)

    return run


def _verified(
    texts: DataFrame, classes: DataFrame, found: DataFrame, groups: DataFrame, scheme: Scheme
) -> DataFrame:
    """``node, root`` for the classes that link by their shingle sets.

    ``found`` holds candidate links (``node, root``, each towards the smallest node
    that it meets in a block), ``groups`` what they join. Each class is read once, by
    the row it names.
    """
    named = classes.join(groups, "node").select("node", F.col("root").alias("key"), "at.*")
    sets = texts.join(named.hint("shuffle_hash"), ROW).select(
        "key", "node", _of_texts(scheme, _packed)("text").alias("shingles")
    )
    sets = stage_table(sets, "shingle-sets")
    stars = found.where("node <> root").select("node", "root").distinct()
    left = stars.join(sets.select("node", F.col("shingles").alias("own")), "node")
    right = sets.select(F.col("node").alias("root"), F.col("shingles").alias("other"))
    # The smallest of a large group is the root of many.
    met = salted_lookup(left, right, ["root"], "node")
    links = met.where(_links(scheme)("own", "other")).select("node", "root")
    links = stage_table(links, "similar-stars")
    joined = stage_table(components(links, "node", "root"), "similar-joined")
    label = F.coalesce("root", "node").alias("label")
    sized = sets.select("key", "node", F.octet_length("shingles").alias("bytes"))
    labels = sized.join(joined, "node", "left").select("key", "node", "bytes", label)
    labels = stage_table(labels, "similar-labels")
    split = labels.groupBy("key").agg(
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        crowd(F.col("bytes"), _SET_BLOCK).alias("n"),
    )
    # A group may be large, so its rows find out by key and node.
    open_ = salted_lookup(labels, split.where("low <> high").select("key", "n"), ["key"], "node")
    open_ = open_.where("n is not null").select("node", "label", "n")
    rows = sets.join(open_, "node").select(
        F.lit(0).alias("bucket"),
        "key",
        "node",
        F.lit(1).cast("bigint").alias("weight"),
        "n",
        "label",
        "shingles",
    )
    more = compare(stage_table(rows, "unlike-sets"), _similar(scheme), _SET_BLOCK)
    return components(links.unionByName(more.select("node", "root")), "node", "root")


def fingerprint_links(prints: DataFrame, scheme: Scheme = CLOSE) -> DataFrame:
    """``node, links, root`` per block in which a fingerprint (``node`` long, ``fp``
    binary) is within the distance of another one; ``root`` is the smallest node
    that it reaches there."""
    schema = "node bigint, fp binary, keys array<bigint>"
    keyed = prints.select("node", "fp").mapInPandas(_keys(scheme), schema)
    rows = keyed.select(
        "node",
        "fp",
        F.posexplode("keys").alias("bucket", "key"),
        F.lit(1).cast("bigint").alias("weight"),
    )
    return compare(rows, _near(scheme))


def fingerprint_components(prints: DataFrame, scheme: Scheme = CLOSE) -> DataFrame:
    """``node, root`` for the fingerprints that are within the distance of another
    one; ``root`` is the smallest node reachable."""
    return components(fingerprint_links(prints, scheme), "node", "root")


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    scheme: Scheme = CLOSE,
) -> DataFrame:
    """``doc_id, fp (binary), root, component_id`` and the ``ROW`` columns per row.

    ``component_id`` is the smallest id among the texts reachable by links,
    ``root`` a number that names the component.
    """
    if scheme.similarity is not None:
        docs = lasting(docs)  # read again for the shingle sets
    kind = _of_texts(scheme, _class)(F.col(text_col))
    rows = with_row(docs, F.col(id_col).alias("doc_id"), kind.alias("kind"))
    rows = stage_table(rows, "fingerprints")
    classes = rows.groupBy("kind").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct(*ROW)).alias("at")
    )
    fp = F.substring("kind", 1, 8 * scheme.size)
    # Written with the number, so it does not change under a recomputation.
    classes = classes.withColumns({"fp": fp, "node": F.monotonically_increasing_id()})
    classes = stage_table(classes, "print-classes")
    if scheme.similarity is None:
        linked = fingerprint_components(classes, scheme)
    else:
        found = fingerprint_links(classes, scheme)
        found = stage_table(found.select("node", "root").distinct(), "candidate-links")
        groups = components(found, "node", "root")
        texts = with_row(docs, F.col(text_col).alias("text"))
        linked = _verified(texts, classes, found, groups, scheme)
    member = classes.join(linked, "node", "left").select(
        "kind", "first_id", F.coalesce("root", "node").alias("root")
    )
    heads = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    fate = salted_join(member.select("kind", "root"), heads, ["root"], "kind")
    return salted_lookup(rows, fate, ["kind"], ROW[1]).select(
        *ROW, "doc_id", fp.alias("fp"), "root", "component_id"
    )


def repeats(found: DataFrame) -> DataFrame:
    """``ROW`` of every row but one per component; the one has the smallest id."""
    found = stage_table(found.select(*ROW, "doc_id", "root", "component_id"), "print-fates")
    is_head = F.col("doc_id").eqNullSafe(F.col("component_id"))
    heads = stage_table(found.where(is_head).dropDuplicates(["root"]).select(*ROW), "print-heads")
    return found.select(*ROW).join(heads, ROW, "left_anti")
