"""Ranked search against plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import lexical

DOCS = "doc_id bigint, text string, n int, terms string, wave int, query int"
ITEMS = "item_id bigint, text string, doc_id int, rank int"


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def by_hand(docs, items, k):
    """Sorted ``(item_id, rank, doc_id, score)``."""
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, count, n in held:
            m = 100 - 50 + 50 * n * n_docs // n_terms
            score = 0
            for t in set(terms(text)) & count.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1000000000 * count[t] // (1000 * count[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        for r, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k]):
            out.append((item, r + 1, doc, -s))
    return sorted(out, key=str)


def frames(spark, docs, items):
    a = spark.createDataFrame([(i, t, 1, "x", 1, 1) for i, t in docs], DOCS)
    return a, spark.createDataFrame([(i, t, 1, 1) for i, t in items], ITEMS)


def tuples(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def corpus(seed=1, n=400):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)]
    odds = 1 / np.arange(1, 301)
    odds /= odds.sum()
    docs = []
    for i in range(n):
        some = rng.choice(words, int(rng.integers(1, 120)), p=odds)
        docs.append((i, " ".join(w.upper() if rng.random() < 0.2 else w for w in some)))
    docs += [(1000 + i, docs[7][1]) for i in range(90)]  # many copies, many ties
    items = [(i, " ".join(rng.choice(words, int(rng.integers(1, 15))))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("first_wave,k,block", [(8192, 50, 1024), (16, 5, 1024), (1, 3, 4)])
def test_ranking_is_exact(spark, monkeypatch, first_wave, k, block):
    monkeypatch.setattr(lexical, "_BUCKET", 32)
    docs, items = corpus()
    a, b = frames(spark, docs, items)
    got = lexical.rank(a, b, k=k, first_wave=first_wave, most_items=block)
    assert tuples(got) == by_hand(docs, items, k)


def test_odd_rows(spark):
    docs = [
        (1, None), (2, ""), (3, " .,;\n"), (4, "Été été ÉTÉ x1"), (None, "alpha beta"), (5, "alpha beta"),
        (6, "alpha beta"), (6, "alpha beta"), (7, "alpha " * 50000), (8, "K k K a-b_c"), (9, "beta 𝒳"),
        (10, "the quick"), (11, "a b c"), (12, "d e f"),
    ]
    items = [
        (1, "Alpha, BETA!"), (1, "Alpha, BETA!"), (2, None), (3, ""), (4, "unknown"), (5, "été ÉTÉ"),
        (None, "k b"), (6, "𝒳 alpha alpha alpha"), (7, "?!"),
    ]
    a, b = frames(spark, docs, items)
    assert tuples(lexical.rank(a, b)) == by_hand(docs, items, 50)
    assert lexical.rank(a.limit(0), b).count() == 0
    assert lexical.rank(a, b.limit(0)).count() == 0
    assert lexical.rank(a.where("doc_id < 4"), b).count() == 0


def test_terms():
    for text in ("", "A_b c9Z", "x\x00y\x7fz", "ÀÉ q", "a b", "{|}~[\\]^`@:/"):
        assert [t.decode() for t in lexical.terms_of(text.encode())] == terms(text)


def test_waves_cover_all_levels():
    levels = [(10, 3), (9, 5), (8, 40), (5, 1), (1, 2)]
    assert lexical._waves(levels, 4) == [9, 8, 1]
    assert lexical._waves(levels, 100) == [1]
    assert lexical._waves([], 4) == []


def test_short_buckets_and_light_terms_are_left_out():
    item = lexical._Item([0, 1, 2], [10, 3000, 400])
    assert item.terms.tolist() == [1, 2, 0]
    assert item.focus(1.0, 0) == 3  # no floor: every term
    assert item.focus(1.0, 5000) == 0  # nothing here can reach it
    assert item.focus(2.0, 900) == 1  # the lighter two reach 800 only
    bucket = lexical._Bucket(
        np.array([7, 8, 9]), np.array([2.0, 2.0, 2.0]), np.array([1, 1, 2]),
        np.array([0, 2, 1, 2]), np.array([2, 2, 1, 1]),
    )
    ids, scores = bucket.search(item, 900)
    assert (ids.tolist(), scores.tolist()) == ([9], [3400])
    ids, scores = bucket.search(item, 0)
    assert dict(zip(ids.tolist(), scores.tolist())) == {7: 20, 8: 800, 9: 3400}


def test_waves_that_cannot_reach_the_best_are_never_read(spark):
    """The second wave's folder does not exist: reading it would fail."""
    docs, items = [(i, "rare " * 40) for i in range(60)] + [(90, "common")], [(1, "rare common")]
    a, _ = frames(spark, docs, items)
    vocabulary = {b"common": 0, b"rare": 1}
    counted = lexical.count_terms(a, vocabulary, "doc_id", "text")
    n_docs, n_terms = counted.selectExpr("count(*)", "sum(n)").first()
    path, longest = lexical.build_index(lexical._impacts(counted, n_docs, n_terms), 8)
    wanted = {1: lexical._Item([1], [5000])}
    best = lexical.search_index(spark, path, [longest[0], 1e-3], wanted, 50)
    assert best.count() == 50
