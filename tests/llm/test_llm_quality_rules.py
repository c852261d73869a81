"""The compiled threshold table against plain Python."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import queries, quality_rules
from corpusloom.llm.quality_rules import Rule

DOCS = "doc_id bigint, text string, n_words string, words int, chars int, failed int"


def base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by hand."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def frame_of(spark, texts):
    rows = [(i, t, "x", 1, 1, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def check(got, texts):
    for r in got:
        want = base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept == (not r.base_failed and r.failed == "")


def test_given_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    got = queries.op12_quality_rules(spark, data).collect()
    assert len(got) == len(docs)
    check(got, {r.doc_id: r.text for r in docs})
    good = spark.read.parquet(f"{data}/labels.parquet").where("quality = 1")
    good = {r.doc_id for r in good.collect()}
    mine = [r for r in got if r.doc_id in good and not r.base_failed]
    assert sum(r.kept for r in mine) >= 0.98 * len(mine)


ODD = [
    None, "", " \n\t", "one", "a b c d e a b c d e", "a a a a a a", "a b c d e", "a a a a a",
    "a b c d e f a b c d e g b c d e f a h", "x\r\nx\r\n\n \n x\nx", "é ü   x\x0by\x0cz\x1cq",
    "# * $ % & | < >", "𝒳𝒴 𝒵 word", "...\n…\n - a\n* b\n• c ... \n",
    "the of and to a in is that it for was on with as by be",
]


def test_odd_texts(spark):
    texts = [*ODD, *ODD, "word " * 30000, " ".join(f"w{i % 997}" for i in range(20000)), "z" * 200000]
    got = quality_rules.judge(frame_of(spark, texts)).collect()
    assert len(got) == len(texts)
    check(got, texts)
    assert quality_rules.judge(frame_of(spark, [])).count() == 0


def test_other_columns_may_be_missing_or_clash(spark):
    docs = frame_of(spark, ["x y"]).select(F.col("doc_id").alias("id"), F.col("text").alias("t"))
    got = quality_rules.judge(docs, id_col="id", text_col="t").first()
    assert (got.doc_id, got.n_words, got.base_failed, got.kept) == (0, 2, True, False)


@pytest.mark.parametrize(
    "rule,text,broken",
    [
        (Rule("r", "n_symbols", "n_words", most=10), "# " + "a " * 9, False),
        (Rule("r", "n_symbols", "n_words", most=10), "## " + "a " * 9, True),
        (Rule("r", "n_stop_words", "n_words", least=20), "The dog x y z", False),
        (Rule("r", "n_stop_words", "n_words", least=20), "dog x y z z z", True),
        (Rule("r", "n_stop_words", "n_words", least=20, from_words=7), "dog x y z z z", False),
        (Rule("r", "n_dup_lines", "n_lines", most=30), "", False),
        (Rule("r", "n_bullet_lines", "n_lines", most=50), "- a\n b", False),
        (Rule("r", "n_bullet_lines", "n_lines", most=49), "- a\n b", True),
        (Rule("r", "n_ellipsis_lines", "n_lines", most=49), "a...\nb", True),
        (Rule("r", "n_letter_words", "n_words", least=60), "1 2 x", True),
    ],
)
def test_rules_of_the_table(spark, rule, text, broken):
    got = quality_rules.judge(frame_of(spark, [text]), table=[rule]).first()
    assert (got.failed == "r") == broken


def test_judging_adds_no_shuffle_and_no_function(spark, data):
    plan = queries.op12_quality_rules(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
