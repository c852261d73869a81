"""The pipeline's stages on given and awkward tables."""

from itertools import combinations

import llm_brute as brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import pretokens, quality, queries
from llm_pieces import check_pieces

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, fp bigint"


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    """Input and output of each stage over the given documents."""
    docs, out = spark.read.parquet(f"{data}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, data).write.parquet(path)
        made = spark.read.parquet(path)
        out.append((docs, made))
        docs = made
    return out


def rows(frame):
    return [r.asDict() for r in frame.collect()]


def test_columns_stay_until_the_last_stage(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns
        assert after.exceptAll(before).count() == 0


def test_quality_drops_what_is_predicted_bad(spark, data, stages):
    before, after = stages[0]
    model = quality.fit(before, spark.read.parquet(f"{data}/labels.parquet"))
    docs = rows(before)
    scores = model.scores([r["text"] for r in docs])
    want = {r["doc_id"] for r, s in zip(docs, scores) if s >= quality.CUT}
    assert {r["doc_id"] for r in rows(after)} == want


def test_near_dedup_decides_by_jaccard(stages):
    before, after = stages[1]
    sets = {}
    for r in sorted(rows(before), key=lambda r: r["doc_id"]):
        words = (r["text"] or "").lower().split()
        sets[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    forest = brute.Forest(sets)
    for a, b in combinations(sets, 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            forest.link(a, b)
    assert {r["doc_id"] for r in rows(after)} == {i for i in sets if forest.root(i) == i}


def test_secrets_stage_drops_live_credentials_only(stages):
    before, after = stages[2]
    gone = {r["doc_id"] for r in rows(before)} - {r["doc_id"] for r in rows(after)}
    with_spans = {r["doc_id"] for r in rows(before) if brute.base_spans(r["text"])}
    assert gone <= with_spans


def test_mixing_keeps_the_budget(stages):
    before, after = stages[3]

    def words(frame):
        return frame.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]

    assert after.groupBy("doc_id").count().where("count > 1").count() == 0
    assert words(after) >= int(corpus_pipeline.SHARE * words(before))


def test_packing_covers_every_document(stages):
    before, after = stages[4]
    texts = {r["doc_id"]: r["text"] for r in rows(before)}
    assert check_pieces(after.collect(), texts) == 0


def test_stages_take_awkward_rows(spark, data, tmp_path):
    good = spark.read.parquet(f"{data}/documents.parquet").orderBy(F.length("text").desc()).first().text
    odd = [
        (None, good, None, None, None, "x", 1), (None, good, None, None, None, "x", 1),
        (1, None, "en", "src1", 0, None, None), (2, "", "en", "src1", 0, "x", 1),
        (3, good + " " + good, "en", "src1", 9, "x", 1), (3, good + " " + good, "en", "src1", 9, "x", 1),
        (4, good * 3, "de", "other", 9, "x", 1),
    ]
    for name, lines in (("odd", odd), ("empty", [])):
        docs = spark.createDataFrame(lines, DOCS)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        for step, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, data)
            out.write.parquet(str(tmp_path / f"{name}-{step}"))
            made = spark.read.parquet(str(tmp_path / f"{name}-{step}"))
            if step != "packing":
                assert made.columns == docs.columns
            if step == "near_dedup":
                copies = made.groupBy("doc_id").count().where("count > 1").count()
                assert copies == 0
                docs = made


@pytest.mark.parametrize("dealt", [False, True])
def test_stages_take_columns_named_like_helpers(spark, data, tmp_path, stages, dealt):
    """Row names never meet the user's columns; rows not from files are staged."""
    names = ["_row_file", "_row_place", "_salt", "_SALT_", "row", "node", "bucket", "turn", "kind"]
    docs = stages[0][1].withColumns({n: F.lit(7) for n in names})
    if dealt:
        text = str(tmp_path / "json")
        docs.write.json(text)
        docs = spark.read.schema(docs.schema).json(text).repartition(3)
    for (step, stage), (_, plain) in list(zip(corpus_pipeline.STAGES, stages))[1:]:
        out = stage(spark, docs, data)
        out.write.parquet(str(tmp_path / step))
        made = spark.read.parquet(str(tmp_path / step))
        if step == "packing":
            assert made.count() > 0
            continue
        assert made.columns == docs.columns
        assert made.where("_row_file = 7 and _salt = 7").count() == plain.count()
        assert {r[0] for r in made.select("doc_id").collect()} == {
            r[0] for r in plain.select("doc_id").collect()
        }
        docs = made


def test_all_queries_are_registered():
    import __spark_entry__

    known = __spark_entry__.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(known)
    assert len([q for q in known if q.startswith("op") and q[2].isdigit()]) == 13
    assert pretokens.vocabulary_path().endswith("byte_bpe_50k.json")


def test_the_driver_gives_back_what_rounds_and_stages_left(spark, monkeypatch):
    from corpusloom.llm import components as stars

    calls = []
    monkeypatch.setattr(stars, "release", calls.append)
    chain = spark.createDataFrame([(i, i + 1) for i in range(6)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in stars.components(chain).collect()}
    assert found == {i: 0 for i in range(7)} and len(calls) > 1
    monkeypatch.setattr(corpus_pipeline, "release", calls.append)
    docs = spark.createDataFrame([(1, "a b", "s", "en")], "doc_id bigint, text string, source string, lang string")
    before = len(calls)
    corpus_pipeline.packing_stage(spark, docs, "")
    assert len(calls) == before + 1
