import hashlib
import tracemalloc
from dataclasses import dataclass

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import vectors
from corpusloom.operators import embed, search
from conftest import pairs, values


def test_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    row = df.select(
        vectors.norm(F.col("a")).alias("n"),
        vectors.l2_normalize(F.col("a")).alias("u"),
        vectors.l2_normalize(F.col("z")).alias("zero"),
        vectors.squared_l2(F.col("a"), F.col("z")).alias("d"),
        vectors.sanitize(F.col("a"), 3).alias("bad"),
        vectors.sanitize(F.lit(None).cast("array<float>"), 2).alias("none"),
        vectors.has_dim(F.lit(None).cast("array<float>"), 2).alias("has"),
    ).first()
    assert (row.n, row.u, row.zero, row.d) == (5.0, [0.6, 0.8], [0.0, 0.0], 25.0)
    assert (row.bad, row.none, row.has) == ([0.0] * 3, [0.0] * 2, False)


def _by_hand(text, dim):
    v = np.zeros(dim)
    for w in text.split():
        h = hashlib.md5(w.encode()).hexdigest()
        v[int(h[:8], 16) % dim] += 1 if int(h[8], 16) < 8 else -1
    n = np.linalg.norm(v)
    return v / n if n else v


def test_embedding(spark):
    texts = ["one two two", "", None, "drei " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = pairs(embed.embed_batches(df, embed.HashingModel(16), "t", batch_size=1).select("i", "embedding"))
    assert got[2] is None
    for i in (0, 1, 3):
        assert np.allclose(got[i], _by_hand(texts[i], 16), atol=1e-6)


def test_embedding_rows_gives_the_same(spark):
    df = spark.createDataFrame([(0, "a b"), (1, None), (2, "")], "i int, t string")
    model = embed.HashingModel(8)
    one = pairs(embed.embed_on(df, model, "t", "v", None, 2).select("i", "v"))
    assert one == pairs(embed.embed_batches(df, model, "t", "v").select("i", "v"))


def test_frames_are_pooled(spark):
    df = spark.createDataFrame([(0, ["a", "b"]), (1, []), (2, None)], "i int, f array<string>")
    got = pairs(df.select("i", embed.embed_frames(F.col("f"), embed.HashingModel(8))))
    assert np.allclose(got[0], (_by_hand("a", 8) + _by_hand("b", 8)) / 2)
    assert got[1] is None and got[2] is None


def test_a_vocabulary_does_not_fill_the_worker():
    """Every word is new; the places of a part of them are held."""
    encode = embed.HashingModel(8).load()
    tracemalloc.start()
    for start in range(0, 400_000, 1000):
        words = " ".join(f"w{i}" for i in range(start, start + 1000))
        last = encode([words])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 20e6, held
    assert np.allclose(last[0], _by_hand(words, 8))


@dataclass(frozen=True)
class _Tall:
    """Encodes at most ``most`` texts at once; the vector is their length."""

    dim: int = 2
    most: int = 3

    def load(self):
        def encode(texts):
            assert 0 < len(texts) <= self.most
            return np.array([[len(t), 1.0] for t in texts])

        return encode


def test_frames_of_many_rows_share_model_batches(spark):
    """A list longer than a model batch, short and empty ones, nulls between."""
    lists = [["x" * i] * (i % 5) if i % 4 else None for i in range(40)] + [["a", "bbb"] * 50]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, f array<string>").coalesce(1)
    got = pairs(df.select("i", embed.embed_frames(F.col("f"), _Tall(), 3)))
    want = {i: [float(np.mean([len(x) for x in f])), 1.0] if f else None for i, f in enumerate(lists)}
    assert got == want


def test_mean_pool_and_projection(spark):
    rng = np.random.default_rng(0)
    m = rng.normal(size=(40, 5)).astype(np.float32)
    df = spark.createDataFrame([(i % 3, m[i].tolist()) for i in range(40)], "g int, v array<float>")
    got = {r.g: r for r in embed.mean_pool(df.repartition(4), "g", "v").collect()}
    for g in range(3):
        assert np.allclose(got[g].pooled, m[g::3].mean(axis=0), atol=1e-6)
        assert got[g].n_vectors == len(m[g::3])
    w = embed.projection_matrix(5, 2, 3)
    mapped = [r[0] for r in values(df.select(embed.project(F.col("v"), 5, 2, 3)))]
    assert np.allclose(mapped, m.astype(float) @ w)
    time = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0]],)], "f array<array<float>>")
    assert time.select(embed.mean_over_time(F.col("f"), 2)).first()[0] == [2.0, 3.0]


@dataclass(frozen=True)
class CountingModel:
    """Writes a line for every text it embeds."""

    path: str
    dim: int = 4

    def load(self):
        def encode(texts):
            with open(self.path, "a") as f:
                f.write("x\n" * len(texts))
            return np.ones((len(texts), self.dim))

        return encode


def test_model_runs_once_per_row(spark, tmp_path):
    log = tmp_path / "calls"
    df = spark.range(20).select(F.col("id").cast("string").alias("t"))
    out = embed.embed_batches(df, CountingModel(str(log)), "t").where("embedding is not null")
    assert out.select("t", "embedding").toPandas().shape[0] == 20
    assert len(log.read_text().split()) == 20


def test_cache_embeds_each_content_once_and_keeps_versions_apart(spark, tmp_path):
    log = tmp_path / "calls"
    kind = "id string, modality string, content_hash string, idx bigint, sub_idx int, t string"
    rows = [(f"i{i}", "text", f"h{i % 4}", i, 0, f"t{i % 4}") for i in range(12)]
    manifest = spark.createDataFrame(rows, kind)
    cache = spark.createDataFrame(
        [("h0", [9.0] * 4, "text", "text_v001"), ("h1", [9.0] * 4, "text", "text_v000")],
        "content_hash string, embedding array<float>, modality string, model_version string",
    )
    found, fresh = embed.embed_with_cache(manifest, cache, CountingModel(str(log)), "t")
    got = {r.id: r for r in found.collect()}
    assert len(got) == 12 and sorted(r[0] for r in values(fresh, "content_hash")) == ["h1", "h2", "h3"]
    assert got["i0"].embedding == [9.0] * 4 and got["i1"].embedding == [1.0] * 4
    assert len(log.read_text().split()) == 3
    grown = cache.unionByName(fresh.select(*cache.columns))
    assert embed.cache_misses(manifest, grown).count() == 0
    assert embed.cache_misses(manifest, grown, version=2).count() == 4


def test_run_embed_counts_rows(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "id string, t string")
    seen = embed.run_embed(df, str(tmp_path / "out"), embed.HashingModel(4), "t")
    assert (seen["rows"], seen["embedded"]) == (2, 1)


def _brute(rows, queries, k, metric):
    out = {}
    for qid, g, q in queries:
        scored = []
        for i, h, v in rows:
            if h != g:
                continue
            a, b = np.float32(q).astype(float), np.float32(v).astype(float)
            d = ((a - b) ** 2).sum()
            if metric == "cosine":
                d = 1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
            scored.append((round(d, 9), i))
        out[(qid, g)] = [i for _, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("metric", ["l2sq", "cosine"])
@pytest.mark.parametrize("max_queries", [16384, 3])
def test_nearest_equals_brute_force(spark, metric, max_queries):
    rng = np.random.default_rng(3)
    rows = [(f"r{i:03d}", "ab"[i % 2], rng.normal(size=6).tolist()) for i in range(120)]
    # A third of the rows tie exactly; the id decides.
    rows = [(i, g, rows[0][2] if n % 3 == 0 else v) for n, (i, g, v) in enumerate(rows)]
    asked = [(q, "ab"[q % 2], rng.normal(size=6).tolist()) for q in range(7)] + [(8, "zz", [0.0] * 6)]
    table = spark.createDataFrame(rows, "id string, grp string, vec array<float>").repartition(5)
    queries = spark.createDataFrame(asked, "query_id int, grp string, vec array<float>")
    got = {}
    for r in search.nearest(table, queries, 4, metric, max_queries).orderBy("rank").collect():
        got.setdefault((r.query_id, r.grp), []).append(r.id)
    want = {key: ids for key, ids in _brute(rows, asked, 4, metric).items() if ids}
    assert got == want


def test_many_queries_are_one_job(spark):
    """Not one scan of the rows for every few of them."""
    rng = np.random.default_rng(4)
    rows = [(i, "a", rng.normal(size=4).tolist()) for i in range(300)]
    table = spark.createDataFrame(rows, "id int, grp string, vec array<float>")
    asked = table.where("id % 2 = 0").withColumnRenamed("id", "query_id")
    spark.sparkContext.setJobGroup("many-queries", "")
    hits = search.nearest(table, asked, 2, max_queries=3).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("many-queries")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(hits) == 300 and all(h.id == h.query_id for h in hits if h.rank == 1)
    assert len(jobs) < 12, len(jobs)


def test_search_by_text(spark):
    model = embed.HashingModel(8)
    texts = [("t1", "text", "red bird"), ("t2", "text", "blue fish"), ("i1", "image", "red bird")]
    catalog = spark.createDataFrame(texts, "id string, modality string, caption string").select(
        "id", "modality", "caption",
        F.when(F.col("modality") == "text", embed.embed_text(F.col("caption"), model)).alias("text_vector"),
        F.when(F.col("modality") == "image", embed.embed_text(F.col("caption"), model)).alias("clip_vector"),
        F.lit(True).alias("has_embedding"),
        *[F.lit("").alias(c) for c in ("content_path", "source", "metadata_json", "quality_status", "license", "content_hash")],
    )
    hidden = catalog.where("id = 't1'").withColumn("id", F.lit("t0")).withColumn("has_embedding", F.lit(False))
    probes = spark.createDataFrame([(1, " red bird ")], "query_id int, query string")
    out = search.search_texts(catalog.unionByName(hidden), probes, model, model, 1)
    got = {r.modality: r for r in out.collect()}
    assert got["text"].id == "t1" and got["text"].asset_url is None
    assert got["image"].asset_url == "/asset/i1" and got["image"].distance == 0.0
    with pytest.raises(Exception, match="non-empty query"):
        search.search_texts(catalog, probes.withColumn("query", F.lit("  ")), model, model, 1).collect()


def test_bad_metric(spark):
    with pytest.raises(ValueError):
        search.nearest(spark.range(1), spark.range(1), metric="dot")


def test_a_failing_modality_leaves_the_others(spark):
    from corpusloom import schemas

    rows = [(f"{m}{i}", m, [float(i), 1.0], [1.0, float(i), 0.0], True) for m in ("text", "image") for i in range(4)]
    kind = "id string, modality string, text_vector array<float>, clip_vector array<float>, has_embedding boolean"
    catalog = spark.createDataFrame(rows, kind)
    for name in schemas.CATALOG.fieldNames():
        if name not in catalog.columns:
            catalog = catalog.withColumn(name, F.lit("x"))
    good = [("q", "text", [1.0, 1.0]), ("q", "audio", [1.0, 1.0])]
    for bad, status in (([1.0, 2.0], "error"), ([1.0, 2.0, 0.0], "ok")):
        asked = spark.createDataFrame([*good, ("q", "image", bad)], "query_id string, modality string, vec array<float>")
        hits, told = search.search_each(catalog, asked, 2)
        got = {r.modality: (r.status, r.n_hits) for r in told.collect()}
        assert got["text"] == ("ok", 2) and got["audio"] == got["video"] == ("ok", 0)
        assert got["image"] == (status, 0 if status == "error" else 2)
        reason = told.where("modality = 'image'").first().reason
        assert ("length [2]" in reason) == (status == "error")
        assert hits.where("modality = 'text'").count() == 2
