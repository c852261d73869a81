import pytest
from pyspark.sql import functions as F

from corpusloom import session
from corpusloom.operators import catalog as cat
from corpusloom.operators import embed, quality, reports
from corpusloom.plans import curation, inputs
from corpusloom.sources import connectors as con
from corpusloom.streaming import flows
from conftest import values


def _run(spark, data, root):
    made = {m: (lambda m=m: inputs.manifest(spark, data, m)) for m in ("text", "image", "audio")}
    return curation.Run(
        spark,
        curation.Layout(str(root)),
        made,
        probe=lambda rows: inputs.with_probes(rows.withColumn("asset_exists", F.lit(True))),
        text_model=embed.HashingModel(32),
        clip_model=embed.HashingModel(48),
        shard_size=100,
    )


def test_full_run_then_nothing_left_to_do(spark, data, tmp_path):
    run = _run(spark, data, tmp_path)
    done = {(d["stage"], d["modality"]): d for d in curation.run_all(run, "v1")}
    text = done[("quality", "text")]
    assert text["total"] == done[("connectors", "text")]["rows"]
    assert text["rows"] + text["near_duplicates_removed"] <= text["passed"]
    embedded = cat.published(spark, run.layout.embedded("audio"))
    assert embedded.count() == done[("connectors", "audio")]["rows"]
    assert embedded.where("embedding is not null").count() == done[("quality", "audio")]["passed"]
    kept = sum(done[("quality", m)]["rows"] for m in run.modalities)
    assert done[("catalog", "all")]["rows"] == kept == done[("version", "all")]["rows"]
    assert done[("benchmark", "all")]["rows"] == kept
    again = curation.resume(run, "embed") + curation.resume(run, "filter")
    assert {d["status"] for d in again} == {"skipped"}
    # An incomplete artifact is rebuilt.
    path = run.layout.embedded("image")
    cat.publish(session.stage_table(cat.published(spark, path).limit(3), "cut"), path)
    (redo,) = curation.resume(run, "embed", "image")
    assert redo["status"] == "ok" and redo["reason"] == "incomplete output detected"
    status = {r.artifact: r for r in curation.artifact_status(spark, {"a": path, "b": str(tmp_path / "no")}).collect()}
    assert status["a"].present and status["a"].n_rows == redo["rows"] and not status["b"].present
    # The version before the last stays for its readers, and nothing older.
    assert len([p for p in tmp_path.rglob("part=*") if "image_embedded" in str(p)]) == 2


def test_freshness(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    spark.range(1).write.parquet(old)
    spark.range(1).write.parquet(new)
    named = {"old": old, "new": new, "none": str(tmp_path / "none")}
    got = {
        r.artifact: (r.newest is not None, r.stale)
        for r in curation.artifact_freshness(
            spark, named, {"old": "new", "new": "old", "none": "new"}
        ).collect()
    }
    assert got == {"old": (True, True), "new": (True, False), "none": (False, True)}
    reports.save_report(spark.range(2), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 2


def test_decisions():
    assert curation.embed_decision(None, None, False) == ("skipped", "missing manifest")
    assert curation.embed_decision(0, None, False) == ("skipped", "empty manifest")
    assert curation.embed_decision(5, 5, False)[0] == "skipped"
    assert curation.embed_decision(5, 4, False) == ("build", "incomplete output detected")
    assert curation.embed_decision(5, 5, True) == ("build", "force rebuild requested")


def test_resume_names(spark, data, tmp_path):
    for stage, names in curation.RESUME_NAMES.items():
        for name in names:
            assert curation.stage_named(name.upper().replace("_", "-")) == stage
    run = _run(spark, data, tmp_path)
    for bad in ({"stage": "stage10"}, {"stage": "embed", "modality": "bogus"}):
        with pytest.raises(ValueError):
            curation.resume(run, **bad)


def test_missing_inputs(spark, data, tmp_path):
    run = _run(spark, data, tmp_path)
    assert curation.resume(run, "embed", "text")[0]["reason"] == "missing manifest"
    assert curation.resume(run, "dedup", "text")[0]["reason"] == "missing manifest"
    assert curation.resume(run, "catalog")[0]["rows"] == 0
    assert curation.resume(run, "benchmark")[0]["reason"] == "no shards"
    with pytest.raises(ValueError):
        curation.resume(run, "nonsense")


def test_nothing_passes_gives_an_empty_result(spark, data):
    rows = inputs.embedded(spark, data, "image")
    gated, unique, kept = curation.curate(rows, 512)
    assert gated.count() == quality.quality_report(gated).first().failed > 0
    assert unique.count() == 0 and kept.count() == 0


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "yarn"})()

    with pytest.raises(RuntimeError):
        session.shared_folder(Session())


def test_stream_equals_batch(spark, data, tmp_path):
    raw = inputs.raw_text(spark, data)
    folder = str(tmp_path / "in")
    raw.repartition(4).write.parquet(folder)
    stream = flows.arrivals(spark, folder, raw.schema, files_per_batch=1)
    flows.run(flows.first_by_hash(con.text_manifest(stream), str(tmp_path / "out")))
    got = sorted(values(flows.read_firsts(spark, str(tmp_path / "out"))))
    want = con.text_manifest(raw).groupBy("content_hash").agg(F.min("idx"))
    assert got == sorted(values(want))
