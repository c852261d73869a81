import hashlib
import io
import json
import os
import re
import tarfile

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.operators import assets, reports, shards, versions
from corpusloom.operators import catalog as cat
from corpusloom.operators.ranking import limit_per_group, with_position
from corpusloom.plans import registry
from corpusloom.session import discard, scratch
from corpusloom.sources import readers, tarshard
from conftest import pairs, values


def _manifest(spark, n=6):
    rows = []
    for i in range(n):
        modality = schemas.MODALITIES[i % 4]
        meta = tuple(None for _ in schemas.METADATA)
        rows.append(
            (f"id{i}", f"coco/{i % 2}", modality, f"{i:064x}", (modality, f"/a/{i}.jpg", f"cap {i}", meta), i, 0)
        )
    return spark.createDataFrame(rows, schemas.MANIFEST)


def test_catalog_vectors(spark):
    got = spark.createDataFrame(
        [("id0", [1.0, 2.0], 0), ("id0", [3.0, 4.0], 1), ("id1", [1.0, 2.0, 3.0], 0), ("id3", [1.0], 0)],
        "id string, embedding array<float>, pos bigint",
    )
    rows = {r.id: r for r in cat.build_catalog(_manifest(spark), got, 2, 3).collect()}
    assert rows["id0"].text_vector == [3.0, 4.0] and rows["id0"].has_embedding
    assert rows["id1"].clip_vector == [1.0, 2.0, 3.0] and rows["id1"].text_vector == [0.0, 0.0]
    assert rows["id3"].text_vector == [0.0, 0.0] and not rows["id3"].has_embedding
    assert not rows["id2"].has_embedding and rows["id2"].quality_status == "unknown"
    assert json.loads(rows["id2"].metadata_json) == {}
    assert rows["id2"].license == "cc-by-4.0"


def test_replace_append_and_query(spark, tmp_path):
    path = str(tmp_path / "catalog")
    rows = cat.build_catalog(_manifest(spark), text_dim=2, clip_dim=2)
    cat.replace_catalog(rows, path)
    cat.append_catalog(rows.where("id = 'id0'"), path)
    table = cat.read_catalog(spark, path)
    assert table.count() == 7
    assert [r.id for r in cat.query_catalog(table, ["text"], ["coco/0"], limit=2).collect()] == ["id0", "id0"]
    found = cat.query_catalog(table, ["image"], limit=None)
    assert "PartitionFilters: [isnotnull(modality" in found._jdf.queryExecution().executedPlan().toString()
    assert cat.lookup(table, "id3").count() == 1
    with pytest.raises(ValueError):
        cat.lookup(table, "x' or 1=1")
    cat.replace_catalog(rows.where("false"), path)
    empty = cat.read_catalog(spark, path)
    assert empty.count() == 0 and empty.columns == schemas.CATALOG.fieldNames()
    fresh = str(tmp_path / "new")
    cat.append_catalog(rows, fresh)
    assert cat.read_catalog(spark, fresh).count() == 6


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("id"))
    got = with_position(df.repartition(6), "k", "id").where("pos <> k").count()
    assert got == 0
    assert with_position(df.where("false"), "k", "id").count() == 0


def test_limit_per_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "g string, i int")
    got = sorted(values(limit_per_group(df, "g", ["a", "b", "c"], ["i"], 2)))
    assert got == [("a", 0), ("a", 1), ("b", 9)]


def test_versions(spark, tmp_path):
    root = str(tmp_path)
    table = cat.build_catalog(_manifest(spark)).withColumn(
        "quality_status", F.when(F.col("id") == "id4", "fail").otherwise("pass")
    )
    head = versions.create_version(table, root, "v1", ["text", "audio"], config={"a": 1}).first()
    assert (head.total_items, head.modalities.text, head.modalities.audio) == (2, 1, 1)
    items = versions.load_version(spark, root, "v1")
    assert values(items.orderBy("pos"), "pos", "id") == [(0, "id0"), (1, "id3")]
    again = versions.create_version(table, root, "v1", ["text", "audio"], config={"a": 1}).first()
    assert again.created_at == head.created_at
    with pytest.raises(FileExistsError):
        versions.create_version(table, root, "v1", ["text"])
    versions.create_version(table, root, "v2", quality_filter=False, exclude_sources=["coco/1"])
    assert [r[0] for r in values(versions.list_versions(spark, root))] == ["v1", "v2"]
    with pytest.raises(FileNotFoundError):
        versions.load_version(spark, root, "v9")
    second = versions.load_version(spark, root, "v2")
    assert pairs(versions.diff_versions(items, second)) == {
        "id0": "common", "id3": "removed", "id2": "added", "id4": "added",
    }
    assert pairs(versions.modality_counts(second, ["text", "image", "sound"])) == {
        "text": 2, "image": 0, "sound": 0,
    }
    changed = second.withColumn("content_hash", F.lit("other"))
    assert set(pairs(versions.diff_versions(second, changed)).values()) == {"changed"}


def test_limits_and_sources(spark):
    table = cat.build_catalog(_manifest(spark, 40))
    items = versions.select_items(
        table, "v", sources=["coco/0"], quality_filter=False, limit_per_modality=3
    )
    got = values(items.orderBy("pos"), "modality", "id")
    assert [m for m, _ in got] == ["text"] * 3 + ["video"] * 3
    assert [i for _, i in got][:3] == sorted(f"id{n}" for n in range(0, 40, 4))[:3]


def test_split_is_stable_and_reaches_every_modality(spark):
    rows = [(f"x{i}", "text") for i in range(3000)] + [("one", "audio")]
    df = spark.createDataFrame(rows, "id string, modality string")
    first = pairs(versions.train_eval_split(df).select("id", "split"))
    part = pairs(versions.train_eval_split(df.where("id like 'x1%'")).select("id", "split"))
    share = sum(s == "eval" for s in first.values()) / 3001
    assert 0.07 < share < 0.13 and first["one"] == "eval"
    assert sum(first[i] != s for i, s in part.items()) <= 1
    assert set(pairs(versions.train_eval_split(df, 0.0).select("id", "split")).values()) == {"train"}


def test_epoch_order_resumes(spark):
    df = spark.createDataFrame([(f"x{i}",) for i in range(50)], "id string")
    whole = pairs(versions.epoch_order(df, 1, 0))
    rest = pairs(versions.epoch_order(df.repartition(3), 1, 0, resume_at=20))
    assert sorted(whole.values()) == list(range(50))
    assert rest == {i: p for i, p in whole.items() if p >= 20}
    assert whole != pairs(versions.epoch_order(df, 1, 1))


def test_versions_pin_their_inputs(spark, tmp_path):
    """The same name with changed inputs is refused, in whatever order rows come."""
    table = cat.build_catalog(_manifest(spark), text_dim=2, clip_dim=2)
    rows = spark.createDataFrame(
        [(1, "a", [1.0]), (2, None, None), (2, None, None), (3, "", [])], "k int, s string, v array<double>"
    )
    root = str(tmp_path / "v")
    first = versions.create_version(table, root, "v1", inputs={"t": rows}).first()
    again = rows.repartition(3).select("v", "s", "k")
    assert versions.create_version(table, root, "v1", inputs={"t": again}).first() == first
    assert json.loads(first.config)["inputs"]["t"]["rows"] == 4
    changed = [
        rows.where("k < 3"), rows.unionByName(rows.where("k = 1")), rows.withColumn("s", F.coalesce("s", F.lit(""))),
        rows.withColumn("k", F.col("k") + 1),
    ]
    for other in changed:
        with pytest.raises(FileExistsError):
            versions.create_version(table, root, "v1", inputs={"t": other})
    with pytest.raises(FileExistsError):
        versions.create_version(table, root, "v1", inputs={"u": rows})
    empty = versions.content_fingerprint(rows.limit(0)).first()
    assert (empty.n_rows, empty.fingerprint) == (0, "0")


def _shard_parts(spark, folder):
    items = spark.createDataFrame(
        [("v", i, x, "text", "s", "h") for i, x in enumerate("abxc")], schemas.VERSION_ITEMS
    )
    (folder / "b.jpg").write_bytes(b"picture")
    kind = (
        "id string, source string, modality string, content_hash string, quality_status string,"
        " license string, caption string, content_path string, metadata_json string,"
        " text_vector array<float>, clip_vector array<float>"
    )
    table = spark.createDataFrame(
        [
            ("a", "s", "text", "h", None, None, "cap", "inline", None, [1.0], [0.0]),
            ("b", "s", "image", "h", "pass", "mit", "cap", str(folder / "b.jpg"), "{}", [0.0], [2.0]),
            ("c", "s", "text", "h", "pass", "mit", "cap", "", "{}", [3.0], [0.0]),
            ("c", "z", "text", "h", "pass", "mit", "other", "", "{}", [4.0], [0.0]),
        ],
        kind,
    )
    listing = readers.asset_listing(spark, str(folder), "*.jpg")
    return items, shards.plan_members(items, table, 2, listing)


def test_shards(spark, tmp_path):
    items, members = _shard_parts(spark, tmp_path)
    got = {r.id: r for r in members.collect()}
    assert {i: r.shard_idx for i, r in got.items()} == {"a": 0, "b": 0, "c": 1}
    assert got["a"].text == "inline" and got["c"].text == "cap" and got["b"].text == ""
    assert got["b"].asset == "b.jpg" and got["a"].asset == ""
    assert pairs(shards.shard_manifest(items, members, 2)) == {
        "shard-000000.tar": 2, "shard-000001.tar": 1,
    }
    out = tmp_path / "shards"
    contents = spark.read.format("binaryFile").load(str(tmp_path / "*.jpg"))
    shards.write_shards(members, str(out), items, contents, 2)
    assert sorted(_tars(spark, out)) == ["shard-000000.tar", "shard-000001.tar"]
    with tarfile.open(_tars(spark, out)["shard-000000.tar"]) as tar:
        names = tar.getnames()
        record = json.load(io.BytesIO(tar.extractfile("b.json").read()))
        assert tar.extractfile("b.jpg").read() == b"picture"
    assert names == ["a.json", "b.jpg", "b.json"]
    assert record["embedding"] == [2.0] and record["asset"] == "b.jpg" and record["license"] == "mit"
    stats = {r.shard: r for r in shards.shard_stats(shards.read_shards(spark, str(out))).collect()}
    assert stats["shard-000000.tar"].items == 2 and stats["shard-000001.tar"].items == 1
    heads = shards.shard_stats(shards.read_shards(spark, str(out), records=False))
    assert {r.shard: r.bytes for r in heads.collect()} == {k: r.bytes for k, r in stats.items()}
    total = shards.loader_metrics(shards.shard_stats(shards.read_shards(spark, str(out))), 2.0)
    assert total["items"] == 3 and total["items_per_second"] == 1.5
    # A smaller write leaves no old shard, one that fails nothing at all.
    shards.write_shards(members.where("shard_idx = 0"), str(out), None, contents, 2)
    left = _tars(spark, out)
    assert list(left) == ["shard-000000.tar"]
    with pytest.raises(Exception, match="no content for"):
        shards.write_shards(members, str(out), items, contents.where("false"), 2)
    assert _tars(spark, out) == left
    # Nothing of the failed write stays, of the first one nothing after two more.
    assert len(list((out / "sets").iterdir())) == 2
    shards.write_shards(members.where("shard_idx = 0"), str(out), None, contents, 2)
    assert len(list((out / "sets").iterdir())) == 2
    counted = {r.shard: r.n for r in shards.read_shards(spark, str(out)).groupBy("shard").agg(F.count("*").alias("n")).collect()}
    assert counted == {"shard-000000.tar": 3}
    with pytest.raises(ValueError):
        shards.write_shards(members, str(out), items)
    with pytest.raises(Exception, match="nosuch"):
        shards.write_shards(members.where("id = 'a'"), "nosuch://x/shards")


def _tars(spark, folder):
    return {r.shard: r.file for r in shards.shard_files(spark, str(folder)).collect()}


def test_shards_are_packed_by_bytes(spark):
    """A large shard alone, small ones together, in order; all in the right task."""
    sizes = spark.createDataFrame(
        [(i, 1000 if i == 3 else 10, 1) for i in range(2500)], "shard_idx bigint, bytes bigint, items int"
    )
    got = pairs(tarshard.packed(sizes, 100).drop("items"))
    before, want = 0, {}
    for i in range(2500):
        want[i] = before // 100
        before += 1000 if i == 3 else 10
    assert got == want


def test_thousands_of_shards_take_few_tasks(spark, tmp_path):
    n = 600
    members = spark.range(n).select(
        F.col("id").alias("shard_idx"), F.col("id").alias("pos"), F.format_string("i%d", "id").alias("id"),
        *[F.lit("").alias(c) for c in ("source", "modality", "caption", "quality_status", "license")],
        F.lit("{}").alias("metadata_json"), F.lit("").alias("asset"), F.lit("t").alias("text"),
        F.array(F.lit(1.0).cast("float")).alias("embedding"), F.lit("").alias("content_path"),
    )
    out = str(tmp_path / "shards")
    shards.write_shards(members, out, shard_size=1, task_bytes=1 << 19)
    listed = shards.shard_files(spark, out)
    assert listed.count() == n and listed.where("items = 1 and bytes % 512 = 0").count() == n
    tasks = listed.select(F.regexp_extract("file", "part-([0-9]+)", 1)).distinct().count()
    assert 3 <= tasks <= 6
    stats = shards.shard_stats(shards.read_shards(spark, out, records=False))
    assert stats.where("items = 1").count() == n


def test_shards_are_dealt_out_some_at_a_time(spark, tmp_path, monkeypatch):
    """No shuffle holds all rows beside the archives; every shard is whole, once."""
    n = 200
    kind = "shard_idx bigint, pos bigint, embedding array<float>, " + ", ".join(
        f"{c} string" for c in (*shards.RECORD[:-1], "content_path")
    )
    rows = [
        {"shard_idx": i // 3, "pos": i, "id": f"i{i}", "asset": "", "text": "t" * i, "embedding": [0.0]}
        for i in range(3 * n)
    ]
    members = spark.createDataFrame(rows, kind)
    waves, write = [], tarshard._write_tasks

    def noted(*given):
        waves.append(given[4])
        write(*given)

    monkeypatch.setattr(tarshard, "_write_tasks", noted)
    out = str(tmp_path / "shards")
    shards.write_shards(members, out, shard_size=3, task_bytes=1 << 15)
    assert len(waves) > 2 and max(waves) == spark.sparkContext.defaultParallelism
    listed = shards.shard_files(spark, out)
    assert listed.count() == n == listed.select("shard").distinct().count()
    got = shards.read_shards(spark, out).select("shard", F.get_json_object("json", "$.id").alias("id"))
    assert {(r.shard, r.id) for r in got.collect()} == {
        (f"shard-{i // 3:06d}.tar", f"i{i}") for i in range(3 * n)
    }
    with tarfile.open(listed.where("shard = 'shard-000007.tar'").first().file) as tar:
        assert tar.getnames() == ["i21.json", "i22.json", "i23.json"]


def test_placed_members_stand_alone(spark, tmp_path):
    """Members that were written need neither catalog nor items any more; they hold
    no zero vector and no text twice."""
    n = 40
    rows = [
        (f"id{i:03d}", "s", "text" if i % 2 else "video", "h", "pass", "mit", f"cap {i}", f"body {i}", "{}",
         [0.0, 0.0], [0.0, 1.0] if i % 4 else [0.0, 0.0])
        for i in range(n)
    ]
    kind = "id string, source string, modality string, content_hash string, quality_status string," \
        " license string, caption string, content_path string, metadata_json string," \
        " text_vector array<float>, clip_vector array<float>"
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "catalog"))
    items = [("v", i, f"id{i:03d}", "text", "s", "h") for i in range(n)]
    spark.createDataFrame(items, schemas.VERSION_ITEMS).write.parquet(str(tmp_path / "items"))
    read = [spark.read.parquet(str(tmp_path / name)) for name in ("items", "catalog")]
    want = sorted(values(shards.plan_members(*read, 7)))
    members = shards.plan_members(*read, 7, None, str(tmp_path / "members"))
    for name in ("items", "catalog"):
        discard(spark, str(tmp_path / name))
    assert sorted(values(members)) == want and len(want) == n
    held = spark.read.parquet(str(tmp_path / "members"))
    assert not {"text", "embedding"} & set(held.columns)
    assert held.where("_vec is not null").count() == sum(r[2] == "video" and r[10] != [0.0, 0.0] for r in rows)


def test_record_bytes_are_about_right(spark):
    vectors = [[0.0] * 512, [0.1234567 * (i + 1) for i in range(384)], [], None]
    kind = "embedding array<float>, " + ", ".join(f"{c} string" for c in shards.RECORD[:-1])
    rows = [{"embedding": v, "id": "x", "text": "word " * 300} for v in vectors]
    sizes = spark.createDataFrame(rows, kind).select(
        shards._record_bytes(), F.octet_length(shards.record_json())
    )
    assert all(0.7 < about / size < 1.5 for about, size in values(sizes))


def test_scan_frees_the_disk_for_its_archives(spark, tmp_path, monkeypatch):
    """When the archives are written only their members are staged, and after it nothing."""
    tables = {
        "documents": [(i, f"{i} " + "some words of a text " * 9, 190) for i in range(12)],
        "pages": [(i, f"http://h/{i}", f"<title>A title of some length {i}</title>") for i in range(9)],
        "part": [(i, f"name {i}", "Brand", "TYPE", 5 + i) for i in range(20)],
        "conversations": [(i, 0, "user", f"a spoken turn that is long enough to pass {i} " * 2) for i in range(9)],
    }
    kinds = {
        "documents": "doc_id bigint, text string, n_chars bigint",
        "pages": "page_id bigint, url string, html string",
        "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
        "conversations": "conv_id bigint, turn int, role string, text string",
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, kinds[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    held, write = [], tarshard.write

    def noted(*given):
        held.extend(os.path.relpath(d, folder) for d, _, names in os.walk(folder) if names)
        write(*given)

    monkeypatch.setattr(tarshard, "write", noted)
    with scratch(spark) as folder:
        found = registry.QUERIES["shard_scan"](spark, str(tmp_path))
        left = os.listdir(folder)
        assert found.agg(F.sum("items")).first()[0] > 50
    labels = {re.sub("-[0-9a-f]{32}", "", d) for d in held}
    assert labels == {"scratch/members", "scratch/places", "scratch/scratch/shards"}
    assert len(left) == 1 and left[0].startswith("shards-")


@pytest.mark.parametrize("size", [0, 1, 400, 512, 1024, 3000])
def test_entries_end_in_a_zero(size):
    data = tarshard.entry("i", "x" * size, "f.bin", b"y" * size)
    assert data[-1] == 0 and len(data) % 512 == 0
    with tarfile.open(fileobj=io.BytesIO(data + bytes(1024))) as tar:
        assert tar.extractfile("f.bin").read() == b"y" * size
        assert tar.extractfile("i.json").read().decode().rstrip("\n") == "x" * size


def test_empty_shard_is_an_empty_tar(spark, tmp_path):
    items, members = _shard_parts(spark, tmp_path)
    out = tmp_path / "shards"
    contents = spark.read.format("binaryFile").load(str(tmp_path / "*.jpg"))
    shards.write_shards(members.where("shard_idx = 0"), str(out), items, contents, 2)
    with tarfile.open(_tars(spark, out)["shard-000001.tar"]) as tar:
        assert tar.getnames() == []


def test_unknown_shard_is_empty(spark, tmp_path):
    items, members = _shard_parts(spark, tmp_path)
    none = members.where("shard_idx = 0")
    assert pairs(shards.shard_manifest(items, none, 2))["shard-000001.tar"] == 0


def test_cas(spark, tmp_path):
    data = b"blob"
    digest = hashlib.sha256(data).hexdigest()
    for name in ("one.jpg", "two.jpg"):
        (tmp_path / name).write_bytes(data)
    meta = tuple(None for _ in schemas.METADATA)
    rows = [
        (n, "s", "image", digest, ("image", str(tmp_path / f"{n}.jpg"), "c", meta), 0, 0) for n in ("one", "two")
    ] + [("t", "s", "text", "x", ("text", "inline", "c", meta), 0, 0)]
    manifest = spark.createDataFrame(rows, schemas.MANIFEST)
    root = str(tmp_path / "cas")
    layout = assets.cas_layout(manifest, root)
    assert layout.count() == 2
    nothing = spark.createDataFrame([], "path string")
    missing = assets.cas_missing(layout, nothing)
    assert values(missing, "id") == [("one",)]
    assets.cas_put(missing)
    assets.cas_put(missing)
    listing = readers.asset_listing(spark, root)
    assert listing.count() == 1 and assets.cas_missing(layout, listing).count() == 0
    assert {r.stored for r in assets.cas_get(layout, listing).collect()} == {True}
    held = readers.stored_hashes(listing)
    assert [r.content_hash for r in held.collect()] == [digest]
    live = spark.createDataFrame([(digest,)], "content_hash string")
    assert assets.cas_garbage(held, live).count() == 0
    assert assets.cas_garbage(held, live.where("false")).count() == 1
    moved = {r.id: r.payload.content for r in assets.use_cas_paths(manifest, root).collect()}
    assert moved["one"] == moved["two"] == values(layout, "dest")[0][0] and moved["t"] == "inline"
    plan = assets.plan_precompute(listing, root, "/pre").first()
    assert plan.dest == plan.src.replace(root, "/pre") and plan.width == 224


def test_jobs_and_eval(spark):
    log = spark.createDataFrame(
        [("a", 1, 1, "failed"), ("a", 2, 2, "failed"), ("b", 1, 3, "failed"), ("b", 2, 4, "succeeded")],
        "job_key string, ts int, seq int, state string",
    )
    got = {r.job_key: r for r in reports.job_status(log, max_retries=1).collect()}
    assert got["a"].state == "dead_letter" and got["b"].state == "succeeded"
    probes = spark.createDataFrame(
        [(1, "text", ["dog", "grass"]), (2, "text", ["cat"])],
        "query_id int, target_modality string, expected_terms array<string>",
    )
    hits = spark.createDataFrame(
        [("v1", 1, "text", 1, ["dog"], 0.5), ("v1", 1, "text", 2, ["x"], 1.5)],
        "version string, query_id int, modality string, rank int, words array<string>, distance double",
    )
    out = {r.version: r for r in reports.retrieval_eval(probes, hits, ["v1", "v2"]).collect()}
    assert (out["v1"].query_count, out["v1"].hit_rate_at_5, out["v1"].empty_result_count) == (2, 0.5, 1)
    assert out["v1"].mean_keyword_overlap_at_5 == 0.125 and out["v1"].mean_distance_at_5 == 1.0
    assert out["v2"].empty_result_count == 2


def _bare_catalog(spark):
    none, zero = [0.0, 0.0], [0.0, 0.0, 0.0]
    rows = [
        ("a", "text", [1.0, 2.0], zero, True),
        ("b", "image", none, [0.0, 3.0, 0.0], True),
        ("c", "text", none, zero, False),
        ("d", "text", None, [0.0], False),
        ("e", "audio", [], None, False),
    ]
    kind = "id string, modality string, text_vector array<float>, clip_vector array<float>, has_embedding boolean"
    return spark.createDataFrame(rows, kind)


def test_staged_catalog_holds_no_zero_vector(spark):
    rows = _bare_catalog(spark)
    staged = cat.stage_catalog(rows, 2, 3)
    assert staged.schema.names == rows.schema.names
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, rows.collect()))
    held = spark.read.parquet(*staged.inputFiles())
    zeros = "forall(text_vector, x -> x = 0) and size(text_vector) = 2"
    assert held.where(zeros).count() == 0
    assert held.where("forall(clip_vector, x -> x = 0) and size(clip_vector) = 3").count() == 0


def test_members_are_placed_without_their_zero_vectors(spark):
    items = spark.createDataFrame(
        [("v", i, x, "text", "s", "h") for i, x in enumerate("abcde")], schemas.VERSION_ITEMS
    )
    table = _bare_catalog(spark).select(
        "*",
        *[F.lit("x").alias(c) for c in ("source", "content_hash", "quality_status", "license")],
        *[F.lit("").alias(c) for c in ("caption", "content_path", "metadata_json")],
    )
    members = shards.plan_members(items, table, 2)
    got = {r.id: r.embedding for r in members.collect()}
    assert got == {"a": [1.0, 2.0], "b": [0.0, 3.0, 0.0], "c": [0.0, 0.0], "d": [], "e": []}
    ranked = members._jdf.queryExecution().optimizedPlan().toString().split("Window", 1)[1]
    assert "_zeros" in ranked.split("\n", 1)[1]
