import hashlib
import json

import pytest
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.plans import inputs
from corpusloom.sources import connectors as con
from corpusloom.sources import probe, readers, scan
from conftest import values

TEXT_RAW = "idx bigint, text string, url string, token_count int"


def _words(n):
    return " ".join(f"w{i}" for i in range(n))


def test_text_manifest_follows_the_schema(spark):
    raw = spark.createDataFrame(
        [(0, _words(29), "u", 1), (1, " " + _words(30).replace(" ", "\n"), None, None)], TEXT_RAW
    )
    out = con.text_manifest(raw)
    assert [f.name for f in out.schema] == schemas.MANIFEST.fieldNames()
    assert out.schema["payload"].dataType.simpleString() == schemas.PAYLOAD.simpleString()
    (row,) = out.collect()
    assert row.id == "fineweb_00000001"
    assert row.payload.content == _words(30)
    assert row.content_hash == hashlib.sha256(_words(30).encode()).hexdigest()
    assert (row.payload.metadata.url, row.payload.metadata.token_count) == ("", 0)


def test_text_manifest_keeps_whole_texts_unless_cut(spark):
    long = _words(1000)
    raw = spark.createDataFrame([(0, long, "", 0)], TEXT_RAW)
    whole = con.text_manifest(raw).first().payload
    assert whole.content == long and whole.caption == long[:200]
    cut = con.text_manifest(raw, max_chars=2000).first()
    assert cut.payload.content == long[:2000]
    assert cut.content_hash == hashlib.sha256(long[:2000].encode()).hexdigest()


def test_cut_is_judged_after_cutting(spark):
    raw = spark.createDataFrame([(0, _words(40), "", 0)], TEXT_RAW)
    assert con.text_manifest(raw, max_chars=20).count() == 0


@pytest.mark.parametrize("seconds,clips", [(3, 1), (8, 1), (16, 2), (17, 3), (100, 13), (0.5, 1)])
def test_clip_plan(spark, seconds, clips):
    df = spark.createDataFrame([(0, float(seconds))], "idx bigint, d double")
    got = values(con.plan_clips(df, "d"), "clip_idx", "clip_start")
    assert got == [(i, 8.0 * i) for i in range(clips)]
    some = values(con.plan_clips(df, "d", max_clips=2), "clip_idx")
    assert some == [(i,) for i in range(max(1, min(2, int(seconds // 8))))]


def test_frames_and_segments(spark):
    df = spark.createDataFrame([(0, 50, 25.0), (1, 0, None)], "idx bigint, n int, d double")
    assert values(con.plan_frames(df, "n", 24), "idx", "frame_idx", "frame_no") == [
        (0, 0, 0), (0, 1, 24), (0, 2, 48),
    ]
    pieces = values(con.plan_segments(df, "d", 10.0), "piece_start", "piece_seconds")
    assert pieces == [(0.0, 10.0), (10.0, 10.0), (20.0, 5.0)]


def test_image_hash_and_captions(spark):
    raw = spark.createDataFrame(
        [
            (3, [" ", " first ", "second"], 0, bytearray(b"jpg"), None, None),
            (4, ["only"], 9, None, "f.jpg", "val"),
            (5, ["  "], 1, None, "", ""),
        ],
        "idx bigint, sentences_raw array<string>, cocoid bigint, image binary, filename string, split string",
    )
    first, second = con.image_manifest(raw, "/img").orderBy("idx").collect()
    assert first.id == "coco_000000000003" and first.payload.caption == "first"
    assert first.content_hash == hashlib.sha256(b"jpg").hexdigest()
    assert json.loads(first.payload.metadata.all_captions) == ["first", "second"]
    assert first.payload.metadata.split == "train"
    assert second.id == "coco_000000000009"
    assert second.content_hash == hashlib.sha256(b"coco_000000000009only").hexdigest()


def test_video_needs_payload_and_frames(spark):
    kind = (
        "idx bigint, caption string, video struct<bytes:binary,path:string,path_exists:boolean>,"
        " category string, duration double, fps double"
    )
    raw = spark.createDataFrame(
        [
            (0, "a  b", (bytearray(b"v"), None, False), "c", 1.0, 24.0),
            (1, "a", (None, "/p", True), None, 1.0, 24.0),
            (2, "a", (None, "/p", False), None, 1.0, 24.0),
            (3, " ", (bytearray(b"v"), None, False), None, 1.0, 24.0),
            (4, "a", (bytearray(b"v"), None, False), None, 0.0, 24.0),
        ],
        kind,
    )
    rows = con.video_manifest(raw, "/v", "/k").orderBy("idx").collect()
    assert [r.idx for r in rows] == [0, 1]
    assert rows[0].payload.caption == "a b" and rows[0].payload.metadata.n_keyframes == 6
    assert json.loads(rows[0].payload.metadata.keyframe_paths)[0] == "/k/msrvtt_00000000/frame_001.jpg"
    assert rows[1].content_hash == hashlib.sha256(b"msrvtt_00000001a").hexdigest()


def test_audio_defaults(spark):
    kind = (
        "idx bigint, text string, audio struct<array:array<double>,bytes:binary,path:string,"
        "path_exists:boolean,sampling_rate:int>, speaker_id bigint, chapter_id bigint"
    )
    raw = spark.createDataFrame(
        [
            (0, "hi  there", ([0.1], None, None, False, 8000), 5, None),
            (1, "hi", (None, None, "/x.wav", True, None), 5, 1),
            (2, "hi", (None, None, "/x.wav", False, None), 5, 1),
            (3, "", ([0.1], None, None, False, None), 5, 1),
        ],
        kind,
    )
    rows = con.audio_manifest(raw, "/a").orderBy("idx").collect()
    assert [(r.idx, r.payload.metadata.sampling_rate) for r in rows] == [(0, 8000), (1, 16000)]
    assert rows[0].payload.metadata.chapter_id == ""
    kinds = values(raw.orderBy("idx"), probe.resolve_audio())
    assert [k[0] for k in kinds] == ["array", "path", None, "array"]


def test_bounded_scan(spark, data):
    raw = inputs.raw_text(spark, data)
    empty = scan.bounded_scan(raw, con.text_manifest, limit=0)
    assert empty.count() == 0 and empty.schema["id"].dataType.simpleString() == "string"
    assert scan.bounded_scan(raw, con.text_manifest, limit=5, max_scan=3).count() <= 3

    def clips(r):
        return con.clip_manifest(r, "/c", "/f")

    some = scan.bounded_scan(inputs.raw_clips(spark, data), clips, limit=7)
    assert some.count() == 7
    report = scan.scan_outcome(some, 9).first()
    assert (report.accepted, report.under_target) == (7, True)


def test_bounded_scan_reaches_the_file_scan(spark, data):
    plan = scan.bounded_scan(inputs.raw_clips(spark, data), lambda r: con.clip_manifest(r, "/c", "/f"), 7)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(p_partkey,140)" in text


def test_probe_outcomes(spark):
    kind = (
        "idx bigint, caption string, text array<string>, video struct<bytes:binary,path:string>,"
        " file string, duration double"
    )
    raw = spark.createDataFrame(
        [
            (0, "c", None, (bytearray(b"x"), None), None, 20.0),
            (1, "", ["", "t"], (None, "/p"), None, 20.0),
            (2, None, [], (bytearray(b"x"), None), None, 20.0),
            (3, "c", None, None, "/missing", 20.0),
            (4, "c", None, None, None, 20.0),
            (5, "c", None, (bytearray(b"x"), None), None, None),
        ],
        kind,
    )
    preset = probe.PRESETS["alexzigma"]
    got = values(probe.judge_rows(raw, preset).orderBy("idx"), "outcome", "clips")
    assert got == [
        ("accept", 3),
        ("unusable payload", 0),
        ("no caption", 0),
        ("unusable payload", 0),
        ("no video field", 0),
        ("no duration", 0),
    ]
    few = values(probe.judge_rows(raw, preset, max_clips=2).orderBy("idx"), "clips")
    assert few[0] == (2,)
    first = probe.probe_first(raw, preset, accepted_target=1)
    assert values(first, "id", "shape") == [("probe_00000000_clip_000", "dict.bytes")]
    assert probe.require_accepted(first) == 1
    with pytest.raises(ValueError):
        probe.require_accepted(first, 2)
    shapes = dict(values(probe.schema_summary(raw), "field", "shape"))
    assert shapes["video"] == "dict keys=['bytes', 'path']" and shapes["file"] == "null"


def test_asset_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.jpg").write_bytes(b"one")
    (tmp_path / "b.txt").write_bytes(b"two")
    rows = readers.asset_listing(spark, str(tmp_path), "*.jpg", with_hash=True).collect()
    assert [(r.path, r.length, r.content_hash) for r in rows] == [
        (str(tmp_path / "sub" / "a.jpg"), 3, hashlib.sha256(b"one").hexdigest())
    ]
    listed = readers.asset_listing(spark, str(tmp_path))
    assert listed.count() == 2
    assert "content" not in listed._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]


def test_deliveries_are_many_files(spark):
    """Three deliveries, whose files grow in number with the tasks of the input."""
    from corpusloom.plans import registry

    rows = spark.range(0, 2000, 1, 10).withColumnRenamed("id", "idx")
    stream, seen = registry._delivered(spark, rows, 3), []

    def each(batch, _):
        seen.append((batch.count(), batch.select(F.input_file_name()).distinct().count(), batch.agg(F.sum("idx")).first()[0]))

    registry.flows.run(registry.flows._start(stream, each, None))
    assert len(seen) == 3 and sum(n for n, _, _ in seen) == 2000
    assert sum(total for _, _, total in seen) == 1999 * 1000
    assert [files for _, files, _ in seen] == [4, 4, 4]


def test_a_narrow_table_of_one_row_group_is_dealt_out(spark, tmp_path):
    """Many tasks by bytes, of which one reads all rows."""
    one = tmp_path / "one.parquet"
    spark.range(0, 20_000, 1, 1).write.parquet(str(one))
    size, tasks = "spark.sql.files.maxPartitionBytes", spark.sparkContext.defaultParallelism
    spark.conf.set(size, "2k")
    try:
        held = readers.spread_rows(spark.read.parquet(str(one)))
        counts = held.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset(size)
    assert len(counts) >= tasks and max(r["count"] for r in counts) < 20_000 / tasks * 2


def test_frame_names_have_three_digits_or_more(spark):
    made = spark.range(1).select(con.frame_paths("/f/", F.lit("c"), F.lit(1001))).first()[0]
    assert made == [f"/f/c/frame_{i:03d}.jpg" for i in range(1, 1002)]
