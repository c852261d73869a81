from pyspark.sql import functions as F

from corpusloom.operators import quality
from conftest import pairs, values


def _text(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string")
    return [r[0] for r in values(quality.mark(df, quality.text_rules(F.col("t"))).orderBy("i"), "quality_reason")]


def test_text_rules(spark):
    nine, ten = " ".join(["word"] * 9), " ".join(["word"] * 10)
    half = " ".join(["a1"] * 10)[:-1]  # letters are then above half of nothing else
    assert _text(spark, [nine, ten, "", None, "12 34 56"]) == [
        "too_short",
        "",
        "too_short",
        "too_short",
        "too_short|low_alpha_ratio",
    ]
    # Exactly half letters is enough: 20 letters in 40 characters.
    exact = "ab  " * 10
    assert sum(c.isalpha() for c in exact) * 2 == len(exact)
    assert _text(spark, [exact, half]) == ["", "low_alpha_ratio"]


def test_late_words_and_letters_count(spark):
    """The whole text is judged, not its opening."""
    digits = "1 " * 300
    assert _text(spark, [digits + "letters " * 200, digits + "x"]) == ["", "low_alpha_ratio"]


def test_file_rules(spark):
    df = spark.createDataFrame(
        [
            (0, False, False, "", 0, None, None),
            (1, True, False, " ", 3, 0.01, 0.5),
            (2, True, True, "c", 0, 0.009, 0.4),
            (3, True, True, "c", 2, None, 1.0),
            (4, None, None, None, None, None, None),
        ],
        "i int, e boolean, ok boolean, c string, n int, peak double, s double",
    )
    image = quality.mark(df, quality.image_rules(F.col("e"), F.col("ok"), F.col("c")))
    video = quality.mark(df, quality.video_rules(F.col("e"), F.col("n")))
    audio = quality.mark(df, quality.audio_rules(F.col("e"), F.col("peak"), F.col("s")))
    said = lambda d: [r[0] for r in values(d.orderBy("i"), "quality_reason")]
    assert said(image) == ["missing_file", "corrupt_image|empty_caption", "", "", "missing_file"]
    assert said(video) == [
        "missing_file|no_keyframes", "", "no_keyframes", "", "missing_file|no_keyframes",
    ]
    assert said(audio) == ["missing_file", "", "silent_audio|too_short", "corrupt_audio", "missing_file"]


def test_unknown_modality_passes_and_missing_probes_fail(spark):
    kind = "id string, modality string, payload struct<content:string,caption:string,metadata:struct<n_keyframes:int>>"
    df = spark.createDataFrame(
        [("a", "smell", ("", "", (0,))), ("b", "image", ("/x", "c", (0,)))], kind
    )
    got = pairs(quality.quality_gate(df).select("id", "quality_reason"))
    assert got == {"a": "", "b": "missing_file"}


def test_audio_probe(spark):
    df = spark.createDataFrame([([0.0, -0.5, 0.2], 2), ([], 2), (None, 2)], "s array<double>, r int")
    peak, seconds = quality.audio_probe(F.col("s"), F.col("r"))
    assert values(df, peak, seconds) == [(0.5, 1.5), (None, None), (None, None)]


def test_reports(spark):
    df = spark.createDataFrame(
        [("pass", ""), ("fail", "a|b"), ("fail", "b")], "quality_status string, quality_reason string"
    )
    assert tuple(quality.quality_report(df).first()) == (3, 1, 2, 0.333)
    assert pairs(quality.drop_reasons(df)) == {"a": 1, "b": 2}
    assert tuple(quality.quality_report(df.where("false")).first()) == (0, 0, 0, 0.0)


def test_listing_join_keeps_every_row(spark):
    kind = "id string, modality string, payload struct<content:string>"
    df = spark.createDataFrame(
        [("a", "image", ("/x",)), ("b", "image", ("/y",)), ("c", "text", ("/x",)), ("d", "audio", (None,)),
         ("e", None, ("/x",)), ("f", "image", ("",)), ("g", "image", None)], kind
    )
    files = spark.createDataFrame([("/x",), ("/x",)], "path string")
    got = pairs(quality.with_listing(df, files).select("id", "asset_exists"))
    assert got == {"a": True, **dict.fromkeys("bcdefg", False)}


def test_extended_safety_and_contract(spark):
    df = spark.createDataFrame(
        [("1", 1, "text", "same", None), ("2", 2, "text", "same", None), ("3", 3, "text", "a      b", None),
         ("4", 4, "audio", "", 1.0), ("5", 5, "video", "ok", 9999.0), ("6", 6, "text", " ", None)],
        "id string, row int, modality string, t string, d double",
    )
    marked = quality.mark(
        quality.mark_copies(df, ["modality", "t"], "row"),
        quality.extended_rules(F.col("t"), F.col("d"), F.col("is_copy")),
    )
    assert pairs(marked.select("id", "quality_reason")) == {
        "1": "",
        "2": "exact_duplicate",
        "3": "extreme_whitespace",
        "4": "no_transcript",
        "5": "duration_out_of_range",
        "6": "extreme_whitespace|empty_text",
    }
    by = {r.modality: r for r in quality.extended_report(marked).collect()}
    assert (by["text"].rows_in, by["text"].rows_kept, by["text"].duplicate_count) == (4, 1, 1)
    scores = spark.createDataFrame([("1", True), ("1", False), ("2", False)], "id string, unsafe boolean")
    safe = pairs(quality.safety_gate(marked, scores, "id").select("id", "quality_reason"))
    assert safe["1"] == "unsafe" and safe["2"] == "exact_duplicate" and len(safe) == 6
    lic = spark.createDataFrame(
        [("a", "s", "mit"), ("b", "", "mit"), ("c", "s", "unknown"), ("d", None, None)],
        "id string, source string, license string",
    )
    assert pairs(quality.license_contract(lic).select("id", "quality_reason")) == {
        "a": "", "b": "unlabeled", "c": "unlabeled", "d": "unlabeled",
    }


def test_a_listing_is_not_sent_out_whole(spark):
    """Spark guesses a listing made of few rows to be small, however many come of each."""
    made = spark.range(3).select(F.explode(F.sequence(F.lit(1), F.lit(50))).alias("n"), "id")
    path = F.concat_ws("/", "id", "n")
    listing = made.where("n > 10").select(path.alias("path"))
    rows = made.select(F.lit("video").alias("modality"), F.struct(path.alias("content")).alias("payload"))
    found = quality.with_listing(rows, listing)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.groupBy("asset_exists").count().sort("asset_exists").collect() == [(False, 30), (True, 120)]
