import hashlib
import random

from pyspark.sql import functions as F

from corpusloom.functions import licenses, paths, text
from conftest import values

TRICKY = [
    "a b　c",
    "x\x1cy",
    "a\x85b",
    "",
    "   ",
    " \t lead and trail \n",
    "ünïcödé Straße naïve",
    "日本語 テキスト 123",
    "emoji 😀 text 𝔘nicode",
    "a  b   c d",
    "١٢٣ ab",
    "ⅷ ª º ʰ",
]


def _column(spark, rows):
    return spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "i int, s string")


def _random_texts(n):
    rng = random.Random(1)
    alphabet = "ab é\n\t 中 \x1c\x1f😀1"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_normalize_and_counts_equal_python(spark):
    rows = TRICKY + _random_texts(300)
    df = _column(spark, rows)
    n = text.normalize_ws(F.col("s"))
    got = df.select(
        "i",
        n.alias("n"),
        text.word_count(n).alias("w"),
        text.letter_count(F.col("s")).alias("letters"),
        text.alpha_ratio(F.col("s")).alias("ratio"),
        text.content_hash(n).alias("h"),
        text.truncate(F.col("s"), 7).alias("cut"),
        *[text.at_least_words(F.col("s"), k).alias(f"has{k}") for k in (0, 1, 2, 5)],
    ).orderBy("i")
    for s, r in zip(rows, got.collect()):
        joined = " ".join(s.split())
        assert r.n == joined
        assert r.w == len(joined.split())
        assert r.letters == sum(c.isalpha() for c in s)
        assert r.h == hashlib.sha256(joined.encode()).hexdigest()
        assert r.cut == s[:7]
        assert (r.ratio is None) == (s == "")
        for k in (0, 1, 2, 5):
            assert r[f"has{k}"] == (len(s.split()) >= k)


def test_word_count_ignores_the_space_a_cut_leaves(spark):
    df = _column(spark, ["ab cd ef"])
    cut = text.truncate(F.col("s"), 6)
    row = df.select(cut.alias("c"), text.word_count(cut).alias("w")).first()
    assert (row.c, row.w) == ("ab cd ", 2)


def test_compact_ids_and_defaults(spark):
    df = spark.createDataFrame([("x" * 200, 7, 0), ("short", 12, None)], "s string, n bigint, z int")
    rows = values(
        df,
        text.compact(F.col("s")),
        text.padded_id("coco_", 12, F.col("n")),
        text.int_or(F.col("z"), F.lit(5)),
    )
    assert rows[0] == ("x" * 157 + "...", "coco_000000000007", 5)
    assert rows[1] == ("short", "coco_000000000012", 5)


def test_lists_and_first_present(spark):
    df = spark.createDataFrame([([" a ", "", " "], "", "b")], "l array<string>, p string, q string")
    row = df.select(
        text.clean_list(F.col("l")).alias("l"),
        text.first_nonempty(F.col("p"), F.col("q")).alias("f"),
        text.first_nonempty(F.col("p"), F.lit(None)).alias("e"),
    ).first()
    assert (row.l, row.f, row.e) == (["a"], "b", "")


def test_paths(spark):
    df = _column(spark, ["/a/b/x.JPG", "/a.b/noext", "clip.mp4", "", "/d/.hidden"])
    got = values(df, paths.suffix(F.col("s")), paths.media_type(F.col("s")))
    assert got[0] == (".JPG", "image/jpeg")
    assert got[1] == ("", "application/octet-stream")
    assert got[2] == (".mp4", "video/mp4")
    h = "ab12" + "0" * 60
    one = spark.range(1).select(paths.cas_path("/cas/", F.lit(h), F.lit(".jpg"))).first()[0]
    assert one == f"/cas/ab/12/{h}.jpg"


def test_manifest_names(spark):
    df = _column(
        spark,
        ["/x/fineweb_edu_manifest.parquet", "coco_captions_filtered.parquet", "msrvtt_manifest", "other.parquet"],
    )
    assert [r[0] for r in values(df, paths.manifest_modality(F.col("s")))] == [
        "text",
        "image",
        "video",
        "other",
    ]


def test_licenses(spark):
    df = spark.createDataFrame(
        [
            ("HuggingFaceFW/fineweb-edu/sample-10BT", None),
            ("AlexZigma/msr-vtt", None),
            ("x", None),
            ("x", "own"),
            ("HuggingFaceFV/other", None),
        ],
        "source string, license string",
    )
    got = [r[0] for r in values(df, licenses.license_of(F.col("source"), F.col("license")))]
    assert got == ["mit", "research-only", "unknown", "own", "cc-by-4.0"]


def test_valid_ids(spark):
    df = _column(spark, ["coco_000000000001", "a-b", "a/b", "", "a\n"])
    assert [r[0] for r in values(df, paths.valid_id(F.col("s")))][:4] == [True, True, False, False]
