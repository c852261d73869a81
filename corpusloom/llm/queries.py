"""One query per operator over the given tables; each returns its whole result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    lexical,
    licenses,
    mixing,
    packing,
    quality,
    quality_rules,
    secrets,
    simhash,
    token_counts,
    topk,
    vectors_dedup,
    warc,
    whitening,
)
from corpusloom.session import fresh_path, ship_package

# Parts of a domain in the mix; sources stand in four domains by their number.
DOMAINS = 4
WEIGHTS = {
    ("domain0",): 40,
    ("domain1",): 30,
    ("domain2",): 20,
    ("domain3",): 10,
    **{(f"domain{d}", "en"): 6 for d in range(DOMAINS)},
    **{(f"domain{d}", "de"): 2 for d in range(DOMAINS)},
    **{(f"domain{d}", "fr"): 2 for d in range(DOMAINS)},
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def domain() -> Column:
    """By the number at the end of the source's name, 0 without one."""
    number = F.regexp_extract("source", "([0-9]{1,9})$", 1).try_cast("int")
    place = F.pmod(F.coalesce(number, F.lit(0)), F.lit(DOMAINS))
    return F.concat(F.lit("domain"), place.cast("string"))


def mix_levels() -> dict[str, Column]:
    return {"domain": domain(), "lang": F.col("lang"), "source": F.col("source")}


def op1_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.classify(docs, model)


def op2_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    repository = F.concat_ws("/", "source", "lang")
    docs = table(spark, folder, "documents")
    return secrets.scan(docs, F.col("source"), repository).drop(*secrets.ROW)


def op3_vector_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors_dedup.near_dedup(table(spark, folder, "embeddings"))


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), mix_levels(), WEIGHTS)
    return mixed.drop(*mixing.ROW)


def op5_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    path = fresh_path(spark, "warc")
    warc.write(pages, path)
    kind = pages.schema["page_id"].dataType
    back = warc.read_pages(spark, path)
    return back.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_dedup(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.hex("fp")).alias("fingerprint"),
        "component_id",
    )


def op7_packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op8_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op11_whitened_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_scores,
        op2_secret_spans,
        op3_vector_near_dedup,
        op4_source_mix,
        op5_warc_round_trip,
        op6_simhash_near_dedup,
        op7_packed_sequences,
        op8_exact_top_k,
        op9_token_counts,
        op10_license_scan,
        op11_whitened_vectors,
        op12_quality_rules,
        op13_ranked_search,
    )
}
