"""A training-data pipeline over ``documents``: five stages, each written as
Parquet and read again as the next one's input.

1. quality: documents that the classifier predicts as bad go.
2. near_dedup: of each group of near copies (Jaccard similarity of five-word
   shingles 0.8 or more; 384-bit fingerprints choose what is compared) one
   document stays.
3. secrets: documents with a live-looking, owner-specific credential go.
4. mixing: sources are cut to target weights, nothing is repeated.
5. packing: what is left becomes sequences of token ids.

Stages keep every column of their input but the last, which returns pieces.
Rows are named by file and place, so null and repeated ids are decided row by
row. An empty table goes through all stages and gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import mixing, packing, quality, queries, secrets, simhash
from corpusloom.llm.rows import lasting, without
from corpusloom.session import fresh_path, release, ship_package, stage_table

# The share of the tokens that the mix keeps.
SHARE = 0.9


def _begin(spark: SparkSession) -> None:
    """A stage begins without what the one before left in the driver."""
    ship_package(spark)
    release(spark)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored good, empty and null texts by their own score; without
    labels see ``quality.fit``."""
    _begin(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.score(model) >= quality.CUT)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one of the smallest id."""
    _begin(spark)
    docs = lasting(docs)
    found = simhash.near_dedup(docs, scheme=simhash.SIMILAR)
    gone = stage_table(simhash.repeats(found), "near-copies")
    return without(docs, gone)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a live-looking credential; null and empty texts stay."""
    _begin(spark)
    docs = lasting(docs)
    found = secrets.scan(docs, F.col("source"), F.concat_ws("/", "source", "lang"))
    return without(docs, stage_table(secrets.leaking(found), "leaking"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes tokens from; texts without words go."""
    _begin(spark)
    return mixing.select_documents(
        docs, queries.mix_levels(), queries.WEIGHTS, share=SHARE, max_epochs=1
    )


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents; a null text is one piece of one id."""
    _begin(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# SQL has no SimHash, no dictionary compression and no byte-pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all sequences of ``documents``."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
