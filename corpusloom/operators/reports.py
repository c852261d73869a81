"""Reports: retrieval quality, mixes, drift, datasheet and job state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import vectors


def license_mix(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("license", "modality").agg(F.count("*").alias("n_items"))


def keyword_overlap(terms: Column, words: Column) -> Column:
    """Share of the expected terms that occur among the words."""
    hits = F.size(F.array_intersect(terms, words))
    return F.when(F.size(terms) > 0, hits / F.size(terms)).otherwise(F.lit(0.0))


def retrieval_eval(probes: DataFrame, hits: DataFrame, versions: list[str]) -> DataFrame:
    """Retrieval quality per version and modality.

    ``probes``: ``query_id, target_modality, expected_terms``. ``hits``:
    ``version, query_id, modality, rank, words, distance`` for the top k.
    Every probe is due in each of the named ``versions``; one that found
    nothing there counts as empty.
    """
    asked = probes.select(
        "query_id", F.col("target_modality").alias("modality"), "expected_terms"
    )
    scored = hits.join(asked, ["query_id", "modality"]).withColumn(
        "overlap", keyword_overlap(F.col("expected_terms"), F.col("words"))
    )
    per_query = scored.groupBy("version", "modality", "query_id").agg(
        F.max((F.col("overlap") > 0).cast("int")).alias("hit"),
        F.avg("overlap").alias("overlap"),
        F.avg("distance").alias("distance"),
    )
    due = asked.select(
        "query_id", "modality", F.explode(F.array(*[F.lit(v) for v in versions])).alias("version")
    )
    every = due.join(per_query, ["version", "modality", "query_id"], "left")
    return every.groupBy("version", "modality").agg(
        F.count("*").alias("query_count"),
        F.round(F.avg(F.coalesce("hit", F.lit(0))), 6).alias("hit_rate_at_5"),
        F.round(F.avg(F.coalesce("overlap", F.lit(0.0))), 6).alias("mean_keyword_overlap_at_5"),
        F.round(F.avg("distance"), 6).alias("mean_distance_at_5"),
        F.count_if(F.col("hit").isNull()).alias("empty_result_count"),
    )


def drift_monitor(catalog: DataFrame, vec: Column | None = None) -> DataFrame:
    """``metric, key, n, share`` for the modality, source, licence and status
    mixes and the histogram of vector lengths.

    One scan: every row is expanded to its metrics, which the partial
    aggregation reduces again before anything is shuffled.
    """
    facts = [
        F.struct(F.lit("modality").alias("metric"), F.col("modality").alias("key")),
        F.struct(F.lit("source").alias("metric"), F.col("source").alias("key")),
        F.struct(F.lit("license").alias("metric"), F.col("license").alias("key")),
        F.struct(F.lit("quality_status").alias("metric"), F.col("quality_status").alias("key")),
    ]
    if vec is not None:
        tenth = F.floor(F.round(vectors.norm(vec), 6) * 10) / 10
        facts.append(
            F.struct(F.lit("norm").alias("metric"), F.format_number(tenth, 1).alias("key"))
        )
    counts = (
        catalog.select(F.inline(F.array(*facts)))
        .groupBy("metric", "key")
        .agg(F.count("*").alias("n"))
    )
    # The counts are few; a window over them spares a second pass over the rows.
    total = F.sum("n").over(W.partitionBy("metric"))
    return counts.withColumn("share", F.round(F.col("n") / total, 6))


def copy_rate(manifest: DataFrame) -> DataFrame:
    """Rows, distinct contents and the share of copies per modality."""
    per_hash = manifest.groupBy("modality", "content_hash").agg(F.count("*").alias("n"))
    return per_hash.groupBy("modality").agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_distinct"),
        F.round((F.sum("n") - F.count("*")) / F.sum("n"), 6).alias("copy_rate"),
    )


def datasheet(header: DataFrame, items: DataFrame, catalog: DataFrame) -> DataFrame:
    """``section, name, value`` lines of a version's datasheet."""
    members = items.select("id").join(
        catalog.select("id", "modality", "source", "license", "quality_status"),
        "id",
    )
    facts = F.array(
        *[
            F.struct(F.lit(c).alias("section"), F.col(c).alias("name"))
            for c in ("modality", "source", "license", "quality_status")
        ]
    )
    counted = (
        members.select(F.inline(facts))
        .groupBy("section", "name")
        .agg(F.count("*").cast("string").alias("value"))
    )
    models = F.from_json(F.to_json("models"), "map<string,string>")
    fixed = [
        header.select(
            F.lit("version").alias("section"), F.col("version").alias("name"),
            F.col("total_items").cast("string").alias("value"),
        ),
        header.select(
            F.lit("transforms").alias("section"), F.lit("config").alias("name"),
            F.col("config").alias("value"),
        ),
        header.select(F.explode(models).alias("name", "value")).select(
            F.lit("model").alias("section"), "name", "value"
        ),
    ]
    return reduce(DataFrame.unionByName, fixed, counted)


def save_report(report: DataFrame, path: str) -> None:
    """A report as JSON lines beside, never over, the data it describes."""
    report.write.mode("overwrite").json(path)


def as_markdown(sheet: DataFrame) -> DataFrame:
    """The datasheet as lines of text; it has a few dozen of them."""
    return sheet.orderBy("section", "name").select(
        F.format_string("- %s / %s: %s", "section", "name", "value").alias("value")
    )


STATES = ("pending", "running", "succeeded", "failed")


def job_status(attempts: DataFrame, max_retries: int = 3) -> DataFrame:
    """State of every job from its attempt log ``job_key, ts, seq, state``.

    The latest attempt decides; a failed job that has used up its retries is
    a dead letter. The first aggregate has one row per job and timestamp, the
    second one per job; numbers and positions of states are all they hold, so
    both hash and are reduced before the shuffle. A state that is not one of
    ``STATES`` counts as an attempt of unknown state.
    """
    known = F.array(*[F.lit(s) for s in STATES])
    place = F.array_position(known, F.col("state"))
    # Later ones win: by time, then by sequence number.
    per_time = attempts.groupBy("job_key", "ts").agg(
        F.max_by(place, F.col("seq")).alias("state"),
        F.count("*").alias("attempts"),
        F.count_if(F.col("state") == "failed").alias("failures"),
    )
    per_job = per_time.groupBy("job_key").agg(
        F.max_by("state", "ts").alias("state"),
        F.sum("attempts").alias("attempts"),
        F.sum("failures").alias("failures"),
    )
    last = F.get(known, F.col("state").cast("int") - 1)
    dead = (last == "failed") & (F.col("failures") > max_retries)
    return per_job.select(
        "job_key",
        F.when(dead, "dead_letter").otherwise(last).alias("state"),
        "attempts",
        "failures",
    )


def idempotency_key(content_hash: Column, model: Column, transform: Column) -> Column:
    """Key under which repeating a job is recognised."""
    return F.sha2(F.concat_ws("|", content_hash, model, transform), 256)
