"""Registered queries: every operator over the given tables.

``QUERIES[name](spark, folder)`` returns a DataFrame; the same name in
``oracles.SQL`` is the equivalent SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom.functions import paths, text, vectors
from corpusloom.operators import assets, dedup, embed, epochs, quality, reports, search, shards, snapshots, versions
from corpusloom.operators import catalog as cat
from corpusloom.operators.ranking import with_position
from corpusloom.plans import curation, inputs
from corpusloom.session import fresh_path, release, scratch, stage_at, stage_table
from corpusloom.sources import connectors as con
from corpusloom.sources import probe, readers, scan
from corpusloom.streaming import flows

QUERIES = {}
NEAR = 0.3


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _flat(rows: DataFrame, *meta: str) -> DataFrame:
    return rows.select(
        "id",
        "source",
        "modality",
        "content_hash",
        F.col("payload.content").alias("content"),
        F.col("payload.caption").alias("caption"),
        *[F.col(f"payload.metadata.{m}").alias(m) for m in meta],
        "idx",
        "sub_idx",
    )


def _delivered(spark: SparkSession, rows: DataFrame, deliveries: int) -> DataFrame:
    """A stream to which ``rows`` arrive in no order, in so many deliveries. A
    delivery is as many files as bound one by what a task of ``rows`` holds."""
    folder, n = fresh_path(spark, "arrivals"), -(-readers.n_tasks(rows) // deliveries)
    rows.repartition(deliveries * n).write.parquet(folder)
    return flows.arrivals(spark, folder, rows.schema, files_per_batch=n)


# -- sources ---------------------------------------------------------------


@query
def manifest_text(spark: SparkSession, d: str) -> DataFrame:
    return _flat(inputs.manifest(spark, d, "text"), "url", "token_count")


@query
def manifest_image(spark: SparkSession, d: str) -> DataFrame:
    return _flat(
        inputs.manifest(spark, d, "image"), "cocoid", "filename", "split", "all_captions"
    )


@query
def manifest_video(spark: SparkSession, d: str) -> DataFrame:
    rows = con.video_manifest(inputs.raw_videos(spark, d), inputs.VIDEOS, inputs.FRAMES)
    return _flat(rows, "n_keyframes", "category", "keyframe_paths")


@query
def manifest_audio(spark: SparkSession, d: str) -> DataFrame:
    return _flat(
        inputs.manifest(spark, d, "audio"), "sampling_rate", "speaker_id", "chapter_id"
    )


@query
def clip_plan(spark: SparkSession, d: str) -> DataFrame:
    return _flat(
        inputs.manifest(spark, d, "video"),
        "n_keyframes",
        "source_duration_seconds",
        "clip_start_seconds",
        "clip_duration_seconds",
        "content_parent_category",
        "youtube_title",
        "youtube_channel",
    )


@query
def clip_plan_bounded(spark: SparkSession, d: str) -> DataFrame:
    """At most two whole clips per video."""
    rows = con.clip_manifest(
        inputs.raw_clips(spark, d), inputs.CLIPS, inputs.FRAMES, clips_per_video=2
    )
    meta = [F.col(f"payload.metadata.{m}").alias(m) for m in (
        "n_keyframes", "clip_start_seconds", "clip_duration_seconds")]
    return rows.select("id", "sub_idx", *meta)


@query
def segment_plan(spark: SparkSession, d: str) -> DataFrame:
    videos = inputs.raw_clips(spark, d).select("idx", "duration")
    pieces = con.plan_segments(videos, "duration", 10.0)
    return pieces.select("idx", "piece_idx", "piece_start", "piece_seconds")


@query
def frame_plan(spark: SparkSession, d: str) -> DataFrame:
    videos = inputs.raw_clips(spark, d).select("idx", "duration", "fps")
    frames = videos.withColumn("n", F.floor(F.col("duration") * F.col("fps")))
    return con.plan_frames(frames, "n").select("idx", "frame_idx", "frame_no")


@query
def bounded_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = scan.bounded_scan(inputs.raw_text(spark, d), con.text_manifest, limit=100)
    return rows.select("id", "content_hash", "idx")


@query
def bounded_scan_clips(spark: SparkSession, d: str) -> DataFrame:
    def clips(raw: DataFrame) -> DataFrame:
        return con.clip_manifest(raw, inputs.CLIPS, inputs.FRAMES)

    rows = scan.bounded_scan(inputs.raw_clips(spark, d), clips, limit=75, max_scan=120)
    return rows.select("id", "content_hash", "idx", "sub_idx")


@query
def sample_text(spark: SparkSession, d: str) -> DataFrame:
    return scan.sample_text(inputs.raw_text(spark, d), limit=500)


@query
def sample_images(spark: SparkSession, d: str) -> DataFrame:
    raw = inputs.raw_images(spark, d).select(
        "idx", F.element_at("sentences_raw", 1).alias("captions")
    )
    return scan.sample_images(raw, inputs.IMAGES, limit=100)


@query
def source_probe(spark: SparkSession, d: str) -> DataFrame:
    judged = probe.judge_rows(inputs.raw_clips(spark, d), probe.PRESETS["finevideo"])
    return probe.probe_source(judged)


@query
def payload_resolve(spark: SparkSession, d: str) -> DataFrame:
    raw = inputs.raw_videos(spark, d)
    return probe.judge_rows(raw, probe.PRESETS["alexzigma"], F.col("video.path_exists"))


@query
def payload_resolve_audio(spark: SparkSession, d: str) -> DataFrame:
    raw = inputs.raw_audio(spark, d)
    return raw.select("idx", probe.resolve_audio().alias("payload_kind"))


@query
def source_schema(spark: SparkSession, d: str) -> DataFrame:
    return probe.schema_summary(inputs.raw_images(spark, d))


@query
def source_presets(spark: SparkSession, d: str) -> DataFrame:
    """How every preset would judge the same source."""
    raw = inputs.raw_videos(spark, d)
    return probe.probe_presets(raw, probe.PRESETS, F.col("video.path_exists"))


@query
def asset_scan(spark: SparkSession, d: str) -> DataFrame:
    """The pages written out as 64 folders with a file each, then scanned."""
    pages = readers.table(spark, d, "pages").select(
        F.pmod("page_id", F.lit(64)).alias("folder"), "page_id", F.coalesce("html", F.lit("")).alias("html")
    )
    root = fresh_path(spark, "assets")
    ordered = pages.repartition(8, "folder").sortWithinPartitions("folder", "page_id")
    ordered.select("folder", "html").write.partitionBy("folder").text(root)
    files = readers.asset_listing(spark, root, "part-*", with_hash=True)
    return files.select(
        F.regexp_extract("path", "folder=([0-9]+)/[^/]+$", 1).alias("folder"),
        "length",
        "content_hash",
        paths.cas_path("/cas", F.col("content_hash"), paths.suffix(F.col("path"))).alias("dest"),
    )


# -- quality ---------------------------------------------------------------


def _texts(spark: SparkSession, d: str) -> DataFrame:
    rows = readers.table(spark, d, "documents").select("doc_id", "text", "source", "lang")
    return readers.spread(rows)


@query
def quality_text(spark: SparkSession, d: str) -> DataFrame:
    marked = quality.mark(_texts(spark, d), quality.text_rules(F.col("text")))
    return marked.select("doc_id", "quality_status", "quality_reason")


def _of_modality(spark: SparkSession, d: str, modality: str) -> DataFrame:
    rows = inputs.gated(spark, d).where(F.col("modality") == modality)
    return rows.select("id", "quality_status", "quality_reason")


@query
def quality_image(spark: SparkSession, d: str) -> DataFrame:
    return _of_modality(spark, d, "image")


@query
def quality_video(spark: SparkSession, d: str) -> DataFrame:
    return _of_modality(spark, d, "video")


@query
def quality_audio(spark: SparkSession, d: str) -> DataFrame:
    """Stored vectors stand for decoded samples, scaled and at several rates."""
    loud = F.transform("embedding", lambda x: x.cast("double") * F.col("label") / 100)
    rows = inputs.stored_vectors(spark, d).select(
        "vec_id", loud.alias("samples"), (40 + 20 * F.col("label")).alias("rate")
    )
    peak, seconds = quality.audio_probe(F.col("samples"), F.col("rate"))
    rules = quality.audio_rules(F.lit(True), F.col("peak"), F.col("seconds"))
    probed = rows.withColumn("peak", peak).withColumn("seconds", seconds)
    return quality.mark(probed, rules).select("vec_id", "quality_status", "quality_reason")


@query
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    return inputs.gated(spark, d).select("id", "modality", "quality_status", "quality_reason")


@query
def quality_passed(spark: SparkSession, d: str) -> DataFrame:
    return quality.passed(inputs.gated(spark, d)).select("id", "modality")


@query
def quality_report(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_report(inputs.gated(spark, d), ["modality"])


@query
def quality_report_texts(spark: SparkSession, d: str) -> DataFrame:
    marked = quality.mark(_texts(spark, d), quality.text_rules(F.col("text")))
    return quality.quality_report(marked)


@query
def drop_reasons(spark: SparkSession, d: str) -> DataFrame:
    return quality.drop_reasons(inputs.gated(spark, d), ["modality"])


def _extended(spark: SparkSession, d: str) -> DataFrame:
    turns = inputs.raw_audio(spark, d).select(
        F.concat(F.lit("a"), F.col("idx").cast("string")).alias("id"),
        (F.col("idx") * 2 + 1).alias("row"),
        F.lit("audio").alias("modality"),
        "text",
        (F.length("text") / 100).alias("duration_s"),
    )
    docs = _texts(spark, d).select(
        F.concat(F.lit("t"), F.col("doc_id").cast("string")).alias("id"),
        (F.col("doc_id") * 2).alias("row"),
        F.lit("text").alias("modality"),
        "text",
        F.lit(None).cast("double").alias("duration_s"),
    )
    rows = docs.unionByName(turns).withColumn("content_hash", text.content_hash(F.col("text")))
    marked = quality.mark_copies(rows, ["modality", "content_hash"], "row")
    rules = quality.extended_rules(
        F.col("text"), F.col("duration_s"), F.col("is_copy"), 0.16, (0.5, 20.0)
    )
    return quality.mark(marked, rules)


@query
def quality_extended(spark: SparkSession, d: str) -> DataFrame:
    return _extended(spark, d).select("id", "modality", "quality_status", "quality_reason")


@query
def quality_extended_report(spark: SparkSession, d: str) -> DataFrame:
    return quality.extended_report(_extended(spark, d))


@query
def safety_gate(spark: SparkSession, d: str) -> DataFrame:
    marked = quality.mark(_texts(spark, d), quality.text_rules(F.col("text")))
    scores = readers.table(spark, d, "labels").select(
        "doc_id", (F.col("toxic") == 1).alias("unsafe")
    )
    return quality.safety_gate(marked, scores, "doc_id").select(
        "doc_id", "quality_status", "quality_reason"
    )


# -- licences --------------------------------------------------------------


def _sourced(spark: SparkSession, d: str) -> DataFrame:
    made = inputs.all_manifests(spark, d).select("id", "modality", "source")
    videos = con.video_manifest(inputs.raw_videos(spark, d), inputs.VIDEOS, inputs.FRAMES)
    plain = _texts(spark, d).select(
        F.col("doc_id").cast("string").alias("id"), F.lit("text").alias("modality"), "source"
    )
    return made.unionByName(videos.select("id", "modality", "source")).unionByName(plain)


@query
def license_tag(spark: SparkSession, d: str) -> DataFrame:
    return cat.tag_license(_sourced(spark, d))


@query
def license_mix(spark: SparkSession, d: str) -> DataFrame:
    return reports.license_mix(cat.tag_license(_sourced(spark, d)))


@query
def license_contract(spark: SparkSession, d: str) -> DataFrame:
    marked = quality.license_contract(cat.tag_license(_sourced(spark, d)))
    return marked.select("id", "source", "quality_status", "quality_reason")


# -- dedup -----------------------------------------------------------------


@query
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    kept = dedup.exact_dedup(inputs.manifest(spark, d, "text"))
    return kept.select("id", "content_hash")


@query
def near_dup_links(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_dup_links(
        inputs.stored_vectors(spark, d), "vec_id", "embedding", 64, NEAR
    )


@query
def near_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.stored_vectors(spark, d)
    return dedup.near_dedup(rows, "vec_id", "embedding", 64, NEAR).select("vec_id", "label")


@query
def near_dedup_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Every vector decided in distributed rounds, the last few as well."""
    rows = inputs.stored_vectors(spark, d)
    kept = dedup.near_dedup(rows, "vec_id", "embedding", 64, NEAR, tail_rows=0)
    return kept.select("vec_id", "label")


@query
def near_dedup_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The vectors arrive in three deliveries, in order; the stream is started
    again after each and goes on where it was."""
    rows = inputs.stored_vectors(spark, d)
    folder, out = fresh_path(spark, "arrivals"), fresh_path(spark, "kept")
    progress = fresh_path(spark, "progress")
    last = rows.agg(F.max("vec_id")).first()[0]
    edges = [-1, last // 3, last * 2 // 3, last]
    for low, high in zip(edges, edges[1:]):
        part = rows.where((F.col("vec_id") > low) & (F.col("vec_id") <= high))
        part.write.mode("append").parquet(folder)
        stream = flows.arrivals(spark, folder, rows.schema)
        flows.run(
            flows.near_dedup_stream(stream, "vec_id", "embedding", 64, out, NEAR, progress)
        )
    return flows.read_kept(spark, out, 64).select(F.col("pos").alias("vec_id"))


def _curated(spark: SparkSession, d: str):
    rows = stage_table(inputs.embedded(spark, d, "text"), "embedded")
    return curation.curate(rows, vectors.TEXT_DIM)


@query
def curate(spark: SparkSession, d: str) -> DataFrame:
    return _curated(spark, d)[2].select("id", "content_hash")


@query
def dedup_report(spark: SparkSession, d: str) -> DataFrame:
    _, unique, kept = _curated(spark, d)
    return dedup.dedup_report(unique, kept)


# -- vectors ---------------------------------------------------------------


@query
def l2_normalize(spark: SparkSession, d: str) -> DataFrame:
    scaled = F.transform("embedding", lambda x: x.cast("double") * F.col("label"))
    rows = inputs.stored_vectors(spark, d).select("vec_id", scaled.alias("v"))
    unit = vectors.l2_normalize(F.col("v"))
    return rows.select(
        "vec_id",
        F.round(vectors.norm(unit), 6).alias("length"),
        vectors.checksum(unit).alias("vec_checksum"),
    )


@query
def mean_pool(spark: SparkSession, d: str) -> DataFrame:
    pooled = embed.mean_pool(inputs.stored_vectors(spark, d), "label", "embedding")
    return pooled.select(
        "label", "n_vectors", vectors.checksum(F.col("pooled")).alias("vec_checksum")
    )


@query
def vector_project(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.stored_vectors(spark, d)
    small = embed.project(F.col("embedding"), 64, 32, seed=5)
    return rows.select("vec_id", vectors.checksum(small).alias("vec_checksum"))


@query
def embed_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.embedded(spark, d, "text")
    return rows.select(
        "id",
        F.size("embedding").alias("dim"),
        vectors.checksum(F.col("embedding")).alias("vec_checksum"),
    )


@query
def embed_frames(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.embedded(spark, d, "video")
    return rows.select("id", vectors.checksum(F.col("embedding")).alias("vec_checksum"))


@query
def embed_images(spark: SparkSession, d: str) -> DataFrame:
    """Two vector columns: one of the image's file name, one of its caption."""
    rows = inputs.manifest(spark, d, "image").withColumn(
        "image_vector",
        embed.embed_text(F.col("payload.metadata.filename"), inputs.clip_model()),
    )
    both = rows.withColumn(
        "caption_vector", embed.embed_text(F.col("payload.caption"), inputs.clip_model())
    )
    return both.select(
        "id",
        vectors.checksum(F.col("image_vector")).alias("image_checksum"),
        vectors.checksum(F.col("caption_vector")).alias("caption_checksum"),
    )


@query
def embed_cache(spark: SparkSession, d: str) -> DataFrame:
    """English texts were embedded before; the others hold vectors of an
    older model version, which must not be used."""
    texts = inputs.manifest(spark, d, "text")
    langs = readers.table(spark, d, "documents").select(F.col("doc_id").alias("idx"), "lang")
    first = dedup.exact_dedup(texts).join(langs, "idx")
    old = embed.embed_batches(
        first.withColumn("_in", F.col("payload.content")), inputs.text_model(), "_in"
    )
    number = F.when(F.col("lang") == "en", "text_v001").otherwise("text_v000")
    cache = stage_table(
        old.select("content_hash", "embedding", "modality", number.alias("model_version")),
        "cache",
    )
    found, _ = embed.embed_with_cache(texts, cache, inputs.text_model(), "payload.content")
    return found.select(
        "id",
        "model_version",
        "cached",
        vectors.checksum(F.col("embedding")).alias("vec_checksum"),
    )


@query
def embed_cache_stored(spark: SparkSession, d: str) -> DataFrame:
    """Two runs over one stored cache: the second finds everything."""
    texts = inputs.manifest(spark, d, "text")
    path = fresh_path(spark, "vector-cache")
    runs = []
    for number in (1, 2):
        found = embed.embed_through_cache(texts, path, inputs.text_model(), "payload.content")
        counts = found.agg(
            F.lit(number).alias("run"),
            F.count("*").alias("n_rows"),
            F.count_if("cached").alias("n_cached"),
            F.count_if(F.col("embedding").isNull()).alias("n_null"),
        )
        runs.append(stage_table(counts, "cache-run"))
    return runs[0].unionByName(runs[1])


@query
def embed_cache_misses(spark: SparkSession, d: str) -> DataFrame:
    """Cached so far: what the labelled documents hold."""
    texts = inputs.manifest(spark, d, "text")
    labelled = readers.table(spark, d, "labels").select(F.col("doc_id").alias("idx"))
    cache = texts.join(labelled, "idx", "left_semi").select(
        "content_hash", F.lit("text_v001").alias("model_version")
    )
    return embed.cache_misses(texts, cache).select("id", "content_hash", "model_version")


@query
def embed_metrics(spark: SparkSession, d: str) -> DataFrame:
    return embed.embed_metrics(inputs.all_embedded(spark, d))


@query
def feature_enrich(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.manifest(spark, d, "image").select(
        "id", F.col("payload.content").alias("image_path"), F.col("payload.caption").alias("caption")
    )
    enriched = embed.enrich(
        rows, inputs.text_model(), "caption", "caption_minilm_vector", ["id", "image_path", "caption"]
    )
    return enriched.select(
        "id",
        "image_path",
        "caption",
        vectors.checksum(F.col("caption_minilm_vector")).alias("vec_checksum"),
    )


# -- search ----------------------------------------------------------------


def _centroids(spark: SparkSession, d: str) -> DataFrame:
    pooled = embed.mean_pool(inputs.stored_vectors(spark, d), "label", "embedding")
    return pooled.select(F.col("label").alias("query_id"), F.col("pooled").alias("vec"))


@query
def vector_search(spark: SparkSession, d: str) -> DataFrame:
    """The five vectors nearest to the mean of each label, in the whole table."""
    rows = inputs.stored_vectors(spark, d).select(
        F.col("vec_id").alias("id"), F.lit("all").alias("grp"), F.col("embedding").alias("vec")
    )
    asked = _centroids(spark, d).withColumn("grp", F.lit("all"))
    hits = search.nearest(rows, asked, 5)
    return hits.select("query_id", "rank", "id", F.round("distance", 6).alias("distance"))


@query
def vector_search_cosine(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.stored_vectors(spark, d).select(
        F.col("vec_id").alias("id"), F.lit("all").alias("grp"), F.col("embedding").alias("vec")
    )
    asked = _centroids(spark, d).withColumn("grp", F.lit("all"))
    hits = search.nearest(rows, asked, 5, metric="cosine")
    return hits.select("query_id", "rank", "id", F.round("distance", 6).alias("distance"))


@query
def vector_search_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The stored vectors with an even id as queries, in several blocks."""
    rows = inputs.stored_vectors(spark, d).select(
        F.col("vec_id").alias("id"), F.lit("all").alias("grp"), F.col("embedding").alias("vec")
    )
    asked = rows.where("id % 2 = 0").withColumnRenamed("id", "query_id")
    hits = search.nearest(rows, asked, 3, max_queries=64)
    return hits.select("query_id", "rank", "id", F.round("distance", 6).alias("distance"))


@query
def search_groups(spark: SparkSession, d: str) -> DataFrame:
    """The same per label: every mean against every label's own list."""
    rows = inputs.stored_vectors(spark, d).select(
        F.col("vec_id").alias("id"), F.col("label").alias("grp"), F.col("embedding").alias("vec")
    )
    last = rows.agg(F.max("grp")).first()[0]
    asked = _centroids(spark, d).select(
        "query_id", "vec", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("grp")
    )
    hits = search.nearest(rows, asked, 5)
    return hits.select("query_id", "grp", "rank", "id", F.round("distance", 6).alias("distance"))


def _search(spark: SparkSession, d: str) -> DataFrame:
    table = cat.stage_catalog(inputs.catalog(spark, d))
    return search.search_texts(
        table, inputs.probes(spark, d), inputs.text_model(), inputs.clip_model()
    )


@query
def search_isolation(spark: SparkSession, d: str) -> DataFrame:
    """Image queries of a wrong length fail; the other lists stay whole."""
    table = cat.stage_catalog(inputs.catalog(spark, d))
    asked = search.text_queries(inputs.probes(spark, d), inputs.text_model(), inputs.clip_model())
    cut = F.when(F.col("modality") == "image", F.slice("vec", 1, 100)).otherwise(F.col("vec"))
    hits, told = search.search_each(table, stage_table(asked.withColumn("vec", cut), "asked"))
    listed = hits.groupBy("modality").agg(
        F.count("*").alias("listed"), F.round(F.sum("distance"), 4).alias("distances")
    )
    return told.join(listed, "modality", "left").select(
        "modality", "status", "n_hits", F.coalesce("listed", F.lit(0)).alias("listed"), "distances"
    )


@query
def search_all(spark: SparkSession, d: str) -> DataFrame:
    return _search(spark, d).select(
        "query_id",
        "modality",
        "rank",
        "id",
        F.round("distance", 6).alias("distance"),
        "caption",
        "license",
        "quality_status",
        "asset_url",
    )


@query
def search_images(spark: SparkSession, d: str) -> DataFrame:
    """Query texts against the images, in the space they share."""
    rows = inputs.embedded(spark, d, "image").select(
        "id", F.col("modality").alias("grp"), F.col("embedding").alias("vec")
    )
    asked = inputs.probes(spark, d).select(
        "query_id",
        F.lit("image").alias("grp"),
        embed.embed_text(F.col("query"), inputs.clip_model()).alias("vec"),
    )
    hits = search.nearest(rows, asked, 5)
    url = paths.asset_url(F.col("id"), "image")
    return hits.select(
        "query_id", "rank", "id", F.round("distance", 6).alias("distance"), url.alias("image_url")
    )


@query
def retrieval_eval(spark: SparkSession, d: str) -> DataFrame:
    """Probes against all texts and against those that pass the gate; a
    probe expects its words of eight letters or more."""
    model = inputs.text_model()
    words = F.array_distinct(F.split(text.normalize_ws(F.col("query")), " "))
    asked = inputs.probes(spark, d).select(
        "query_id",
        F.lit("text").alias("target_modality"),
        F.filter(words, lambda w: F.length(w) >= 8).alias("expected_terms"),
        embed.embed_text(F.col("query"), model).alias("vec"),
    )
    texts = stage_table(inputs.embedded(spark, d, "text"), "embedded")
    unique = dedup.exact_dedup(texts)
    out = None
    for name, rows in (("v001", texts), ("v002", unique)):
        hits = search.nearest(
            rows.select("id", F.lit("text").alias("grp"), F.col("embedding").alias("vec")),
            asked.select("query_id", F.lit("text").alias("grp"), "vec"),
            5,
        )
        found = search.with_details(hits, texts.select("id", "payload.content"), ["id"]).select(
            F.lit(name).alias("version"),
            "query_id",
            F.col("grp").alias("modality"),
            "rank",
            F.split("content", " ").alias("words"),
            "distance",
        )
        out = found if out is None else out.unionByName(found)
    return reports.retrieval_eval(asked.drop("vec"), out, ["v001", "v002"])


# -- catalog ---------------------------------------------------------------


def _catalog_flat(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id",
        "source",
        "modality",
        "content_hash",
        "quality_status",
        "license",
        "caption",
        "content_path",
        "has_embedding",
        vectors.checksum(F.col("text_vector")).alias("text_checksum"),
        vectors.checksum(F.col("clip_vector")).alias("clip_checksum"),
    )


@query
def catalog_build(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "catalog")
    cat.replace_catalog(inputs.catalog(spark, d), path)
    return _catalog_flat(cat.read_catalog(spark, path))


@query
def catalog_versions(spark: SparkSession, d: str) -> DataFrame:
    """A catalog replaced, appended to and rolled back: rows of every version."""
    path = fresh_path(spark, "catalog")
    rows = cat.stage_catalog(inputs.catalog(spark, d, with_vectors=False))
    cat.replace_catalog(rows.where("modality = 'text'"), path)
    cat.append_catalog(rows.where("modality = 'image'"), path)
    snapshots.replace(
        rows.where("modality = 'audio'").select(*schemas.CATALOG.fieldNames()), path, "modality"
    )
    snapshots.roll_back(spark, path, 2)
    out = None
    for version in snapshots.history(spark, path):
        held = cat.read_catalog(spark, path, version.number)
        counted = held.groupBy("modality").agg(F.count("*").alias("n_rows")).select(
            F.lit(version.number).alias("version"), F.lit(version.action).alias("action"), "modality", "n_rows"
        )
        out = counted if out is None else out.unionByName(counted)
    return out


@query
def catalog_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Fields read back out of the metadata JSON."""
    rows = inputs.catalog(spark, d, with_vectors=False)
    return rows.select(
        "id",
        F.get_json_object("metadata_json", "$.filename").alias("filename"),
        F.get_json_object("metadata_json", "$.n_keyframes").alias("n_keyframes"),
        F.get_json_object("metadata_json", "$.speaker_id").alias("speaker_id"),
    )


@query
def catalog_query(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.catalog(spark, d, with_vectors=False)
    found = cat.query_catalog(rows, ["text"], [con.TEXT_SOURCE], limit=100)
    return found.select("id", "modality", "source", "quality_status")


@query
def catalog_query_cross(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.catalog(spark, d, with_vectors=False)
    found = cat.query_catalog(
        rows, ["image", "video"], status="pass", licenses_in=["cc-by-4.0"], limit=None
    )
    return found.select("id", "modality", "license")


@query
def catalog_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.catalog(spark, d, with_vectors=False)
    return cat.lookup(rows, "coco_000000000007").select("id", "modality", "caption")


@query
def catalog_assets(spark: SparkSession, d: str) -> DataFrame:
    return cat.servable(inputs.catalog(spark, d, with_vectors=False))


@query
def catalog_append(spark: SparkSession, d: str) -> DataFrame:
    """Documents arrive as files and are gated and added as a stream."""
    raw = inputs.raw_text(spark, d)
    out = fresh_path(spark, "catalog")
    stream = _delivered(spark, raw, 3)

    def rows(batch: DataFrame) -> DataFrame:
        marked = quality.mark(
            con.text_manifest(batch), quality.text_rules(F.col("payload.content"))
        )
        return cat.build_catalog(marked)

    flows.run(flows.append_to_catalog(stream, rows, out))
    return flows.read_appended(spark, out).select(
        "id", "modality", "content_hash", "quality_status", "license", "has_embedding"
    )


# -- versions --------------------------------------------------------------


def _items(spark: SparkSession, d: str, name: str = "v001", **choice) -> DataFrame:
    return versions.select_items(inputs.catalog(spark, d, with_vectors=False), name, **choice)


@query
def version_create(spark: SparkSession, d: str) -> DataFrame:
    root = fresh_path(spark, "versions")
    table = inputs.catalog(spark, d, with_vectors=False)
    versions.create_version(table, root, "v001")
    items = versions.load_version(spark, root, "v001")
    return items.select("version", "pos", "id", "modality", "content_hash")


@query
def version_limited(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d, limit_per_modality=50, modalities=["audio", "text"])
    return items.select("pos", "id", "modality")


@query
def version_inputs(spark: SparkSession, d: str) -> DataFrame:
    """What a version pins of the manifests it was made from."""
    root = fresh_path(spark, "versions")
    made = {m: inputs.manifest(spark, d, m).select("id", "content_hash") for m in schemas.MODALITIES}
    table = inputs.catalog(spark, d, with_vectors=False).where("modality = 'text'")
    header = versions.create_version(table, root, "v001", ["text"], inputs=made)
    held = "map<string,struct<rows:bigint,fingerprint:string>>"
    pinned = F.from_json(F.get_json_object("config", "$.inputs"), held)
    return header.select(F.explode(pinned).alias("input", "held")).select(
        "input", F.col("held.rows").alias("n_rows"), F.col("held.fingerprint").alias("fingerprint")
    )


@query
def version_list(spark: SparkSession, d: str) -> DataFrame:
    root = fresh_path(spark, "versions")
    table = cat.stage_catalog(inputs.catalog(spark, d, with_vectors=False))
    versions.create_version(table, root, "v001", quality_filter=False)
    versions.create_version(table, root, "v002")
    heads = versions.read_header(spark, root, "v001").unionByName(
        versions.read_header(spark, root, "v002")
    )
    names = versions.list_versions(spark, root)
    return names.join(heads, "version").select(
        "version",
        "total_items",
        *[F.col(f"modalities.{m}").alias(f"n_{m}") for m in schemas.MODALITIES],
    )


@query
def version_counts(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d, modalities=["text", "audio"])
    return versions.modality_counts(items, schemas.MODALITIES)


def _two(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    table = cat.stage_catalog(inputs.catalog(spark, d, with_vectors=False))
    every = versions.select_items(table, "v001", quality_filter=False, modalities=["text", "image"])
    return every, versions.select_items(table, "v002")


@query
def version_compare(spark: SparkSession, d: str) -> DataFrame:
    return versions.compare_versions(*_two(spark, d))


@query
def version_report(spark: SparkSession, d: str) -> DataFrame:
    """What two versions hold and leave out of the catalog they were cut from."""
    table = cat.stage_catalog(inputs.catalog(spark, d, with_vectors=False))
    a = versions.select_items(table, "a", modalities=["text", "image"], quality_filter=False)
    b = versions.select_items(table, "b")
    return versions.compare_reports(a, b, table)


@query
def version_diff(spark: SparkSession, d: str) -> DataFrame:
    return versions.diff_versions(*_two(spark, d))


@query
def version_takedown(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d, "v002", exclude_sources=[con.IMAGE_SOURCE, con.AUDIO_SOURCE])
    return items.select("version", "pos", "id")


@query
def train_eval_split(spark: SparkSession, d: str) -> DataFrame:
    split = versions.train_eval_split(inputs.all_manifests(spark, d))
    return split.select("id", "modality", "split")


@query
def split_report(spark: SparkSession, d: str) -> DataFrame:
    return versions.split_report(versions.train_eval_split(inputs.all_manifests(spark, d)))


@query
def epoch_order(spark: SparkSession, d: str) -> DataFrame:
    return versions.epoch_order(inputs.all_manifests(spark, d), seed=7, epoch=1)


@query
def epoch_shards(spark: SparkSession, d: str) -> DataFrame:
    """The second half of an epoch over the text manifest, without a sort."""
    rows = inputs.manifest(spark, d, "text").select("id", F.col("idx").alias("pos"))
    n = rows.agg(F.max("pos")).first()[0] + 1
    placed = epochs.epoch_rows(rows, n, 64, seed=7, epoch=2, resume_at=n // 2)
    return placed.select("id", "shard_idx", "epoch_pos")


@query
def epoch_resume(spark: SparkSession, d: str) -> DataFrame:
    return versions.epoch_order(inputs.manifest(spark, d, "text"), 7, 2, resume_at=100)


@query
def datasheet(spark: SparkSession, d: str) -> DataFrame:
    root = fresh_path(spark, "versions")
    table = cat.stage_catalog(inputs.catalog(spark, d, with_vectors=False))
    header = versions.create_version(table, root, "v001", config={"clip_seconds": 8.0})
    items = versions.load_version(spark, root, "v001")
    return reports.datasheet(header, items, table)


# -- shards and assets -----------------------------------------------------


def _plan(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All rows are in the version; the catalog lost the failing ones since."""
    rows, files = inputs.catalog_and_listing(spark, d, with_vectors=False)
    table = cat.stage_catalog(rows)
    items = stage_table(versions.select_items(table, "v001", quality_filter=False), "items")
    present = table.where("quality_status = 'pass'")
    return items, shards.plan_members(items, present, 100, files)


@query
def shard_plan(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d)[1].select(
        "shard_idx", "pos", "id", "modality", "caption", "license", "asset", "text"
    )


@query
def shard_manifest(spark: SparkSession, d: str) -> DataFrame:
    items, members = _plan(spark, d)
    return shards.shard_manifest(items, members, 100)


@query
def shard_scan(spark: SparkSession, d: str) -> DataFrame:
    """Passing rows written as tar shards and read back: items, and from their
    records a checksum and the bytes of text."""
    path = fresh_path(spark, "shards")
    with scratch(spark) as kept:
        # The archives take the disk: what led to their members goes before them.
        with scratch(spark):
            every = cat.stage_catalog(inputs.catalog(spark, d, with_vectors=False))
            table = every.where("quality_status = 'pass'")
            items = versions.select_items(table, "v001")
            members = shards.plan_members(items, table, 500, None, f"{kept}/members")
            places = stage_at(items.select("pos"), f"{kept}/places")
        release(spark)
        shards.write_shards(members, path, places, None, 500)
    members = shards.read_shards(spark, path).where(F.col("name").endswith(".json"))
    kind = "id string, modality string, caption string, license string, text string"
    record = members.select("shard", F.from_json("json", kind).alias("r")).select("shard", "r.*")
    said = F.concat_ws("|", "id", "modality", "caption", "license", "text")
    mark = F.conv(F.substring(F.md5(said), 1, 8), 16, 10).cast("bigint")
    return record.groupBy("shard").agg(
        F.count("*").alias("items"),
        F.sum(mark).alias("checksum"),
        F.sum(F.octet_length("text")).alias("text_bytes"),
    )


@query
def cas_layout(spark: SparkSession, d: str) -> DataFrame:
    return assets.cas_layout(inputs.all_manifests(spark, d), "/cas")


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """The store holds the audio and the clips, no image yet."""
    layout = assets.cas_layout(inputs.all_manifests(spark, d), "/cas")
    held = layout.where(~F.col("src").startswith(inputs.IMAGES))
    return held.select(F.col("dest").alias("path")).distinct()


@query
def cas_missing(spark: SparkSession, d: str) -> DataFrame:
    layout = assets.cas_layout(inputs.all_manifests(spark, d), "/cas")
    return assets.cas_missing(layout, _stored(spark, d)).select("dest", "id")


@query
def cas_get(spark: SparkSession, d: str) -> DataFrame:
    layout = assets.cas_layout(inputs.all_manifests(spark, d), "/cas")
    return assets.cas_get(layout, _stored(spark, d)).select("id", "stored")


@query
def cas_gc(spark: SparkSession, d: str) -> DataFrame:
    held = readers.stored_hashes(_stored(spark, d)).select("content_hash", "ext")
    return assets.cas_garbage(held, _items(spark, d))


@query
def precompute_plan(spark: SparkSession, d: str) -> DataFrame:
    layout = assets.cas_layout(inputs.manifest(spark, d, "image"), "/cas")
    files = layout.select(F.col("dest").alias("path"))
    return assets.plan_precompute(files, "/cas", "/precomputed")


# -- runs and monitors -----------------------------------------------------


@query
def artifact_status(spark: SparkSession, d: str) -> DataFrame:
    at = curation.Layout(fresh_path(spark, "run"))
    cat.publish(inputs.manifest(spark, d, "image"), at.manifest("image"))
    cat.publish(inputs.manifest(spark, d, "audio"), at.manifest("audio"))
    cat.publish(inputs.embedded(spark, d, "image"), at.embedded("image"))
    named = {f"{m}_manifest": at.manifest(m) for m in schemas.MODALITIES}
    named |= {f"{m}_embedded": at.embedded(m) for m in schemas.MODALITIES}
    return curation.artifact_status(spark, named)


@query
def artifact_resume(spark: SparkSession, d: str) -> DataFrame:
    """Two stages, twice: the second time nothing is left to do."""
    run = curation.Run(
        spark,
        curation.Layout(fresh_path(spark, "run")),
        {m: lambda m=m: inputs.manifest(spark, d, m) for m in ("image", "audio")},
    )
    rows = []
    for attempt in (1, 2):
        for stage in ("connectors", "embed"):
            for done in curation.resume(run, stage):
                rows.append(
                    (
                        attempt,
                        done["stage"],
                        done["modality"],
                        done["status"],
                        done.get("reason", ""),
                        done["rows"],
                    )
                )
    kind = "attempt int, stage string, modality string, status string, reason string, n_rows bigint"
    return spark.createDataFrame(rows, kind)


@query
def job_status(spark: SparkSession, d: str) -> DataFrame:
    states = {
        "signup": "pending",
        "view": "running",
        "click": "running",
        "purchase": "succeeded",
        "error": "failed",
    }
    state = F.lit(None)
    for event, name in states.items():
        state = F.when(F.col("event_type") == event, name).otherwise(state)
    key = reports.idempotency_key(
        F.col("user_id").cast("string"),
        F.lit("text_v001"),
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")),
    )
    attempts = readers.table(spark, d, "events").select(
        key.alias("job_key"), "ts", F.col("event_id").alias("seq"), state.alias("state")
    )
    return reports.job_status(attempts, max_retries=1)


@query
def drift_monitor(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.catalog(spark, d)
    vec = search.route_vector(F.col("modality"), F.col("text_vector"), F.col("clip_vector"))
    return reports.drift_monitor(rows, vec)


@query
def copy_rate(spark: SparkSession, d: str) -> DataFrame:
    return reports.copy_rate(inputs.all_manifests(spark, d))


@query
def freshness(spark: SparkSession, d: str) -> DataFrame:
    """Events arrive in four deliveries, one batch each, in no order of time."""
    events = readers.table(spark, d, "events")
    out = fresh_path(spark, "windows")
    stream = _delivered(spark, events, 4)
    flows.run(flows.window_counts(stream, "ts", out, "1 day", [F.col("event_type")]))
    return flows.read_windows(spark, out, ["event_type"]).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"),
        "event_type",
        "n_rows",
        F.date_format("newest", "yyyy-MM-dd HH:mm:ss").alias("newest"),
    )


@query
def stream_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Documents arrive in three deliveries, in no order."""
    raw = inputs.raw_text(spark, d)
    out = fresh_path(spark, "firsts")
    stream = _delivered(spark, raw, 3)
    flows.run(flows.first_by_hash(con.text_manifest(stream), out))
    return flows.read_firsts(spark, out)


@query
def position_rank(spark: SparkSession, d: str) -> DataFrame:
    turns = readers.table(spark, d, "conversations").select("conv_id", "turn")
    return with_position(turns, "conv_id", "turn").select("conv_id", "turn", "pos")
