"""Rule gate: mark every row pass or fail with its reasons, drop nothing.

All rules of all modalities are one projection. What needs file access (does
the asset exist, does it decode, how loud, how long) arrives as probe columns:

    asset_exists, asset_ok   boolean     peak, duration_s   double

``with_listing`` supplies the first; decoders supply the rest. What was not
probed counts against the row, so a table of texts needs no probe columns and
a table of files fails until it has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text

MIN_WORDS = 10
MIN_ALPHA = 0.5
MIN_PEAK = 0.01
MIN_SECONDS = 0.5


def _when(failed: Column, reason: str) -> Column:
    return F.when(F.coalesce(failed, F.lit(False)), F.lit(reason))


def text_rules(body: Column) -> list[Column]:
    """Reasons against a text, judged as a whole."""
    raw = F.coalesce(body, F.lit(""))
    return [
        _when(~text.at_least_words(raw, MIN_WORDS), "too_short"),
        _when(text.alpha_ratio(raw) < MIN_ALPHA, "low_alpha_ratio"),
    ]


def image_rules(exists: Column, ok: Column, caption: Column) -> list[Column]:
    """A missing file hides the other reasons."""
    there = F.coalesce(exists, F.lit(False))
    return [
        _when(~there, "missing_file"),
        _when(there & ~F.coalesce(ok, F.lit(False)), "corrupt_image"),
        _when(there & (text.normalize_ws(caption) == ""), "empty_caption"),
    ]


def video_rules(exists: Column, n_frames: Column) -> list[Column]:
    """Both reasons may apply."""
    return [
        _when(~F.coalesce(exists, F.lit(False)), "missing_file"),
        _when(F.coalesce(n_frames, F.lit(0)) == 0, "no_keyframes"),
    ]


def audio_rules(exists: Column, peak: Column, duration_s: Column) -> list[Column]:
    """A file whose samples could not be read has no peak or no duration."""
    there = F.coalesce(exists, F.lit(False))
    unread = peak.isNull() | duration_s.isNull()
    return [
        _when(~there, "missing_file"),
        _when(there & ~unread & (peak < MIN_PEAK), "silent_audio"),
        _when(there & ~unread & (duration_s < MIN_SECONDS), "too_short"),
        _when(there & unread, "corrupt_audio"),
    ]


def audio_probe(samples: Column, rate: Column) -> tuple[Column, Column]:
    """``(peak, seconds)`` of decoded samples; null when there are none."""
    readable = (F.size(samples) > 0) & (rate > 0)
    loudest = F.array_max(F.transform(samples.cast("array<double>"), F.abs))
    return F.when(readable, loudest), F.when(readable, F.size(samples) / rate)


def mark(df: DataFrame, reasons: list[Column] | Column) -> DataFrame:
    """Add ``quality_status`` and the pipe-joined ``quality_reason``."""
    found = F.array(*reasons) if isinstance(reasons, list) else reasons
    joined = F.concat_ws("|", F.array_compact(found))
    return df.withColumn("quality_reason", joined).withColumn(
        "quality_status",
        F.when(F.col("quality_reason") == "", F.lit("pass")).otherwise(F.lit("fail")),
    )


def quality_gate(manifest: DataFrame, text_col: str = "payload.content") -> DataFrame:
    """Gate every row by the rules of its modality; unknown ones pass.

    ``text_col`` is what the text rules read: the whole content by default,
    ``payload.caption`` to judge texts by their opening alone.
    """

    def fact(name: str, kind: str) -> Column:
        return F.col(name) if name in manifest.columns else F.lit(None).cast(kind)

    exists, decodes = fact("asset_exists", "boolean"), fact("asset_ok", "boolean")
    peak, seconds = fact("peak", "double"), fact("duration_s", "double")
    rules = {
        "text": text_rules(F.col(text_col)),
        "image": image_rules(exists, decodes, F.col("payload.caption")),
        "video": video_rules(exists, F.col("payload.metadata.n_keyframes")),
        "audio": audio_rules(exists, peak, seconds),
    }
    found = F.array().cast("array<string>")
    for modality, reasons in rules.items():
        found = F.when(F.col("modality") == modality, F.array(*reasons)).otherwise(found)
    return mark(manifest, found)


def with_listing(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Add ``asset_exists`` by looking the content path up in a listing.

    Inline texts have no file and are long, so only rows that name a file take
    part in the join; those without a path would all meet in one task. Every
    row is in exactly one half, also with a null modality or path. A listing grows
    with the files and is never sent out whole: of one that is made of clips, Spark
    guesses the size of the videos.
    """
    content = F.col("payload.content")
    named = (F.col("modality") != "text") & (content != "")
    has_file = F.coalesce(named, F.lit(False))
    files = listing.select(F.col("path").alias("_path")).distinct().hint("merge")
    inline = manifest.where(~has_file).withColumn("asset_exists", F.lit(False))
    backed = manifest.where(has_file).join(
        files, F.col("payload.content") == F.col("_path"), "left"
    )
    found = backed.withColumn("asset_exists", F.col("_path").isNotNull()).drop("_path")
    return found.unionByName(inline)


def passed(gated: DataFrame) -> DataFrame:
    return gated.where(F.col("quality_status") == "pass")


def quality_report(gated: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals and pass rate, per ``by`` columns if given."""
    ok = F.col("quality_status") == "pass"
    rate = F.when(
        F.col("total") > 0, F.round(F.col("passed") / F.col("total"), 3)
    ).otherwise(F.lit(0.0))
    totals = gated.groupBy(*(by or [])).agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("passed"),
        F.count_if(F.col("quality_status") == "fail").alias("failed"),
    )
    return totals.withColumn("pass_rate", rate)


def drop_reasons(gated: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How often each reason occurs among the failed rows."""
    single = gated.where(F.col("quality_status") == "fail").withColumn(
        "reason", F.explode(F.split("quality_reason", r"\|"))
    )
    return single.groupBy(*(by or []), "reason").agg(F.count("*").alias("n"))


def extended_rules(
    body: Column,
    duration_s: Column,
    is_copy: Column,
    max_space_share: float = 0.5,
    duration_range: tuple[float, float] = (0.5, 3600.0),
) -> list[Column]:
    """Further drop rules: a copy of an earlier row, mostly whitespace, a
    clip outside the wanted duration, no transcript."""
    raw = F.coalesce(body, F.lit(""))
    visible = F.length(F.regexp_replace(raw, "(?U)[\\s\\x1c-\\x1f]+", ""))
    share = 1 - visible / F.length(raw)
    low, high = duration_range
    modality = F.col("modality")
    timed = modality.isin("video", "audio")
    return [
        _when(is_copy, "exact_duplicate"),
        _when((F.length(raw) > 0) & (share > max_space_share), "extreme_whitespace"),
        _when(timed & ((duration_s < low) | (duration_s > high)), "duration_out_of_range"),
        _when((modality == "audio") & (visible == 0), "no_transcript"),
        _when((modality != "audio") & (visible == 0), "empty_text"),
    ]


def mark_copies(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add ``is_copy``: another row with the same keys comes before.

    ``order`` is a number that identifies rows (see ``dedup.order_key``). The
    first row of each key comes from a partially aggregated minimum and is
    matched back by that row's own number, so neither side of the join has a
    hot key however many copies there are.
    """
    first = df.groupBy(*keys).agg(F.min(order).alias("_first")).select("_first")
    joined = df.join(first, F.col(order) == F.col("_first"), "left")
    return joined.withColumn("is_copy", F.col("_first").isNull()).drop("_first")


def extended_report(marked: DataFrame) -> DataFrame:
    """Per modality: rows in, kept, dropped, and drops by cause."""

    def having(reason: str) -> Column:
        return F.count_if(F.array_contains(F.split("quality_reason", r"\|"), reason))

    return marked.groupBy("modality").agg(
        F.count("*").alias("rows_in"),
        F.count_if(F.col("quality_status") == "pass").alias("rows_kept"),
        F.count_if(F.col("quality_status") == "fail").alias("rows_dropped"),
        having("exact_duplicate").alias("duplicate_count"),
        having("missing_file").alias("missing_asset_count"),
        F.count_if(
            F.col("quality_reason").rlike("empty_text|empty_caption|no_transcript")
        ).alias("empty_text_or_caption_count"),
        having("duration_out_of_range").alias("duration_filtered_count"),
    )


def safety_gate(gated: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Add reason ``unsafe`` where the score table flags a row.

    ``scores`` holds ``key, unsafe``; rows without a score keep their status.
    Scores are reduced to one row per key first, so no key fans out.
    """
    flags = scores.groupBy(key).agg(F.max("unsafe").alias("_unsafe"))
    joined = gated.join(flags, key, "left")
    reasons = F.concat(
        F.filter(F.split("quality_reason", r"\|"), lambda r: r != ""),
        F.when(F.col("_unsafe"), F.array(F.lit("unsafe"))).otherwise(
            F.array().cast("array<string>")
        ),
    )
    return mark(joined, reasons).drop("_unsafe")


def license_contract(df: DataFrame) -> DataFrame:
    """Rows without a source or a known licence get reason ``unlabeled``."""
    nameless = F.coalesce(F.trim("source"), F.lit("")) == ""
    unknown = F.coalesce(F.col("license"), F.lit("unknown")) == "unknown"
    return mark(df, [_when(nameless | unknown, "unlabeled")])
