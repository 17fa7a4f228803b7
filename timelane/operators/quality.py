"""Checks on finished renders: loudness, probes, size budget, and one provenance row per job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from timelane.functions.scalars import clamp, even, half_up, is_true

# Fixed values.
VOICE_TARGET_LUFS = -13
MIN_GAIN_DB, MAX_GAIN_DB = -6, 18
OUT_W, OUT_H = 1080, 1920
DURATION_TOLERANCE_MS = 350
AUDIO_TOLERANCE_MS = 500
RECT_TOLERANCE = 1001  # thousandths
MIN_RECT_PX = 120
RECT_BOUNDS = {"width": (160, 1000), "height": (120, 460)}  # thousandths
MAX_RESULT_BYTES = 46 * 1024 * 1024
AUDIO_KBPS = 160
MIN_KBPS, MAX_KBPS = 1_500, 12_000
RETRY_PERCENT = 82
LOUDNESS_PATTERN = r"I:\s*(-?[\d.]+)\s*LUFS"


def loudness_gain(logs: DataFrame) -> DataFrame:
    """Gain towards the voice target from the last integrated loudness in a log; 0 when there is none."""
    readings = F.regexp_extract_all("log", F.lit(LOUDNESS_PATTERN), F.lit(1))
    measured = F.try_element_at(readings, F.lit(-1)).try_cast("double")
    gain = F.round(clamp(VOICE_TARGET_LUFS - measured, MIN_GAIN_DB, MAX_GAIN_DB), 2)
    return logs.select("job_id", measured.alias("loudness_lufs"), F.coalesce(gain, F.lit(0.0)).alias("gain_db"))


def render_qc(probes: DataFrame, jobs: DataFrame) -> DataFrame:
    """First failed rule per render ('passed' when none), and the geometry-only verdict of the clip dialect."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    sized = (F.col("width") == OUT_W) & (F.col("height") == OUT_H)
    wants_audio = is_true(F.col("source_has_audio"))
    audio_end = F.coalesce("audio_ms", "duration_ms")
    rule = (
        F.when(no(F.col("has_video")), "no_video")
        .when(no(sized), "wrong_size")
        .when(F.abs(F.col("duration_ms") - F.col("expected_ms")) > DURATION_TOLERANCE_MS, "duration_mismatch")
        .when(wants_audio & no(F.col("has_audio")), "audio_missing")
        .when(wants_audio & (audio_end < F.col("expected_ms") - AUDIO_TOLERANCE_MS), "audio_ends_early")
        .otherwise("passed")
    )
    clip_rule = F.when(no(F.col("has_video") & sized), "wrong_size").otherwise("passed")
    return probes.join(jobs.select("job_id", "source_has_audio"), "job_id").select(
        "job_id", rule.alias("verdict"), clip_rule.alias("clip_verdict")
    )


def qc_rates(verdicts: DataFrame) -> DataFrame:
    """Renders per verdict and in total."""
    return verdicts.rollup("verdict").agg(F.count(F.lit(1)).alias("renders")).select(
        F.coalesce("verdict", F.lit("all")).alias("verdict"), "renders"
    )


def replacement_rect(rects: DataFrame) -> DataFrame:
    """Check normalised rectangles (job_id, x, y, width, height in thousandths) and turn them into even pixels."""
    x, y, w, h = (F.col(c) for c in ("x", "y", "width", "height"))
    fits = (x >= 0) & (y >= 0) & (w > 0) & (h > 0) & (x + w <= RECT_TOLERANCE) & (y + h <= RECT_TOLERANCE)
    pixel = lambda c, low, high, base: even(clamp(c, low, high) * base / 1000)
    drawn = rects.select(
        "job_id",
        F.coalesce(fits, F.lit(False)).alias("fits"),
        pixel(x, 0, 1000, OUT_W).alias("px"),
        pixel(y, 0, 1000, OUT_H).alias("py"),
        pixel(w, *RECT_BOUNDS["width"], OUT_W).alias("pw"),
        pixel(h, *RECT_BOUNDS["height"], OUT_H).alias("ph"),
    ).select("job_id", "fits", "px", "py", F.least(F.col("pw"), OUT_W - F.col("px")).alias("pw"), F.least(F.col("ph"), OUT_H - F.col("py")).alias("ph"))
    small = (F.col("pw") < MIN_RECT_PX) | (F.col("ph") < MIN_RECT_PX)
    keep = lambda c: F.when(F.col("fits"), F.col(c)).alias(c)
    return drawn.select(
        "job_id",
        F.when(~F.col("fits"), "invalid").when(small, "too_small").otherwise("ok").alias("verdict"),
        *[keep(c) for c in ("px", "py", "pw", "ph")],
    )


def video_kbps(duration_ms: Column) -> Column:
    budget_bits = MAX_RESULT_BYTES * 8 * 0.94
    rate = F.floor(F.lit(budget_bits) / F.greatest(F.lit(1000), duration_ms)) - AUDIO_KBPS
    return clamp(rate, MIN_KBPS, MAX_KBPS).cast("bigint")


def delivery_budget(renders: DataFrame) -> DataFrame:
    """Bit rate that keeps a render under the size limit; one retry at 82 % when it is over.

    ``retry_bytes`` is the size after that retry, where one was made.
    """
    rate = video_kbps(F.col("duration_ms"))
    over = F.col("bytes") > MAX_RESULT_BYTES
    return renders.select(
        "job_id",
        rate.alias("kbps"),
        F.when(over, half_up(rate * RETRY_PERCENT / 100)).alias("retry_kbps"),
        F.when(~over, "delivered").when(F.col("retry_bytes") > MAX_RESULT_BYTES, "too_large").otherwise("delivered_on_retry").alias("outcome"),
    )


def render_summary(
    jobs: DataFrame, events: DataFrame, placed: DataFrame, fill: DataFrame, captions: DataFrame, layout: DataFrame, qc: DataFrame, delivery: DataFrame, gains: DataFrame
) -> DataFrame:
    """One provenance row per job, from everything that is known about its render.

    All parts become rows of one table that is aggregated by job: one exchange, counted before it, instead of a join per
    part.  ``placed`` are reactions and spoken comments, ``fill`` (job_id, fill_count) the clips between them.  A
    localized source replacement outranks the other layout sources.
    """
    spoken = F.col("kind") == "comment"
    comment = F.struct("start_ms", "duration_ms", F.col("comment").alias("text"), "lipsync_provider")
    parts = [
        jobs.select("job_id", F.struct("source_replacement", F.col("total_ms").cast("bigint").alias("duration_ms")).alias("job")),
        events.select("job_id", F.lit(1).alias("event_count")),
        placed.select("job_id", F.lit(1).alias("segment_count"), spoken.cast("int").alias("comment_count"), F.when(spoken, comment).alias("comment")),
        fill.select("job_id", F.col("fill_count").alias("segment_count")),
        captions.select("job_id", F.lit(1).alias("caption_lines"), F.col("words").alias("caption_words")),
        layout.select("job_id", F.struct("avatar", "layout_source", "crop_x", "crop_width").alias("layout")),
        qc.select("job_id", F.struct("verdict").alias("qc")),
        delivery.select("job_id", F.struct("bytes", "kbps", "outcome").alias("delivery")),
        gains.select("job_id", F.struct("loudness_lufs", "gain_db").alias("gain")),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    counts = ("event_count", "segment_count", "comment_count", "caption_lines", "caption_words")
    one = ("job", "layout", "qc", "delivery", "gain")
    summed = rows.groupBy("job_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
        *[F.any_value(c, True).alias(c) for c in one],
        F.array_sort(F.collect_list("comment")).alias("comments"),  # at most the job's comment cap
    )
    replaced = F.when(is_true(F.col("job.source_replacement")), "localized_source_replacement")
    return summed.where("job IS NOT NULL").select(
        "job_id", "job.duration_ms", *counts,
        F.get("comments", F.lit(0))["text"].alias("first_comment"),
        F.get("comments", F.lit(0))["lipsync_provider"].alias("lipsync_provider"),
        "comments",
        "layout.avatar", F.coalesce(replaced, F.col("layout.layout_source")).alias("layout_source"), "layout.crop_x", "layout.crop_width",
        F.col("qc.verdict").alias("validation"),
        F.col("delivery.bytes").alias("result_bytes"), F.col("delivery.kbps").alias("delivery_kbps"), F.col("delivery.outcome").alias("outcome"),
        F.col("gain.loudness_lufs").alias("voice_loudness_lufs"), F.col("gain.gain_db").alias("voice_gain_db"),
    )
