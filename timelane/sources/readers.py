"""Reads: JSON documents to typed rows, the asset catalog, raw frame grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from timelane.functions.scalars import floor_div, half_up

# Ids and numbers are read as text: ids may be no numbers, and numbers may stand in quotes.
PLAN_EVENT = T.StructType([T.StructField(n, T.StringType()) for n in ("time", "type", "intensity", "duration", "comment")])
JOB_DOCUMENT = T.StructType(
    [
        T.StructField(
            "job",
            T.StructType(
                [
                    T.StructField("id", T.StringType()),
                    T.StructField("status", T.StringType()),
                    T.StructField("source_url", T.StringType()),
                    T.StructField("reaction_plan", T.StructType([T.StructField("events", T.ArrayType(PLAN_EVENT))])),
                ]
            ),
        ),
    ]
)
WORD = T.StructType([T.StructField(n, T.StringType()) for n in ("text", "start", "end")])
TRANSCRIPT = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("words", T.ArrayType(WORD)),
    ]
)
STREAM = T.StructType(
    [
        T.StructField("codec_type", T.StringType()),
        T.StructField("codec_name", T.StringType()),
        T.StructField("width", T.LongType()),
        T.StructField("height", T.LongType()),
        T.StructField("duration", T.StringType()),
    ]
)
PROBE = T.StructType(
    [
        T.StructField("streams", T.ArrayType(STREAM)),
        T.StructField("format", T.StructType([T.StructField("duration", T.StringType())])),
    ]
)


def _millis(text: Column) -> Column:
    """Seconds as text to whole milliseconds; anything that is no finite number gives NULL."""
    seconds = text.try_cast("double")
    finite = ~F.isnan(seconds) & (F.abs(seconds) < float("inf"))
    return F.when(finite, half_up(seconds * 1000))


def read_jobs(documents: DataFrame, column: str = "document") -> DataFrame:
    """Claim documents to one row per plan event; jobs with an empty plan keep one row without an event.

    A document whose plan is not an object has ``has_plan`` false.  Event times and durations in seconds become ms,
    intensities thousandths.  ``job_ref`` is the id as written; ``job_id`` is NULL for one that is no whole number.
    """
    parsed = documents.select(F.from_json(column, JOB_DOCUMENT).alias("d")).select("d.job.*")
    rows = parsed.select(
        F.col("id").try_cast("bigint").alias("job_id"),
        F.col("id").alias("job_ref"),
        "status",
        F.col("reaction_plan").isNotNull().alias("has_plan"),
        F.posexplode_outer("reaction_plan.events").alias("pos", "event"),
    )
    return rows.select(
        "job_id",
        "job_ref",
        "status",
        "has_plan",
        (F.col("pos") + 1).cast("bigint").alias("event_ord"),
        _millis(F.col("event.time")).alias("time_ms"),
        F.col("event.type").alias("type"),
        _millis(F.col("event.intensity")).alias("intensity_m"),
        _millis(F.col("event.duration")).alias("duration_ms"),
        F.col("event.comment").alias("comment"),
    )


def read_job_assets(documents: DataFrame, column: str = "document") -> DataFrame:
    """Claim documents to one row per asset offered with the job, in library order.

    Assets have no fixed shape: they are read as VARIANT, fields of another type or missing ones are NULL, and
    ``metadata`` and ``asset`` keep what no column names, as JSON text.  ``assets`` that are no array give no rows.
    """
    parsed = documents.select(F.try_parse_json(column).alias("d"))
    rows = parsed.select(
        F.try_variant_get("d", "$.job.id", "string").alias("job_ref"), F.posexplode(F.try_variant_get("d", "$.assets", "array<variant>")).alias("pos", "a")
    )
    text = lambda name: F.try_variant_get("a", f"$.{name}", "string")
    return rows.select(
        F.col("job_ref").try_cast("bigint").alias("job_id"),
        "job_ref",
        (F.col("pos") + 1).cast("bigint").alias("asset_ord"),
        text("id").alias("asset_ref"),
        *[text(name).alias(name) for name in ("label", "persona", "reaction_type", "video_url")],
        *[text(name).try_cast("boolean").alias(name) for name in ("enabled", "speech_ready")],
        *[_millis(text(name)).alias(f"{name}_m") for name in ("intensity_min", "intensity_max")],
        F.to_json(F.try_variant_get("a", "$.metadata", "variant")).alias("metadata"),
        F.to_json("a").alias("asset"),
    )


def asset_catalog(assets: DataFrame, persona: str, reaction_type: str, limit: int = 1) -> DataFrame:
    """Catalog lookup: both filters reach the scan, three columns leave it, first in library order."""
    return (
        assets.filter((F.col("persona") == persona) & (F.col("reaction_type") == reaction_type) & F.col("enabled"))
        .orderBy("asset_ord")
        .limit(limit)
        .select("asset_id", "label", "persona")
    )


def read_transcripts(documents: DataFrame, key: str = "job_id", column: str = "document") -> DataFrame:
    """Transcript documents to words: text trimmed, words without text or finite times dropped."""
    parsed = documents.select(key, F.from_json(column, TRANSCRIPT).alias("t"))
    # Filter inside the array, so the surviving words of a document are numbered without gaps.
    typed = F.transform(
        F.coalesce("t.words", F.array().cast(T.ArrayType(WORD))),
        lambda w: F.struct(F.trim(w["text"]).alias("text"), _millis(w["start"]).alias("start_ms"), _millis(w["end"]).alias("end_ms")),
    )
    kept = F.filter(typed, lambda w: (F.length(w["text"]) > 0) & w["start_ms"].isNotNull() & w["end_ms"].isNotNull())
    return parsed.select(key, "t.provider", "t.language", F.posexplode(kept).alias("pos", "w")).select(
        key, "provider", "language", (F.col("pos") + 1).cast("bigint").alias("ord"), "w.text", "w.start_ms", "w.end_ms"
    )


def read_probes(documents: DataFrame, key: str = "job_id", column: str = "document") -> DataFrame:
    """Probe documents to one row: first video and audio stream, container length (0 when absent)."""
    parsed = documents.select(key, F.from_json(column, PROBE).alias("p"))
    first = lambda kind: F.get(F.filter("p.streams", lambda s: s["codec_type"] == kind), F.lit(0))
    picked = parsed.select(key, first("video").alias("v"), first("audio").alias("a"), F.coalesce(_millis(F.col("p.format.duration")), F.lit(0)).alias("duration_ms"))
    return picked.select(
        key,
        F.col("v").isNotNull().alias("has_video"),
        "v.width",
        "v.height",
        F.col("v.codec_name").alias("video_codec"),
        "duration_ms",
        F.col("a").isNotNull().alias("has_audio"),
        F.col("a.codec_name").alias("audio_codec"),
        F.when(F.col("a").isNotNull(), F.coalesce(_millis(F.col("a.duration")), F.col("duration_ms"))).alias("audio_ms"),
    )


def explode_frames(grids: DataFrame, width: int, height: int, column: str = "bytes") -> DataFrame:
    """Raw clip bytes (clip_id, array of values) to cells; a trailing partial frame is dropped."""
    cells = width * height
    whole = F.size(column) - F.pmod(F.size(column), F.lit(cells))
    flat = grids.select("clip_id", F.posexplode(F.slice(column, F.lit(1), whole)).alias("at", "v"))
    cell = F.pmod("at", F.lit(cells))
    return flat.select(
        "clip_id",
        floor_div(F.col("at"), cells).alias("frame_no"),
        cell.alias("cell"),
        F.pmod(cell, F.lit(width)).alias("x"),
        floor_div(cell, width).alias("y"),
        "v",
    )
