"""Lookups and joins around a render: prices, clip windows, required markers, layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from timelane.functions.scalars import floor_div
from timelane.functions.sides import beside
from timelane.operators.gates import persona_flags

# List price per second in millionths, and the lengths a model offers where it restricts them.
MODEL_PRICES = [
    ("fal-ai/kling-video/v3/standard/image-to-video", 84_000, None),
    ("fal-ai/kling-video/v3/pro/image-to-video", 112_000, None),
    ("fal-ai/kling-video/o1/standard/image-to-video", 84_000, None),
    ("bytedance/seedance-2.0/image-to-video", 240_000, None),
    ("fal-ai/bytedance/seedance/v1/pro/image-to-video", 50_000, None),
    ("fal-ai/veo3.1/fast/first-last-frame-to-video", 150_000, [4, 6, 8]),
    ("fal-ai/wan-flf2v", 20_000, None),
]
DEFAULT_PRICE = 112_000
OPENROUTER_PRICE = 126_000

# Bounds of a clip window.
MIN_WINDOW_MS = 15_000
MAX_WINDOW_MS = 90_010

# The output canvas and the avatar on it.
OUT_W = 1080
OUT_H = 1920
AVATAR_W = 772
AVATAR_H = 434
BAND_H = 608
PLACEMENTS = ("bottom_right", "bottom_left", "top_right", "top_left", "top_band", "bottom_band")
CAPTION_CLEARANCE = 40
CAPTION_MARGIN = 120


def with_cost(requests: DataFrame) -> DataFrame:
    """Add chosen_s, unit_micro and cost_micro to rows with (model, backend, requested_s).

    Unknown models get the default price.  Where a model offers only some lengths the nearest is taken, the
    first of the list on a tie.
    """
    specs = requests.sparkSession.createDataFrame(
        MODEL_PRICES, "model string, _price bigint, _lengths array<bigint>"
    )  # seven fixed rows
    priced = requests.join(F.broadcast(specs), "model", "left")
    asked = F.col("requested_s").cast("bigint")
    ranked = F.transform("_lengths", lambda v, i: F.struct(F.abs(v - asked).alias("d"), i.alias("i"), v.alias("v")))
    price = F.when(F.col("backend") == "openrouter", OPENROUTER_PRICE).otherwise(F.coalesce("_price", F.lit(DEFAULT_PRICE)))
    return (
        priced.withColumn("chosen_s", F.coalesce(F.array_min(ranked)["v"], asked))
        .withColumn("unit_micro", price.cast("bigint"))
        .withColumn("cost_micro", F.col("chosen_s") * F.col("unit_micro"))
        .select(*requests.columns, "chosen_s", "unit_micro", "cost_micro")
    )


def spec_cost(requests: DataFrame) -> DataFrame:
    return with_cost(requests).select("request_no", "model", "backend", "chosen_s", "unit_micro", "cost_micro")


def window_contract(candidates: DataFrame) -> DataFrame:
    """Effective bounds of every candidate (plan bounds win) and why it is rejected, if it is."""
    start = F.coalesce("plan_start_ms", "clip_start_ms").cast("bigint")
    end = F.coalesce("plan_end_ms", "clip_end_ms").cast("bigint")
    length = F.col("end_ms") - F.col("start_ms")
    reason = (
        F.when(length.isNull() | (length <= 0), "invalid_range")
        .when((length < MIN_WINDOW_MS) | (length > MAX_WINDOW_MS), "length_contract")
    )
    bounded = candidates.select("candidate_id", "job_id", start.alias("start_ms"), end.alias("end_ms"))
    return bounded.withColumn("reason", reason)


def slice_window(words: DataFrame, candidates: DataFrame, bucket_ms: int = MIN_WINDOW_MS) -> DataFrame:
    """Words lying wholly inside each accepted window, rebased to its start.

    Both sides meet on (job, time bucket): a word has one bucket, a window at most seven, so no word is
    compared with windows elsewhere on the clock.
    """
    accepted = window_contract(candidates).filter("reason IS NULL").select(
        "candidate_id",
        "job_id",
        F.col("start_ms").alias("from_ms"),
        F.col("end_ms").alias("to_ms"),
        F.explode(F.sequence(floor_div(F.col("start_ms"), bucket_ms), floor_div(F.col("end_ms"), bucket_ms))).alias("bucket"),
    )
    placed = words.withColumn("bucket", floor_div(F.col("start_ms"), bucket_ms))
    inside = (F.col("start_ms") >= F.col("from_ms")) & (F.col("end_ms") <= F.col("to_ms"))
    return placed.join(accepted, ["job_id", "bucket"]).filter(inside).select(
        "candidate_id",
        "job_id",
        "ord",
        "text",
        (F.col("start_ms") - F.col("from_ms")).alias("start_ms"),
        (F.col("end_ms") - F.col("from_ms")).alias("end_ms"),
    )


def marker_audit(documents: DataFrame, key: str, text: str, markers: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Documents breaking "every marker occurs exactly once": 0 is missing, 2 or more ambiguous.

    ``markers`` is a fixed list (label, needle, why), so each document is scanned where it lies.
    """
    def found(needle: str) -> Column:
        left = F.length(F.replace(F.col(text), F.lit(needle), F.lit("")))
        return floor_div(F.length(text) - left, len(needle))

    counted = F.array(
        *[F.struct(F.lit(label).alias("label"), F.lit(why).alias("why"), found(needle).alias("found")) for label, needle, why in markers]
    )
    broken = F.filter(counted, lambda m: m["found"] != 1)
    return documents.select(key, F.explode(broken).alias("m")).select(
        key, "m.label", "m.why", "m.found", F.when(F.col("m.found") == 0, "missing").otherwise("ambiguous").alias("verdict")
    )


def layout_plan(jobs: DataFrame, assets: DataFrame, cut_x: int = 0, cut_width: int = AVATAR_W) -> DataFrame:
    """Where avatar, source, plate and captions go, per job.

    The operator's override wins when it names a known placement or switches the plate; without an override
    the director's choice stands, but retreats to the bottom right when its plate does not exist.
    """
    starts_top = lambda c: c.startswith("top_")
    band = lambda c: c.isin("top_band", "bottom_band")
    corner = F.when(F.col("ovr_avatar").isin(*PLACEMENTS), F.col("ovr_avatar"))
    plate_wish = F.coalesce(F.nullif(F.col("ovr_background"), F.lit("")), F.lit("auto"))
    has_layout = F.col("dir_avatar").isNotNull()
    resolved = jobs.join(beside(persona_flags(assets).select("persona", "has_background")), "persona", "left").select(
        "job_id",
        "persona",
        F.coalesce("has_background", F.lit(False)).alias("has_plate"),
        (corner.isNotNull() | (plate_wish != "auto")).alias("forced"),
        plate_wish.alias("wish"),
        F.coalesce(corner, "dir_avatar", F.lit("bottom_right")).alias("asked"),
        F.coalesce("dir_shift", F.lit("none")).alias("base_shift"),
        F.when(has_layout, F.col("dir_captions")).otherwise("none").alias("captions"),
        (has_layout & F.coalesce("dir_plate", F.lit(False))).alias("base_plate"),
    )
    top = starts_top(F.col("asked"))
    forced_shift = (
        F.when(band(F.col("asked")), F.when(top, "down").otherwise("up"))
        .when(top & (F.col("base_shift") == "none"), "down")
        .otherwise(F.col("base_shift"))
    )
    forced_plate = F.when(F.col("wish") == "on", True).when(F.col("wish") == "off", False).otherwise(top)
    wished = resolved.select(
        "*",
        F.when(F.col("forced"), forced_shift).otherwise(F.col("base_shift")).alias("asked_shift"),
        F.when(F.col("forced"), forced_plate).otherwise(F.col("base_plate")).alias("wants_plate"),
    )
    retreats = F.col("wants_plate") & ~F.col("has_plate") & ~F.col("forced")
    effective = wished.select(
        "job_id",
        "captions",
        F.when(retreats, "bottom_right").otherwise(F.col("asked")).alias("avatar"),
        F.when(retreats, "none").otherwise(F.col("asked_shift")).alias("source_shift"),
        (F.col("wants_plate") & F.col("has_plate")).alias("plate"),
        F.when(F.col("forced"), "operator_override").otherwise("director").alias("layout_source"),
    )
    avatar, shift = F.col("avatar"), F.col("source_shift")
    is_band, is_top = band(avatar), starts_top(avatar)
    height = F.when(is_band, BAND_H).otherwise(AVATAR_H)
    moved = is_band | shift.isin("down", "up")
    down = F.when(is_band, is_top).otherwise(shift == "down")
    left_side = is_band | avatar.endswith("_left")
    up_shift = F.when(is_band, ~is_top).otherwise(shift == "up")
    captions_top = F.col("captions").eqNullSafe(F.lit("top"))
    return effective.select(
        "*",
        moved.alias("banded"),
        F.when(left_side, 0).otherwise(OUT_W - cut_width).alias("avatar_x"),
        F.when(is_top, 0).otherwise(OUT_H - height).alias("avatar_y"),
        height.alias("avatar_height"),
        F.when(~is_band, cut_x).alias("crop_x"),
        F.when(~is_band, cut_width).alias("crop_width"),
        (OUT_H - height).alias("source_height"),
        # NULL: the source stays centred.
        F.when(moved, F.when(down, height).otherwise(0)).alias("source_y"),
        F.when(up_shift, OUT_H - height).otherwise(0).alias("plate_y"),
        F.when(captions_top, 8).otherwise(2).alias("caption_alignment"),
        F.when(captions_top == is_top, height + CAPTION_CLEARANCE).otherwise(CAPTION_MARGIN).alias("caption_margin"),
    )
