"""Statistics over frame grids.  Cells are reduced to at most one row per grid position before anything joins back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from timelane.functions.quantiles import upper_median_rank, value_at_ranks
from timelane.functions.scalars import clamp, even, floor_div, half_up

# Fixed values.
GREEN_LEAD = 12
MIN_PLATE_CELLS = 20
SUBJECT_DISTANCE = 70
PLATE_DISTANCE = 22
CLEAN_SUBJECT = 250
CLEAN_PLATE = 4
USABLE_PLATE = 6
DEFAULT_SIMILARITY = 80  # thousandths
SIMILARITIES = (240, 200, 170, 150, 130, 110, 100, 90, 80, 70, 60, 50, 45, 40)  # thousandths, in trial order
SOLID_ALPHA = 140
MIN_SOLID_CELLS = 2
MIN_FRAMES = 4
MIN_MOTION = 1.5
DRIFT_LIMIT = 34


def plate_colour(cells: DataFrame, keys: Sequence[str] = ("clip_id",)) -> DataFrame:
    """Upper median colour of the greenish cells per key; keys with fewer than 20 such cells are left out."""
    keys = list(keys)
    green = cells.filter((F.col("g") > F.col("r") + GREEN_LEAD) & (F.col("g") > F.col("b") + GREEN_LEAD))
    channels = green.select(
        *keys,
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).cast("bigint").alias("value")) for c in "rgb"])
        ).alias("c"),
    ).select(*keys, "c.channel", "c.value")
    medians = value_at_ranks(channels, [*keys, "channel"], "value", {"median": upper_median_rank}, bucket=None)
    pick = lambda c: F.max(F.when(F.col("channel") == c, F.col("median")))
    colours = medians.groupBy(*keys).agg(
        *[pick(c).alias(c) for c in "rgb"], F.max("n").alias("plate_cells")
    ).filter(F.col("plate_cells") >= MIN_PLATE_CELLS)
    hexed = F.concat(*[F.lower(F.lpad(F.hex(c), 2, "0")) for c in "rgb"])
    return colours.select(*keys, "r", "g", "b", hexed.alias("hex"), "plate_cells")


def colour_drift(colours: DataFrame, calibrated: DataFrame, key: str = "clip_id") -> DataFrame:
    """Squared distance of measured plate colours from the calibrated one, flagged beyond 34."""
    reference = calibrated.select(key, *[F.col(c).alias(f"key_{c}") for c in "rgb"])
    gap = lambda c: (F.col(c) - F.col(f"key_{c}")) * (F.col(c) - F.col(f"key_{c}"))
    squared = gap("r") + gap("g") + gap("b")
    return colours.join(reference, key).select(
        *colours.columns, squared.alias("drift_squared"), (squared > DRIFT_LIMIT**2).alias("drifted")
    )


def threshold_ladder(scored: DataFrame, colours: DataFrame) -> DataFrame:
    """Key threshold per clip from the alpha each candidate leaves on every cell.

    ``scored`` holds (clip_id, r, g, b, alphas): one alpha per candidate of SIMILARITIES, in trial order.  The
    first candidate with a whole subject and a keyed plate wins; else the best subject among the first
    candidate and those with a usable plate.
    """
    key = colours.select("clip_id", *[F.col(c).alias(f"key_{c}") for c in "rgb"])
    gap = lambda c: (F.col(c) - F.col(f"key_{c}")) * (F.col(c) - F.col(f"key_{c}"))
    squared = gap("r") + gap("g") + gap("b")
    subject, plate = squared > SUBJECT_DISTANCE**2, squared < PLATE_DISTANCE**2
    sums = [
        F.sum(F.when(side, F.col("alphas")[i].cast("bigint")).otherwise(0)).alias(f"{name}{i}")
        for i in range(len(SIMILARITIES))
        for name, side in (("s", subject), ("p", plate))
    ]
    per_clip = scored.join(key, "clip_id").groupBy("clip_id").agg(
        F.count_if(subject).alias("subject_cells"), F.count_if(plate).alias("plate_cells"), *sums
    )
    n_subject, n_plate = F.col("subject_cells"), F.col("plate_cells")
    clean = [
        (F.col(f"s{i}") >= CLEAN_SUBJECT * n_subject) & (F.col(f"p{i}") <= CLEAN_PLATE * n_plate)
        for i in range(len(SIMILARITIES))
    ]
    first_clean = F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(clean)])
    # Greatest by (subject sum, earlier first); candidates with an unusable plate do not take part.
    offers = [
        F.when(F.lit(i == 0) | (F.col(f"p{i}") <= USABLE_PLATE * n_plate), F.struct(F.col(f"s{i}").alias("s"), F.lit(-i).alias("i")))
        for i in range(len(SIMILARITIES))
    ]
    best = -F.greatest(*offers)["i"]
    separable = (n_subject > 0) & (n_plate > 0)
    chosen = F.when(separable, F.coalesce(first_clean, best))
    listed = lambda name: F.array(*[F.col(f"{name}{i}") for i in range(len(SIMILARITIES))])
    tenths = lambda total, n: F.when(n > 0, half_up(total * 10 / n))
    picked = per_clip.select(
        "clip_id", "subject_cells", "plate_cells", chosen.alias("i"), (separable & first_clean.isNotNull()).alias("calibrated"),
        listed("s").alias("s"), listed("p").alias("p"),
    )
    at = lambda name: F.get(F.col(name), F.col("i"))
    return picked.select(
        "clip_id",
        F.coalesce(F.get(F.array(*[F.lit(v) for v in SIMILARITIES]), F.col("i")), F.lit(DEFAULT_SIMILARITY)).alias("similarity_milli"),
        "calibrated",
        tenths(at("s"), F.col("subject_cells")).alias("subject_alpha_tenths"),
        tenths(at("p"), F.col("plate_cells")).alias("plate_alpha_tenths"),
        "subject_cells",
        "plate_cells",
    )


def subject_bounds(cells: DataFrame, keys: Sequence[str], grid_width: int, frame_width: int) -> DataFrame:
    """Horizontal extent of the subject: columns with at least two solid cells, padded, on even pixels."""
    keys = list(keys)
    columns = cells.groupBy(*keys, "x").agg(F.count_if(F.col("alpha") > SOLID_ALPHA).alias("solid"))
    solid = F.when(F.col("solid") >= MIN_SOLID_CELLS, F.col("x").cast("bigint"))
    extent = columns.groupBy(*keys).agg(F.min(solid).alias("low"), F.max(solid).alias("high"))
    left = F.greatest(F.lit(0), floor_div((2 * F.col("low") - 1) * frame_width, 4 * grid_width) * 2)
    right = F.least(F.lit(frame_width), -floor_div(-(2 * F.col("high") + 3) * frame_width, 4 * grid_width) * 2)
    return extent.select(
        *keys,
        F.when(F.col("high").isNull(), 0).otherwise(left).alias("x"),
        F.when(F.col("high").isNull(), frame_width).otherwise(F.greatest(F.lit(2), right - left)).alias("width"),
    )


def _moments(cells: DataFrame) -> DataFrame:
    """Mean and population deviation per cell, from exact integer sums."""
    value = F.col("v").cast("bigint")
    sums = cells.groupBy("clip_id", "cell", "x", "y").agg(
        F.count(F.lit(1)).alias("frames"), F.sum(value).alias("s"), F.sum(value * value).alias("q")
    )
    spread = F.col("frames") * F.col("q") - F.col("s") * F.col("s")
    return sums.select(
        "clip_id", "cell", "x", "y", "frames",
        (F.col("s").cast("double") / F.col("frames")).alias("mean"),
        (F.sqrt(spread.cast("double")) / F.col("frames")).alias("deviation"),
    )


def motion_cells(cells: DataFrame) -> DataFrame:
    """Temporal mean and deviation of every cell of clips that have four frames and a moving region."""
    moments = _moments(cells)
    moving = moments.groupBy("clip_id").agg(
        F.max("deviation").alias("peak_deviation"), F.max("mean").alias("peak_mean"), F.min("frames").alias("n")
    ).filter((F.col("n") >= MIN_FRAMES) & (F.col("peak_deviation") >= MIN_MOTION))
    return moments.join(moving.drop("n"), "clip_id")


def motion_patch(motion: DataFrame, grid: tuple[int, int], frame: tuple[int, int]) -> DataFrame:
    """The patch around what moves in the lower half of the changed block, on even pixels inside the frame."""
    (grid_w, grid_h), (base_w, base_h) = grid, frame
    scale_x, scale_y = base_w / grid_w, base_h / grid_h
    in_block = F.col("mean") >= F.greatest(F.lit(3.0), F.col("peak_mean") * 0.25)
    inside = lambda fn, c: fn(F.when(in_block, F.col(c)))
    blocks = motion.groupBy("clip_id").agg(
        inside(F.min, "x").alias("x0"), inside(F.max, "x").alias("x1"),
        inside(F.min, "y").alias("y0"), inside(F.max, "y").alias("y1"),
    ).filter("x0 IS NOT NULL")
    lower = (
        F.col("x").between(F.col("x0"), F.col("x1"))
        & (F.col("y") >= F.col("y0") + (F.col("y1") - F.col("y0") + 1) * 0.5)
        & (F.col("y") <= F.col("y1"))
    )
    moves = lower & (F.col("deviation") >= F.greatest(F.lit(1.2), F.col("peak_deviation") * 0.30))
    # Weights in millionths: sums of integers do not depend on the order of rows.
    weight = half_up(F.col("deviation") * 1_000_000)
    total = lambda value: F.coalesce(F.sum(F.when(moves, value)), F.lit(0))
    x, y = F.col("x").cast("bigint"), F.col("y").cast("bigint")
    gathered = motion.join(blocks, "clip_id").groupBy("clip_id", "x0", "x1", "y0", "y1", "peak_deviation").agg(
        F.count_if(moves).alias("moving_cells"),
        total(weight).alias("w"),
        total(weight * x).alias("wx"), total(weight * y).alias("wy"),
        total(weight * x * x).alias("wxx"), total(weight * y * y).alias("wyy"),
    )
    found = F.col("moving_cells") >= 3
    mean = lambda s: F.col(s).cast("double") / F.col("w")
    deviation = lambda ss, s: F.sqrt(F.greatest(F.lit(0.0), mean(ss) - mean(s) * mean(s)))
    width, height = F.col("x1") - F.col("x0") + 1, F.col("y1") - F.col("y0") + 1
    located = gathered.select(
        "*",
        width.alias("bw"), height.alias("bh"),
        F.when(found, (mean("wx") + 0.5) * scale_x).otherwise((F.col("x0") + width * 0.47 + 0.5) * scale_x).alias("cx"),
        F.when(found, (mean("wy") + 0.5) * scale_y).otherwise((F.col("y0") + height * 0.76 + 0.5) * scale_y).alias("cy"),
        F.when(found, deviation("wxx", "wx") * scale_x).otherwise(width * 0.13 * scale_x).alias("sx"),
        F.when(found, deviation("wyy", "wy") * scale_y).otherwise(height * 0.10 * scale_y).alias("sy"),
    )
    half_w = clamp(F.greatest(F.col("sx") * 1.9, F.col("bw") * scale_x * 0.20), base_w * 0.045, base_w * 0.105)
    half_h = clamp(F.greatest(F.col("sy") * 1.9, F.col("bh") * scale_y * 0.14), base_h * 0.055, base_h * 0.130)
    at_least_two = lambda c: F.greatest(F.lit(2), even(c))
    sized = located.select("*", at_least_two(half_w * 2).alias("pw"), at_least_two(half_h * 2).alias("ph"))
    corner = lambda c, size, base: at_least_two(clamp(F.col(c) - F.col(size) / 2, F.lit(0.0), (base - F.col(size)).cast("double")))
    cornered = sized.select("*", corner("cx", "pw", base_w).alias("px"), corner("cy", "ph", base_h).alias("py"))
    return cornered.select(
        "clip_id",
        F.col("px").alias("x"), F.col("py").alias("y"),
        F.least(F.col("pw"), base_w - F.col("px")).alias("width"),
        F.least(F.col("ph"), base_h - F.col("py")).alias("height"),
        F.round("peak_deviation", 2).alias("peak_deviation"),
        "moving_cells",
        half_up(F.col("cx")).alias("centre_x"), half_up(F.col("cy")).alias("centre_y"),
        F.when(found, "motion_in_lower_face").otherwise("face_block_geometry").alias("located_by"),
        half_up(F.col("x0") * scale_x).alias("block_x"), half_up(F.col("y0") * scale_y).alias("block_y"),
        half_up(F.col("bw") * scale_x).alias("block_width"), half_up(F.col("bh") * scale_y).alias("block_height"),
    )


def _difference(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: F.abs(p - q)), F.lit(0), lambda s, d: s + d).cast("bigint")


def frame_loop(frames: DataFrame, neutral: Column, fps: int) -> DataFrame:
    """Where a clip may turn back (peak) or loop, from each frame's difference to its first frame.

    ``frames`` holds (clip_id, frame_no, grid); grids are compared as arrays and never exploded.  Differences
    are sums over the grid.  Neutral clips turn at their last frame.  The noise floor is the sum of the first
    four differences between neighbours.
    """
    head = lambda i: F.max(F.when(F.col("frame_no") == i, F.col("grid"))).alias(f"g{i}")
    # Only the first five grids of a clip are ever gathered.
    heads = frames.filter("frame_no < 5").groupBy("clip_id").agg(*[head(i) for i in range(5)])
    sizes = frames.groupBy("clip_id").agg(F.count(F.lit(1)).alias("frames"))
    heads = heads.join(sizes, "clip_id").select(
        "clip_id", "frames", "g0", F.size("g0").alias("cells"),
        sum((_difference(F.col(f"g{i}"), F.col(f"g{i + 1}")) for i in range(4)), F.lit(0)).alias("noise4"),
    )
    compared = frames.join(heads, "clip_id").select(
        "clip_id", "frames", "cells", "noise4", "frame_no", neutral.alias("neutral"), _difference(F.col("grid"), F.col("g0")).alias("d")
    )
    late = F.col("frame_no") >= floor_div(F.col("frames") * 45, 100)
    summed = compared.groupBy("clip_id", "frames", "cells", "noise4", "neutral").agg(
        F.max(F.when(F.col("frame_no") >= 1, F.struct(F.col("d").alias("d"), (-F.col("frame_no")).alias("i")))).alias("peak"),
        F.min(F.when(late, F.struct(F.col("d").alias("d"), F.col("frame_no").alias("i")))).alias("loop"),
    )
    peak_frame = F.when(F.col("neutral"), F.col("frames") - 1).otherwise(-F.col("peak.i"))
    at_ms = lambda frame: half_up((frame + 1) * 1000 / fps)
    noise = F.col("noise4") / 4 / F.col("cells")
    score = F.col("loop.d") / F.col("cells")
    return summed.select(
        "clip_id", "frames",
        peak_frame.alias("peak_frame"),
        F.when(F.col("neutral"), F.lit(0)).otherwise(F.col("peak.d")).cast("bigint").alias("peak_difference"),
        at_ms(peak_frame).alias("peak_ms"),
        F.col("loop.i").alias("loop_frame"),
        F.col("loop.d").alias("loop_difference"),
        at_ms(F.col("loop.i")).alias("loop_ms"),
        "noise4",
        half_up(score / F.greatest(F.lit(0.01), noise) * 100).alias("ratio_percent"),
        (F.col("loop.d") * 20 <= F.col("noise4") * 11).alias("seamless"),
    )
