"""Stable on-screen region from face detections sampled along a video."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from timelane.functions.scalars import clamp, half_up

UNITS = 10_000  # detections come in 1/10000 of the frame

# Fixed values.
MIN_AREA, MAX_AREA = 0.001, 0.18
CLUSTER_RADIUS = 0.16
SAMPLE_TIMES = (0.08, 0.2, 0.35, 0.5, 0.65, 0.8, 0.92)
MIN_CONFIDENCE = 0.35
SUMS = ("hits", "sum_x", "sum_y", "sum_w", "sum_h", "sum_area")


def region_clusters(detections: DataFrame) -> DataFrame:
    """Online clustering in (sample, detection) order: nearest centre within the radius, else a new cluster.

    Every assignment depends on the running means before it, so a video is followed in order.  It streams
    through one task with one small record per cluster as the only state; detections are never gathered.
    """
    area = F.col("w").cast("bigint") * F.col("h")
    kept = detections.filter(area.between(int(MIN_AREA * UNITS**2), int(MAX_AREA * UNITS**2)))
    order = ["video_id", "sample_no", "det_no"]
    placed = kept.select(*order, *[F.col(c).cast("bigint").alias(c) for c in "xywh"])
    radius = (2 * CLUSTER_RADIUS * UNITS) ** 2

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, clusters = None, []

        def finished() -> list[tuple]:
            return [(current, i, *c[2:]) for i, c in enumerate(clusters)]

        names = ["video_id", "cluster_no", *SUMS]
        for batch in batches:
            done: list[tuple] = []
            for video, x, y, w, h in zip(*(batch[c].tolist() for c in ("video_id", "x", "y", "w", "h"))):
                if video != current:
                    done.extend(finished())
                    current, clusters = video, []
                cx, cy = 2 * x + w, 2 * y + h  # doubled centre, so it stays whole
                best, nearest = None, radius
                for c in clusters:
                    dx, dy = cx - c[0] / c[2], cy - c[1] / c[2]
                    d = dx * dx + dy * dy
                    if d < nearest:
                        best, nearest = c, d
                if best is None:
                    clusters.append([cx, cy, 1, x, y, w, h, w * h])
                else:
                    for i, v in enumerate((cx, cy, 1, x, y, w, h, w * h)):
                        best[i] += v
            if done:
                yield pd.DataFrame(done, columns=names)
        if current is not None:
            yield pd.DataFrame(finished(), columns=names)

    schema = placed.select("video_id").schema
    for name in ("cluster_no", *SUMS):
        schema = schema.add(name, LongType())
    return placed.repartition("video_id").sortWithinPartitions(*order).mapInPandas(follow, schema)


def stable_region(detections: DataFrame, width: int, height: int) -> DataFrame:
    """Per video the most often hit cluster, how sure it is, and the generous crop around it."""
    clusters = region_clusters(detections)
    mean_area = F.col("sum_area").cast("double") / F.col("hits")
    rank = F.struct("hits", mean_area, -F.col("cluster_no"))
    best = clusters.groupBy("video_id").agg(
        F.max_by(F.struct(*SUMS), rank).alias("c"), F.count(F.lit(1)).alias("clusters")
    ).select("video_id", "clusters", "c.*")
    mean = lambda s: F.col(s).cast("double") / F.col("hits") / UNITS
    sized = best.select(
        "*",
        clamp(mean("sum_w") * 3.2, 0.20, 0.48).alias("cw"),
        clamp(mean("sum_h") * 3.6, 0.20, 0.52).alias("ch"),
    )
    centre = lambda s, size, crop: clamp(mean(s) + mean(size) / 2, F.col(crop) / 2, 1 - F.col(crop) / 2)
    left = lambda s, size, crop: clamp(centre(s, size, crop) - F.col(crop) / 2, F.lit(0.0), 1 - F.col(crop))
    placed = sized.select("*", left("sum_x", "sum_w", "cw").alias("cx"), left("sum_y", "sum_h", "ch").alias("cy"))
    needed = max(3.0, len(SAMPLE_TIMES) * 0.7)
    confidence = F.least(F.lit(1.0), F.col("hits") / F.lit(needed))
    fifth = lambda c: half_up(F.col(c) * 100_000)
    scored = placed.select(
        "video_id", "clusters", "hits",
        half_up(confidence * 1000).alias("confidence_milli"),
        (confidence >= MIN_CONFIDENCE).alias("detected"),
        fifth("cx").alias("x"), fifth("cy").alias("y"), fifth("cw").alias("w"), fifth("ch").alias("h"),
    )
    pixels = lambda c, base: half_up(F.col(c) / 100_000 * base)
    boxed = scored.select(
        "*",
        F.greatest(F.lit(0), pixels("x", width)).alias("px"), F.greatest(F.lit(0), pixels("y", height)).alias("py"),
    ).select(
        "*",
        F.greatest(F.lit(2), F.least(width - F.col("px"), pixels("w", width))).alias("pw"),
        F.greatest(F.lit(2), F.least(height - F.col("py"), pixels("h", height))).alias("ph"),
    )
    # A video without a usable detection is reported as not detected.
    videos = detections.select("video_id").distinct()
    return videos.join(boxed, "video_id", "left").withColumn("detected", F.coalesce("detected", F.lit(False)))
