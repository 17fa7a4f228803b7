"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated names) and
BENCH_RUNS (default 1 timed run after one warm-up of the session) steer it.  Every query runs to the end into
the no-op sink, so no result passes through the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from timelane.plans import catalog  # noqa: E402

HEADLINE = (
    "placement_summary",
    "adapt_plan",
    "nearest_asset",
    "place_reactions",
    "build_timeline",
    "build_timeline_legacy",
    "realised_clock",
    "landing_error",
    "render_summary",
    "slice_window",
    "caption_lines",
    "caption_cues",
    "export_captions_srt",
    "layout_plan",
    "marker_audit",
    "plate_colour",
    "threshold_ladder",
    "motion_patch",
    "frame_loop",
    "stable_region",
    "render_qc",
    "drain_batches",
    "cache_lookup",
    "job_state",
    "stage_durations",
    "drain_sessions",
    "stage_counts_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("timelane-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["playable_assets"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(scale)}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
