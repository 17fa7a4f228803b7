"""Log, status and cache analytics, and the batch forms of the progress stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from timelane.functions.quantiles import discrete_rank, value_at_ranks
from timelane.functions.scalars import floor_div
from timelane.functions.skew import Run, clock_levels, has_hot_key, running

# Fixed values.
BLOCKED_PATTERN = r"(?i)HTTP Error 429|Too Many Requests|Sign in to confirm you.re not a bot|confirm you.re not a bot"
EXIT_BLOCKED, EXIT_FAILED = 42, 1
COMPLETE_PATTERN = "complete|success"
FAILED_PATTERN = "error|failed|cancel"
KERNEL_URL_PATTERN = r"(?i)kaggle\.com/(?:code|kernels)/([A-Za-z0-9_-]+)/([A-Za-z0-9_-]+)"
PROVIDER_FAILED = ("FAILED", "ERROR")
BACKEND_TERMINAL = ("completed", "failed", "cancelled", "expired")
ERROR_CHARS, CLIP_ERROR_CHARS = 4000, 2800
TERMINAL = ("completed", "failed")
DEADLINES_S = {"avatar": 900, "lipsync": 600, "generation": 1200, "kernel": 1500}


def classify_attempts(attempts: DataFrame) -> DataFrame:
    """Per request: done at its first clean attempt, else blocked if any log shows a rate limit, else failed."""
    clean = F.col("exit_code") == 0
    grouped = attempts.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.min(F.when(clean, F.col("attempt"))).alias("succeeded_at"),
        F.bool_or(~clean & F.col("log").rlike(BLOCKED_PATTERN)).alias("blocked"),
    )
    code = F.when(F.col("succeeded_at").isNotNull(), 0).when(F.col("blocked"), EXIT_BLOCKED).otherwise(EXIT_FAILED)
    return grouped.select("request_id", "attempts", "succeeded_at", code.alias("exit_code"))


def classify_status(statuses: DataFrame, slug: str) -> DataFrame:
    """State named by a status text (completion is tested first) and the owner/slug in a push log."""
    low = F.lower("text")
    state = F.when(low.rlike(COMPLETE_PATTERN), "complete").when(low.rlike(FAILED_PATTERN), "failed").otherwise("pending")
    escaped = "".join(f"\\{c}" if c in ".*+?^${}()|[]\\" else c for c in slug)
    fallback = rf"(?i)([A-Za-z0-9_-]+)/({escaped})(?:\s|,|$)"
    log = F.col("push_log")

    def pair(pattern: str) -> Column:
        return F.when(
            log.rlike(pattern), F.concat(F.regexp_extract(log, pattern, 1), F.lit("/"), F.regexp_extract(log, pattern, 2))
        )

    word = F.col("text")
    provider = F.when(word.isin(*PROVIDER_FAILED), "failed").when(word.isin(*BACKEND_TERMINAL), "terminal").otherwise("polling")
    return statuses.select(
        "ref", state.alias("state"), provider.alias("provider_state"), F.coalesce(pair(KERNEL_URL_PATTERN), pair(fallback)).alias("kernel")
    )


def cache_lookup(requests: DataFrame, price_micro: int) -> DataFrame:
    """First request of a key is a miss, later ones are hits that save their seconds.

    The first request of each key is a map-side minimum; joining it back lets the adaptive join split a hot key.
    """
    # A missing field is a value of its own, so keys with one never collide.
    key = F.sha1(F.concat_ws("::", *[F.coalesce(c, F.lit("\x00")) for c in ("model", "image", "audio", "prompt")]))
    keyed = requests.select("request_no", key.alias("cache_key"), "seconds")
    first = keyed.groupBy("cache_key").agg(F.min("request_no").alias("_first"))
    hit = F.col("request_no") > F.col("_first")
    return keyed.join(first, "cache_key").select(
        "request_no", "cache_key", hit.alias("hit"), F.when(hit, F.col("seconds") * price_micro).otherwise(0).cast("bigint").alias("saved_micro")
    )


def download_cache(downloads: DataFrame) -> DataFrame:
    """Per cached file (the digest of its url and an extension): downloads asked for, and how many the cache answered."""
    key = F.concat(F.sha1(F.col("url").cast("binary")), F.coalesce("extension", F.lit(".mp4")))
    return downloads.where("url IS NOT NULL").groupBy(key.alias("cache_key")).agg(
        F.count(F.lit(1)).alias("asked"), (F.count(F.lit(1)) - 1).alias("hits"), F.min_by("url", "asked_no").alias("url")
    )


def error_digest(failures: DataFrame, top: int, chars: int = ERROR_CHARS) -> DataFrame:
    """Most frequent messages per stage, cut to the reported length.  Ranks are limited before the shuffle."""
    counted = failures.select("stage", F.left("message", F.lit(chars)).alias("message")).groupBy("stage", "message").agg(
        F.count(F.lit(1)).alias("failures")
    )
    order = Window.partitionBy("stage").orderBy(F.desc("failures"), "message")
    return counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def job_state(progress: DataFrame) -> DataFrame:
    """State per job from (job_id, at_us, seq, stage, status, patch map): the first terminal report ends a job.

    Patches up to that report are merged, later keys win.  Everything is a map-side aggregate.
    """
    place = F.struct("at_us", "seq")
    ended = F.min(F.when(F.col("status").isin(*TERMINAL), place))
    ends = progress.groupBy("job_id").agg(ended.alias("_end"))
    live = progress.join(ends, "job_id").filter(F.col("_end").isNull() | (place <= F.col("_end")))
    last = live.groupBy("job_id").agg(
        F.max_by(F.struct("stage", "status"), place).alias("s"), F.count(F.lit(1)).alias("reports")
    )
    values = live.select("job_id", "at_us", "seq", F.explode("patch").alias("k", "v"))
    merged = values.groupBy("job_id", "k").agg(F.max_by("v", place).alias("v")).groupBy("job_id").agg(
        F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("meta")  # one entry per distinct key
    )
    return last.join(merged, "job_id", "left").select("job_id", "s.stage", "s.status", "reports", "meta")


def stage_durations(progress: DataFrame, split: bool | None = None) -> DataFrame:
    """Time spent in each stage until a job's next report: how many, p50, p95 (ms)."""
    split = has_hot_key(progress, ["job_id"]) if split is None else split
    order = [F.col("at_us"), F.col("seq")]
    runs = [Run("_stage", "lag", F.col("stage")), Run("_at", "lag", F.col("at_us"))]
    levels = clock_levels("at_us", "seq") if split else None
    lagged = running(progress, ["job_id"], order, runs, levels).filter("_at IS NOT NULL")
    spent = lagged.select(F.col("_stage").alias("stage"), floor_div(F.col("at_us") - F.col("_at"), 1000).alias("ms"))
    ranks = {"p50_ms": discrete_rank(50), "p95_ms": discrete_rank(95)}
    return value_at_ranks(spent, ["stage"], "ms", ranks, bucket=1 << 20).withColumnRenamed("n", "reports")


def stage_counts(progress: DataFrame, minutes: int = 5) -> DataFrame:
    """Reports per stage in tumbling windows of the schedule's cadence."""
    width = minutes * 60
    opened = floor_div(floor_div(F.col("at_us"), 1_000_000), width) * width
    return progress.groupBy(opened.alias("window_start_s"), "stage").agg(F.count(F.lit(1)).alias("reports"))


def stalled_jobs(progress: DataFrame, as_of_us: int) -> DataFrame:
    """Jobs (with their ``kind``) that had not ended when their deadline passed, as seen at ``as_of_us``."""
    limits = F.create_map(*[F.lit(v) for kv in DEADLINES_S.items() for v in kv])
    ended = F.min(F.when(F.col("status").isin(*TERMINAL), F.col("at_us")))
    jobs = progress.groupBy("job_id", "kind").agg(F.min("at_us").alias("first_us"), ended.alias("ended_us"))
    due = jobs.withColumn("deadline_us", F.col("first_us") + limits[F.col("kind")] * F.lit(1_000_000).cast("bigint"))
    late = F.col("ended_us").isNull() | (F.col("ended_us") > F.col("deadline_us"))
    return due.filter((F.col("deadline_us") < as_of_us) & late).select("job_id", "kind", "first_us", "deadline_us")
