"""The job queue and its files: claiming, draining, requeueing, artifacts, schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from timelane.functions.quantiles import upper_median_rank, value_at_ranks
from timelane.functions.scalars import floor_div
from timelane.functions.skew import Run, clock_levels, has_hot_key, range_running, running
from timelane.session import stage

# Fixed values.
DRAIN_SIZE = 8
PREFERRED_FILES = ("source.mp4", "source.mkv", "source.webm", "source.mov")
MIN_FILE_BYTES = 1024
SESSION_GAP_S = 3600


def claim_order(jobs: DataFrame, exact_id: int | None = None) -> DataFrame:
    """The job a worker gets next: the oldest queued one, ties by id, or the asked one."""
    queued = jobs.filter(F.col("status") == "queued")
    if exact_id is not None:
        queued = queued.filter(F.col("job_id") == exact_id)
    return queued.orderBy("created_at", "job_id").limit(1).select("job_id", "persona")


def drain_batches(jobs: DataFrame, size: int = DRAIN_SIZE) -> DataFrame:
    """Queued jobs to scheduled runs of at most ``size``, oldest first."""
    queued = jobs.filter(F.col("status") == "queued").select("job_id", "created_at")
    ranked = range_running(queued, [], [F.col("created_at"), F.col("job_id")], [Run("rank", "rank")])
    return ranked.select("job_id", "rank", (floor_div(F.col("rank") - 1, size) + 1).alias("run_no"))


def preferred_artifact(files: DataFrame) -> DataFrame:
    """Per job the first preferred source file over 1 KB, else the first `source.*` by name."""
    place = F.array_position(F.array(*[F.lit(n) for n in PREFERRED_FILES]), F.col("name"))
    rank = F.when((place > 0) & (F.col("size") > MIN_FILE_BYTES), place).otherwise(len(PREFERRED_FILES) + 1)
    sources = files.filter(F.col("name").startswith("source."))
    return sources.groupBy("job_id").agg(
        F.min_by(F.struct("name", "size"), F.struct(rank, "name", "mtime_ms", "size")).alias("f")
    ).select("job_id", "f.name", "f.size")


def newest_result(files: DataFrame) -> DataFrame:
    """Per job the newest file of the results folder, else the newest of the fallback folder."""
    newest = F.max_by(F.struct("folder", "name", "mtime_ms"), F.struct(F.col("folder") == "results", "mtime_ms", "name", "size"))
    return files.groupBy("job_id").agg(newest.alias("f")).select("job_id", "f.folder", "f.name", "f.mtime_ms")


def requeue(jobs: DataFrame, ids: DataFrame, now: Column, requeued_stage: str = "render_requeued_v4") -> DataFrame:
    """Put the jobs listed in ``ids`` back into the queue; all others pass unchanged."""
    marked = jobs.join(ids.select("job_id").distinct().withColumn("_again", F.lit(True)), "job_id", "left")
    again = F.col("_again").isNotNull()
    cleared = {"status": F.lit("queued"), "current_stage": F.lit(requeued_stage), "updated_at": now}
    emptied = {"error", "result_url", "result_path", "started_at", "completed_at"}
    def column(name: str) -> Column:
        if name in cleared:
            return F.when(again, cleared[name]).otherwise(F.col(name)).alias(name)
        if name in emptied:
            return F.when(~again, F.col(name)).alias(name)
        return F.col(name)
    return marked.select(*[column(c) for c in jobs.columns])


def result_keys(writes: DataFrame) -> DataFrame:
    """Storage key of each write (job_id, render_id, written_at, immutable): versioned, or the shared legacy key."""
    job = F.col("job_id").cast("string")
    versioned = F.concat(F.lit("results/"), job, F.lit("/"), F.col("render_id").cast("string"), F.lit(".mp4"))
    return writes.withColumn("key", F.when(F.col("immutable"), versioned).otherwise(F.concat(F.lit("results/"), job, F.lit(".mp4"))))


def overwrite_audit(writes: DataFrame) -> DataFrame:
    """Keys written more than once, with the version that survived."""
    return (
        result_keys(writes)
        .groupBy("job_id", "key")
        .agg(F.count(F.lit(1)).alias("writes"), F.max_by("render_id", F.struct("written_at", "render_id")).alias("latest_render"))
        .filter("writes > 1")
    )


def schedule_gaps(runs: DataFrame, key: str, at_us: str, id_column: str, wanted_us: int, split: bool | None = None) -> DataFrame:
    """Gaps between consecutive firings per schedule against the wanted cadence: median, least, most, late ones."""
    split = has_hot_key(runs, [key]) if split is None else split
    chunk = clock_levels(at_us, id_column) if split else None
    lagged = running(runs, [key], [F.col(at_us), F.col(id_column)], [Run("_prev", "lag", F.col(at_us))], chunk)
    gaps = lagged.filter("_prev IS NOT NULL").select(key, (F.col(at_us) - F.col("_prev")).alias("gap_us"))
    # Equal gaps are counted first; the counted table is read twice.
    counted = stage(gaps.groupBy(key, "gap_us").agg(F.count(F.lit(1)).alias("_gaps")), "gaps")
    late = F.sum(F.when(F.col("gap_us") > wanted_us, F.col("_gaps")).otherwise(0))
    spread = counted.groupBy(key).agg(F.min("gap_us").alias("min_us"), F.max("gap_us").alias("max_us"), late.alias("late"))
    medians = value_at_ranks(counted, [key], "gap_us", {"median_us": upper_median_rank}, bucket=1 << 24, copies="_gaps")
    return medians.withColumnRenamed("n", "gaps").join(spread, key)


def drain_sessions(claims: DataFrame, split: bool | None = None) -> DataFrame:
    """Runs of claims (worker, at_us, seq) less than an hour apart; a run ends at its cap of 8 or on an empty queue."""
    split = has_hot_key(claims, ["worker"]) if split is None else split
    chunk = clock_levels("at_us", "seq") if split else None
    order = [F.col("at_us"), F.col("seq")]
    ranked = running(claims, ["worker"], order, [Run("_prev", "lag", F.col("at_us")), Run("_rank", "rank")], chunk)
    after_gap = F.col("_prev").isNull() | (F.col("at_us") - F.col("_prev") >= SESSION_GAP_S * 1_000_000)
    if split:
        ranked = stage(ranked, "claims")
    # The rank of the first claim since the last gap; every eighth claim from there opens a run.
    headed = running(ranked, ["worker"], order, [Run("_head", "max", F.when(after_gap, F.col("_rank")))], chunk)
    if split:
        headed = stage(headed, "headed")
    opens = ((F.col("_rank") - F.col("_head")) % DRAIN_SIZE == 0).cast("bigint")
    numbered = running(headed, ["worker"], order, [Run("session_no", "sum", opens)], chunk)
    sessions = numbered.groupBy("worker", "session_no").agg(
        F.min("at_us").alias("start_us"), F.max("at_us").alias("last_us"), F.count(F.lit(1)).alias("claims")
    )
    return sessions.withColumn("ended_by", F.when(F.col("claims") >= DRAIN_SIZE, "cap").otherwise("empty_queue"))
