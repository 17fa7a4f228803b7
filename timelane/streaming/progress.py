"""Progress reports as a stream.  Every operator has a batch form in ``operators.logs`` or ``operators.queue``.

Input streams carry an event-time column ``ts`` (TIMESTAMP).  Watermarks bound the state; rows later than the
watermark are dropped by the engine and show up in the query progress as ``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from timelane.operators.logs import DEADLINES_S, TERMINAL
from timelane.operators.queue import DRAIN_SIZE, SESSION_GAP_S
from timelane.session import shared_folder
from timelane.streaming.ordered import CappedRuns, FirstPerHorizon, Followed

# Fixed value: how long a result is reused.
CACHE_HORIZON_S = 6 * 3600
#: Groups of state that keys are dealt over.
BUCKETS = 1024
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def report_stream(spark: SparkSession, folder: str, table: str, schema, max_bytes: int | None = None) -> DataFrame:
    """A Parquet table, one file or a directory of parts, as a stream; TIMESTAMP_NTZ event times become UTC timestamps.

    Without ``max_bytes`` everything available is one micro-batch, so answers do not depend on how a table is cut into
    files.  A live stream sets it; then rows later than the watermark are dropped, in whatever batch they come.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    source = spark.readStream.schema(schema)
    if max_bytes:
        source = source.option("maxBytesPerTrigger", str(max_bytes))
    # A pattern that only the table itself matches: unlike a plain path it may be a file as well as a directory.
    raw = source.parquet(f"{folder}/{table[:-1]}[{table[-1]}]")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def drain(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything available into the shared folder and read the result table back."""
    spark = stream.sparkSession
    base = f"{shared_folder(spark)}/timelane-{label}-{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", f"{base}/rows")
        .option("checkpointLocation", f"{base}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def stage_counts_stream(progress: DataFrame, minutes: int = 5, delay: str = "1 hour") -> DataFrame:
    """Reports per stage in tumbling windows, each emitted once it is closed."""
    return (
        progress.withWatermark("ts", delay)
        .groupBy(F.window("ts", f"{minutes} minutes").alias("w"), "stage")
        .agg(F.count(F.lit(1)).alias("reports"))
        .select(F.unix_seconds("w.start").alias("window_start_s"), "stage", "reports")
    )


def cache_dedup_stream(requests: DataFrame, horizon_s: int = CACHE_HORIZON_S, delay: str = "1 hour") -> DataFrame:
    """Requests (ts, request_no, model, image, audio, prompt) without repeats of a cache key.

    A request passes unless one of its key has passed less than the horizon before it.  It is let through once the
    watermark has passed it, as one that comes later may still have been before it.
    """
    key = F.sha1(F.concat_ws("::", *[F.coalesce(c, F.lit("\x00")) for c in ("model", "image", "audio", "prompt")]))
    keyed = requests.withWatermark("ts", delay).select(
        F.unix_micros("ts").alias("at_us"), F.col("request_no").cast("bigint").alias("request_no"), key.alias("cache_key"), "model", "image", "audio", "prompt", "ts"
    )
    schema = "at_us bigint, request_no bigint, cache_key string, model string, image string, audio string, prompt string, ts timestamp"
    return keyed.withColumn("bucket", bucket_of("cache_key")).groupBy("bucket").transformWithState(FirstPerHorizon(schema, horizon_s * 1_000_000), schema, "append", "EventTime")


def drain_sessions_stream(claims: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Runs of claims (worker, ts, seq) per worker with less than an hour between, cut at their cap.

    Claims may come in any order within the watermark.  A run is emitted once the watermark has passed its last claim
    of eight or the gap after it, so the state is one open run and the claims behind the watermark.
    """
    clocked = claims.withWatermark("ts", delay).select("worker", F.unix_micros("ts").alias("at_us"), F.col("seq").cast("bigint").alias("seq"), "ts")
    return clocked.withColumn("bucket", bucket_of("worker")).groupBy("bucket").transformWithState(CappedRuns(SESSION_GAP_S * 1_000_000, DRAIN_SIZE), CappedRuns.schema, "append", "EventTime")


def job_state_stream(progress: DataFrame, delay: str = "1 hour", keep_s: int = 7 * 86_400) -> DataFrame:
    """A new version of a job's state per micro-batch: stage, status, reports, merged patch, absorbing end.

    A report that comes late, but within the watermark, takes its place: it counts, it sets what no later report has
    set, and a terminal one takes back what came after it.  A job's state goes ``keep_s`` of event time after its last
    report.
    """
    reports = progress.withWatermark("ts", delay).select(
        "at_us", F.col("seq").cast("bigint").alias("seq"), "job_id", "stage", "status", F.to_json("patch", {"ignoreNullFields": "false"}).alias("patch"), "ts"
    )
    return reports.withColumn("bucket", bucket_of("job_id")).groupBy("bucket").transformWithState(Followed(TERMINAL, keep_s * 1_000_000), Followed.schema, "append", "EventTime")


def latest_version(states: DataFrame) -> DataFrame:
    return states.groupBy("job_id").agg(F.max_by(F.struct("stage", "status", "reports", "meta"), "version").alias("s")).select("job_id", "s.*")


def stalled_jobs_stream(progress: DataFrame, delay: str = "1 hour", keep_s: int = 7 * 86_400) -> DataFrame:
    """One alarm per job whose deadline passes on the event clock without a terminal report.

    ``progress`` holds (job_id, kind, ts, at_us, status).  The state is the first report time and whether the
    job has ended; an event-time timer raises the alarm, and another one removes the state ``keep_s`` after that.
    """
    schema = "job_id bigint, kind string, first_us bigint, deadline_us bigint"
    limits = {kind: seconds * 1_000_000 for kind, seconds in DEADLINES_S.items()}
    never = 1 << 62

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        job, kind = key
        first, ended, raised = state.get if state.exists else (never, never, False)
        if not state.hasTimedOut:
            for batch in batches:
                first = min(first, int(batch["at_us"].min()))
                ends = batch.loc[batch["status"].isin(TERMINAL), "at_us"]
                if len(ends):
                    ended = min(ended, int(ends.min()))
        deadline = first + limits[kind]
        passed = deadline // 1000 < state.getCurrentWatermarkMs()
        gone = deadline // 1000 + keep_s * 1000
        if passed and state.hasTimedOut and gone < state.getCurrentWatermarkMs():
            state.remove()
        else:
            waits = ended > deadline and not raised and not passed
            state.update((first, ended, raised or (ended > deadline and passed)))
            state.setTimeoutTimestamp(max(deadline // 1000 + 1 if waits else gone, state.getCurrentWatermarkMs() + 1))
        if ended > deadline and passed and not raised:
            yield pd.DataFrame([{"job_id": job, "kind": kind, "first_us": first, "deadline_us": deadline}])

    reports = progress.withWatermark("ts", delay).select("job_id", "kind", "ts", "at_us", "status")
    return reports.groupBy("job_id", "kind").applyInPandasWithState(
        watch, schema, "first_us bigint, ended_us bigint, raised boolean", "append", GroupStateTimeout.EventTimeTimeout
    )
