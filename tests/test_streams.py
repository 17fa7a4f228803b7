"""Streams read a table as one file or as a directory of parts, in any order, with the same answer."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference, duck_rows, spark_rows
from timelane import session
from timelane.operators import logs
from timelane.plans import catalog, registry
from timelane.streaming import ordered, progress

FOLDER = "/root/testdata/sf0.001"
STREAMS = ["job_state_stream", "stage_counts_stream", "stalled_jobs_stream", "cache_dedup_stream", "drain_sessions_stream"]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events table as six shuffled part files."""
    folder = str(tmp_path_factory.mktemp("parts"))
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    events.repartition(6, F.xxhash64("event_id")).sortWithinPartitions(F.xxhash64("event_id", F.lit(1))).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", STREAMS)
def test_parts_give_the_same_rows(spark, parts, name):
    found = spark_rows(catalog.queries()[name](spark, parts))
    assert found[1]
    assert difference(found, duck_rows(connect(FOLDER), catalog.checks()[name])) is None


@pytest.fixture(scope="module")
def in_time(spark, tmp_path_factory):
    """The events table as four part files, one after another in time."""
    folder = str(tmp_path_factory.mktemp("in-time"))
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    bounds = events.approxQuantile("event_id", [0.25, 0.5, 0.75], 0.0)
    cuts = [events.where(F.col("event_id") == int(b)).first().ts for b in bounds]
    cuts = [None, *sorted(cuts), None]
    for low, high in zip(cuts, cuts[1:]):
        part = events.where((F.lit(low is None) | (F.col("ts") >= F.lit(low))) & (F.lit(high is None) | (F.col("ts") < F.lit(high))))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    assert spark.read.parquet(f"{folder}/events.parquet").count() == events.count()
    return folder


@pytest.mark.parametrize("name", STREAMS)
def test_one_file_per_batch_gives_the_same_rows(spark, in_time, monkeypatch, name):
    monkeypatch.setattr(registry, "MAX_BYTES", 1)
    found = spark_rows(catalog.queries()[name](spark, in_time))
    assert found[1]
    assert difference(found, duck_rows(connect(FOLDER), catalog.checks()[name])) is None


HOUR = 3_600_000_000
START = 1_000 * HOUR  # a stream starts with its watermark at 0


def parts_of(spark, folder, name, parts, columns):
    for part in parts:
        rows = spark.createDataFrame(part, columns)
        rows.withColumn("ts", F.timestamp_micros("at_us")).coalesce(1).write.mode("append").parquet(f"{folder}/{name}.parquet")
    return progress.report_stream(spark, str(folder), f"{name}.parquet", f"{columns}, ts timestamp", 1)


def test_requests_pass_again_after_the_horizon(spark, tmp_path):
    # At 0, 7, 20 and 40 hours one passes; repeats at 5 and 12.9 do not; of two at one time the smaller number does.
    def asked(no, hours, model="m"):
        return no, START + int(hours * HOUR), model, None, "a", "p"

    parts = [[asked(2, 0), asked(1, 0), asked(9, 0, None)], [asked(3, 5), asked(4, 7)], [asked(5, 20), asked(6, 12.9), asked(8, 20.5, None)], [asked(7, 40)], [asked(10, 100)]]
    stream = parts_of(spark, tmp_path, "asked", parts, "request_no bigint, at_us bigint, model string, image string, audio string, prompt string")
    rows = progress.drain(progress.cache_dedup_stream(stream, delay="8 hours"), "asked").collect()
    assert sorted((r.request_no, r.at_us - START) for r in rows) == [(1, 0), (4, 7 * HOUR), (5, 20 * HOUR), (7, 40 * HOUR), (8, int(20.5 * HOUR)), (9, 0)]
    assert len({r.cache_key for r in rows}) == 2


def test_reports_in_any_order(spark, tmp_path):
    """One shuffled file per batch, within a long watermark; the batch form's answer, late ends and patches included."""
    rng = random.Random(8)
    reports = []
    for n in range(300):
        status = rng.choice(["rendering"] * 9 + ["completed", "failed"])
        patch = rng.choice([None, {}, {"a": str(n)}, {"a": str(n), "b": None}, {"b": "x"}])
        reports.append((n % 7, START + rng.randrange(50) * 60_000_000, n, f"stage {n % 4}", status, patch))
    columns = "job_id bigint, at_us bigint, seq bigint, stage string, status string, patch map<string,string>"
    twin = logs.job_state(spark.createDataFrame(reports, columns)).collect()
    rng.shuffle(reports)
    stream = parts_of(spark, tmp_path, "reports", [reports[i::5] for i in range(5)], columns)
    states = progress.drain(progress.job_state_stream(stream, delay="2 hours"), "reports")
    plain = lambda rows: sorted((r.job_id, r.stage, r.status, r.reports, sorted((r.meta or {}).items(), key=repr)) for r in rows)
    assert plain(progress.latest_version(states).collect()) == plain(twin)
    assert states.where("version > 1").count()


def test_state_of_a_worker_that_never_pauses(spark, tmp_path):
    """Claims every second; what waits is no more than the watermark's ten minutes."""
    parts = [[(1, START + s * 1_000_000, s) for s in range(at, at + 2_000)] for at in (0, 2_000)]
    stream = parts_of(spark, tmp_path, "claimed", parts, "worker bigint, at_us bigint, seq bigint")
    rows = progress.drain(progress.drain_sessions_stream(stream, delay="10 minutes"), "restless").collect()
    closed = (3_999 - 600 + 1) // 8
    assert sorted(map(tuple, rows)) == [(1, START + 8_000_000 * k, START + 8_000_000 * k + 7_000_000, 8, "cap") for k in range(closed)]
    (state,) = glob.glob(f"{session.shared_folder(spark)}/timelane-restless-*/progress")
    waiting = spark.read.format("statestore").option("path", state).option("stateVarName", "waiting").load()
    assert waiting.count() <= 601


def test_long_waits_are_read_in_stretches(monkeypatch):
    class Waiting(list):
        get = list.__iter__

    monkeypatch.setattr(ordered, "SORTED_ROWS", 5)
    rng = random.Random(2)
    rows = [(rng.randrange(20 * ordered.STRETCH_US), n) for n in range(100)] + [(7, n) for n in range(20)]
    rng.shuffle(rows)
    held = ordered.CappedRuns(1, 8)
    held.waiting = Waiting(rows)
    assert list(held.in_order()) == sorted(rows)
    assert list(held.in_order(9 * ordered.STRETCH_US)) == [r for r in sorted(rows) if r[0] <= 9 * ordered.STRETCH_US]


@pytest.mark.parametrize("max_bytes", [None, 1])
def test_sessions_end_at_their_cap(spark, tmp_path, max_bytes):
    minute = 60_000_000
    # 50 dense claims in two files, 8 after a gap, and one far behind that closes them.
    for part in ([*range(0, 50, 2)], [*range(1, 50, 2), *range(200, 208)], [10_000]):
        claims = spark.createDataFrame([(1, START + m * minute, m) for m in part], "worker bigint, at_us bigint, seq bigint")
        claims.select("worker", "seq", F.timestamp_micros("at_us").alias("ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/claims.parquet")
    stream = progress.report_stream(spark, str(tmp_path), "claims.parquet", "worker bigint, seq bigint, ts timestamp", max_bytes)
    found = progress.drain(progress.drain_sessions_stream(stream), "capped").collect()
    found = sorted((r.worker, r.start_us - START, r.last_us - START, r.claims, r.ended_by) for r in found)
    dense = [(1, 8 * k * minute, (8 * k + 7) * minute, 8, "cap") for k in range(6)] + [(1, 48 * minute, 49 * minute, 2, "empty_queue")]
    assert found == [*dense, (1, 200 * minute, 207 * minute, 8, "cap")]


def test_no_table_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        catalog.queries()["stage_counts_stream"](spark, str(tmp_path)).count()


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_keys_share_groups_of_state(spark, tmp_path):
    """Workers of one group keep runs of their own; the number of groups does not grow with the workers."""
    parts = [[(w, START + m * 60_000_000, 100 * w + m) for w in range(3_000) for m in (0, 1)], [(0, START + 100 * HOUR, 10**6)]]
    stream = parts_of(spark, tmp_path, "many", parts, "worker bigint, at_us bigint, seq bigint")
    rows = progress.drain(progress.drain_sessions_stream(stream), "many").collect()
    assert sorted(map(tuple, rows)) == [(w, START, START + 60_000_000, 2, "empty_queue") for w in range(3_000)]
    assert progress.BUCKETS < 3_000


def test_jobs_share_groups_of_state(spark, tmp_path):
    """Jobs of one group keep states of their own, over batches; what comes after a terminal report does not wait."""
    minute = 60_000_000
    first = [(j, START + m * minute, 10 * j + m, f"s{m}", "completed" if m == 1 and j % 2 else "rendering", {"a": str(m), f"b{m}": "x"}) for j in range(3_000) for m in range(4)]
    # Within the watermark: an earlier end for job 0, a report after the end of job 1, and one far behind that settles all.
    second = [(0, START - minute, 1, "early", "failed", {"c": "y"}), (1, START + 9 * minute, 2, "late", "rendering", {"a": "no"}), (2, START + 40 * HOUR, 3, "last", "rendering", None)]
    third = [(4, START + 41 * HOUR, 4, "again", "completed", {"a": None}), (1, START + 41 * HOUR, 5, "no", "rendering", {"a": "no"})]
    stream = parts_of(spark, tmp_path, "jobs", [first, second, third], "job_id bigint, at_us bigint, seq bigint, stage string, status string, patch map<string,string>")
    states = progress.drain(progress.job_state_stream(stream, delay="2 hours"), "jobs")
    found = {r.job_id: (r.stage, r.status, r.reports, r.meta) for r in progress.latest_version(states).collect()}
    whole = {"a": "3", "b0": "x", "b1": "x", "b2": "x", "b3": "x"}
    assert found[0] == ("early", "failed", 1, {"c": "y"})
    assert all(found[j] == ("s1", "completed", 2, {"a": "1", "b0": "x", "b1": "x"}) for j in range(1, 3_000, 2))
    assert found[2] == ("last", "rendering", 5, whole) and found[4] == ("again", "completed", 5, {**whole, "a": None})
    assert all(found[j] == ("s3", "rendering", 4, whole) for j in range(6, 3_000, 2))
    (state,) = glob.glob(f"{session.shared_folder(spark)}/timelane-jobs-*/progress")
    read = lambda name, batch: spark.read.format("statestore").option("path", state).option("batchId", batch).option("stateVarName", name).load()
    assert read("waiting", 0).count() == 1_500 * 4 + 1_500 * 2
    assert read("records", 0).select("key.bucket").distinct().count() <= progress.BUCKETS


def test_short_waits_are_read_once():
    class Waiting(list):
        reads = 0

        def get(self):
            self.reads += 1
            return iter(self)

    held = ordered.CappedRuns(1, 8)
    held.waiting = Waiting([(at, 0) for at in range(1_000, 0, -1)])
    assert list(held.in_order(500)) == [(at, 0) for at in range(1, 501)]
    assert held.waiting.reads == 1
