"""The same answers when keys are too large for one task: limits are lowered so that every job is cut up."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference, duck_rows, spark_rows
from timelane.functions import folds
from timelane.functions.sides import Sides
from timelane.functions.skew import Limits, Run, range_running, running
from timelane.plans import catalog

FOLDER = "/root/testdata/sf0.001"
SPLITTING = (
    "order_events",
    "cap_comments",
    "adapt_plan",
    "place_reactions",
    "place_reactions_legacy",
    "fill_gaps_cyclic",
    "fill_gaps_fixed",
    "build_timeline",
    "realised_clock",
    "crossfade_offsets",
    "cover_with_cycle",
    "forward_fill_boxes",
    "slice_window",
    "caption_lines",
    "caption_cues",
    "frame_loop",
    "schedule_gaps",
    "drain_sessions",
    "drain_batches",
    "stage_durations",
    "stable_region",
)
QUERIES, CHECKS = catalog.queries(), catalog.checks()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.fixture
def small_limits(monkeypatch):
    monkeypatch.setattr(Limits, "split_rows", 2)
    monkeypatch.setattr(Limits, "chunk_rows", 7)
    monkeypatch.setattr(folds, "FAN", 2)


@pytest.mark.parametrize("name", SPLITTING)
def test_split_matches_check(spark, duck, small_limits, name):
    assert difference(spark_rows(QUERIES[name](spark, FOLDER)), duck_rows(duck, CHECKS[name])) is None


@pytest.mark.parametrize("name", ["crossfade_offsets", "realised_clock"])
def test_small_keys_are_dealt_by_rows(spark, duck, monkeypatch, name):
    """However many rows, a window task gets about ``task_rows`` of them; the number of tasks follows the table."""
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    for task_rows in (600, 300):
        monkeypatch.setattr(Limits, "task_rows", task_rows)
        found = QUERIES[name](spark, FOLDER)
        plan = found._jdf.queryExecution().executedPlan().toString()
        dealt = {int(n) for n in re.findall(r"hashpartitioning\(job_id#\w+, (\d+)\), REPARTITION_BY_NUM", plan)}
        assert max(dealt) == -(-2 * lines // task_rows)
        assert difference(spark_rows(found), duck_rows(duck, CHECKS[name])) is None


LOOKED_UP = ("admission_gate", "cap_comments", "adapt_plan", "nearest_asset", "layout_plan", "fill_gaps_cyclic")


@pytest.mark.parametrize("name", LOOKED_UP)
def test_lookups_of_a_large_catalog(spark, duck, monkeypatch, name):
    """Without estimates of small files: a measured lookup travels, so no job or event is dealt by persona."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit in (64 << 20, 0):
            monkeypatch.setattr(Sides, "broadcast_bytes", limit)
            found = QUERIES[name](spark, FOLDER)
            joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin) \[persona", found._jdf.queryExecution().executedPlan().toString())
            assert set(joins) <= {"BroadcastHashJoin" if limit else "SortMergeJoin"} and (joins or name == "fill_gaps_cyclic")
            assert difference(spark_rows(found), duck_rows(duck, CHECKS[name])) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_ranges_carry_every_running_value(spark):
    """Keys of one row, of many, a hot one over many ranges, null keys; the plain window's answer."""
    rng = random.Random(6)
    rows = [(rng.choice([None, "hot", "hot", "hot", *"abcdefgh"]), n, rng.choice([None, rng.randrange(9)])) for n in range(3000)]
    rows += [(f"k{n}", n, 1) for n in range(200)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, at bigint, v bigint").repartition(8)
    v = F.col("v")
    runs = [Run("rank", "rank"), Run("sum", "sum", v), Run("before", "sum_before", v), Run("most", "max", v), Run("prev", "lag", v), Run("last", "last", v)]
    for keys in (["k"], []):
        order = [F.col("at"), F.col("k")]
        plain = running(df.withColumn("one", F.lit(1)), keys or ["one"], order, runs).select(*df.columns, *[r.name for r in runs])
        settings = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            found = range_running(df, keys, order, runs).collect()
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", settings)
        zero = lambda r: tuple(0 if c in ("sum", "before") and x is None else x for c, x in r.asDict().items())
        assert sorted(map(zero, found), key=repr) == sorted(map(zero, plain.collect()), key=repr)
