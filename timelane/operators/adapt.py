"""Fit saved event plans to what a persona's library can play."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from timelane.functions.scalars import is_true
from timelane.functions.sides import beside
from timelane.functions.skew import Run, has_hot_key, range_running, running
from timelane.operators.gates import persona_flags, reaction_assets

# What to play instead of a type the library lacks, best first; any other type becomes neutral.
FALLBACKS = {
    "laugh": ("smirk", "cringe", "neutral"),
    "disbelief": ("cringe", "smirk", "neutral"),
    "suspicious": ("cringe", "neutral", "smirk"),
    "surprise": ("cringe", "neutral", "smirk"),
    "comment": ("neutral", "smirk", "cringe"),
}
DEFAULT_TYPE = "neutral"
DEFAULT_COMMENT_CAP = 1


def vocabulary(assets: DataFrame, dialect: str = "v4") -> DataFrame:
    """Distinct (persona, reaction_type) a plan may use."""
    return reaction_assets(assets, dialect).select("persona", "reaction_type").distinct()


def _in_time(runs, split: bool, events: DataFrame) -> DataFrame:
    order = [F.col("time_ms"), F.col("event_ord")]
    return range_running(events, ["job_id"], order, runs) if split else running(events, ["job_id"], order, runs)


def order_events(events: DataFrame, split: bool | None = None) -> DataFrame:
    """Drop events without a time and number the rest by time; equal times keep plan order."""
    split = has_hot_key(events, ["job_id"]) if split is None else split
    return _in_time([Run("event_no", "rank")], split, events.filter(F.col("time_ms").isNotNull()))


def _with_requests(events: DataFrame, jobs: DataFrame, assets: DataFrame, dialect: str) -> DataFrame:
    """Events of known jobs with the job's comment cap and the persona's abilities."""
    flags = persona_flags(assets, dialect)
    voiced = is_true(F.col("voice_lipsync"))
    if dialect == "v4":
        voiced = voiced & F.coalesce(F.col("has_carrier"), F.lit(False))
    cap = F.when(voiced, F.greatest(F.lit(0), F.coalesce(F.col("max_voice_comments"), F.lit(DEFAULT_COMMENT_CAP))))
    requests = jobs.join(beside(flags), "persona", "left").select(
        "job_id",
        "persona",
        "total_ms",
        F.coalesce(cap, F.lit(0)).alias("comment_cap"),
        *[F.coalesce(F.col(f"has_{t}"), F.lit(False)).alias(f"has_{t}") for t in ("neutral", "smirk", "cringe")],
    )
    return events.join(requests, "job_id")


def _number_and_cap(events: DataFrame, split: bool) -> DataFrame:
    """One pass in time order: event number, and the first ``comment_cap`` non-blank comments kept."""
    line = F.nullif(F.trim("comment"), F.lit(""))
    timed = events.filter(F.col("time_ms").isNotNull()).withColumn("comment", line)
    spoken = F.col("comment").isNotNull().cast("bigint")
    numbered = _in_time([Run("event_no", "rank"), Run("_spoken", "sum", spoken)], split, timed)
    return numbered.withColumn("comment", F.when(F.col("_spoken") <= F.col("comment_cap"), F.col("comment"))).drop("_spoken")


def cap_comments(
    events: DataFrame, jobs: DataFrame, assets: DataFrame, dialect: str = "v4", split: bool | None = None
) -> DataFrame:
    split = has_hot_key(events, ["job_id"]) if split is None else split
    capped = _number_and_cap(_with_requests(events, jobs, assets, dialect), split)
    return capped.select("job_id", "event_no", "event_ord", "time_ms", "type", "comment")


def _fallback(requested: Column) -> Column:
    """First type of the preference list the persona has, else neutral."""
    chain = None
    for asked, preferred in FALLBACKS.items():
        pick = F.coalesce(*[F.when(F.col(f"has_{t}"), F.lit(t)) for t in preferred], F.lit(DEFAULT_TYPE))
        chain = F.when(requested == asked, pick) if chain is None else chain.when(requested == asked, pick)
    return chain.otherwise(F.lit(DEFAULT_TYPE))


def map_reaction_type(events: DataFrame, assets: DataFrame, dialect: str = "v4") -> DataFrame:
    """Map ``requested`` of (persona, requested, has_*) rows to ``mapped``.

    Own type if the persona has it (semi-join style lookup in the vocabulary), else the fallback list.
    """
    known = vocabulary(assets, dialect).select(
        "persona", F.col("reaction_type").alias("requested"), F.lit(True).alias("_known")
    )
    looked_up = events.join(beside(known), ["persona", "requested"], "left")
    mapped = F.when(F.col("_known"), F.col("requested")).otherwise(_fallback(F.col("requested")))
    return looked_up.withColumn("mapped", mapped).drop("_known")


def reaction_type_map(events: DataFrame, jobs: DataFrame, assets: DataFrame, dialect: str = "v4") -> DataFrame:
    """How often each persona's requests end up as which type."""
    requests = _with_requests(events, jobs, assets, dialect).withColumn(
        "requested", F.coalesce(F.nullif(F.col("type"), F.lit("")), F.lit(DEFAULT_TYPE))
    )
    # Types and personas are few: count them first, then map the counted rows.
    counted = requests.groupBy("persona", "requested", "has_neutral", "has_smirk", "has_cringe").agg(
        F.count(F.lit(1)).alias("events")
    )
    return map_reaction_type(counted, assets, dialect).select("persona", "requested", "mapped", "events")


def adapt_plan(
    events: DataFrame, jobs: DataFrame, assets: DataFrame, dialect: str = "v4", split: bool | None = None
) -> DataFrame:
    """Number, cap and map the events of all jobs.

    v4 turns a `comment` event that lost its line into `neutral` before mapping and compares with the raw type
    (a missing type is ''); v2 does neither.
    """
    split = has_hot_key(events, ["job_id"]) if split is None else split
    capped = _number_and_cap(_with_requests(events, jobs, assets, dialect), split)
    asked = F.coalesce(F.nullif(F.col("type"), F.lit("")), F.lit(DEFAULT_TYPE))
    requested = asked
    if dialect == "v4":
        requested = F.when(F.col("comment").isNull() & (asked == "comment"), F.lit(DEFAULT_TYPE)).otherwise(asked)
    mapped = map_reaction_type(capped.withColumn("requested", requested), assets, dialect)
    original = F.coalesce(F.col("type"), F.lit("")) if dialect == "v4" else asked
    return mapped.select(
        "job_id",
        "persona",
        "total_ms",
        "event_no",
        "event_ord",
        "time_ms",
        F.col("mapped").alias("type"),
        F.when(F.col("mapped") != original, original).alias("mapped_from_type"),
        "intensity_m",
        "duration_ms",
        "comment",
        "voice_ms",
    )
