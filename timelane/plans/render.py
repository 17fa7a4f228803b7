"""Whole plans composed of the operators: from saved events to a job's segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from timelane.functions.quantiles import discrete_rank, value_at_ranks
from timelane.functions.skew import has_hot_key, spread
from timelane.operators import timeline as T
from timelane.operators.adapt import adapt_plan
from timelane.operators.gates import admitted_jobs
from timelane.session import stage


def planned_reactions(
    events: DataFrame, jobs: DataFrame, assets: DataFrame, dialect: str = "v4", split: bool | None = None
) -> DataFrame:
    """Admit jobs, adapt their events, choose an asset for each and place it on the job's clock."""
    split = has_hot_key(events, ["job_id"]) if split is None else split
    ready = admitted_jobs(jobs, assets, dialect=dialect)
    adapted = adapt_plan(events, ready, assets, dialect, split)
    chosen = T.nearest_asset(stage(adapted, "adapted") if split else adapted, assets, dialect)
    return T.place_reactions(stage(chosen, "chosen") if split else chosen, dialect, split)


def placement_summary(placed: DataFrame) -> DataFrame:
    """Placed clips per type: how many, for how long, how many could not start where they should."""
    return placed.groupBy("type").agg(
        F.count(F.lit(1)).alias("reactions"),
        F.sum("duration_ms").alias("planned_ms"),
        F.count_if("pushed").alias("pushed"),
        F.count_if(F.col("kind") == "comment").alias("comments"),
    )


def build_timeline(
    events: DataFrame, jobs: DataFrame, assets: DataFrame, dialect: str = "v4", split: bool | None = None
) -> DataFrame:
    """All segments of all admitted jobs: reactions, spoken comments, and neutral fill between them.

    Placed clips feed three branches (themselves, the gaps before them, the tail), so they are staged once.
    """
    split = has_hot_key(events, ["job_id"]) if split is None else split
    ready = admitted_jobs(jobs, assets, dialect=dialect)
    placed = stage(planned_reactions(events, jobs, assets, dialect, split), "placed")
    gaps = T.open_gaps(placed if split else spread(placed, "job_id", placed.count()), ready, split)
    fill = T.fill_gaps_cyclic if dialect == "v4" else T.fill_gaps_fixed
    neutral = fill(gaps, assets, split).select(
        "job_id", F.lit("neutral").alias("kind"), F.lit(None).cast("bigint").alias("event_no"),
        F.lit("neutral").alias("type"), "asset_id", F.col("start_ms").cast("bigint").alias("start_ms"),
        F.col("duration_ms").cast("bigint").alias("duration_ms"), F.lit(None).cast("bigint").alias("peak_ms"),
    )
    acted = placed.select("job_id", "kind", "event_no", "type", "asset_id", "start_ms", "duration_ms", "peak_ms")
    return acted.unionByName(neutral)


def landing_error(placed: DataFrame) -> DataFrame:
    """Per type: how far a reaction's peak lands from the requested moment.

    ``late`` counts peaks after it; ``clamped`` those whose event lies before the clip's own peak offset.
    """
    error = (F.col("start_ms") + F.col("peak_ms") - F.col("time_ms")).cast("bigint")
    landed = placed.filter("kind = 'reaction'").select(
        "type", error.alias("error_ms"), F.abs(error).alias("off_ms"), (F.col("time_ms") < F.col("peak_ms")).alias("early")
    )
    # Counted by distance first: small, and read twice below.
    counted = stage(
        landed.groupBy("type", "off_ms").agg(
            F.count(F.lit(1)).alias("reactions"), F.count_if(F.col("error_ms") > 0).alias("late"), F.count_if("early").alias("clamped")
        ),
        "landed",
    )
    counts = counted.groupBy("type").agg(
        F.sum("reactions").alias("reactions"), F.sum("late").alias("late"), F.sum("clamped").alias("clamped"), F.max("off_ms").alias("max_off_ms")
    )
    wanted = {"p50_off_ms": discrete_rank(50), "p95_off_ms": discrete_rank(95)}
    ranks = value_at_ranks(counted, ["type"], "off_ms", wanted, copies="reactions")
    return counts.join(ranks.drop("n"), "type")


def reaction_density(events: DataFrame, placed: DataFrame, jobs: DataFrame, density_pct: int = 40) -> DataFrame:
    """Planned and placed events against the density target (length / 10 s x density, density held within 0.08 to 0.7).

    One exchange: jobs, their saved events and their placed clips meet as rows of one table.
    """
    held = min(70, max(8, density_pct))
    rows = jobs.select("job_id", F.col("total_ms").cast("bigint").alias("total_ms")).unionByName(
        events.select("job_id", F.lit(1).alias("planned")), allowMissingColumns=True
    ).unionByName(placed.select("job_id", F.lit(1).alias("placed")), allowMissingColumns=True)
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    counted = rows.groupBy("job_id").agg(F.max("total_ms").alias("total_ms"), zero("planned"), zero("placed")).where("total_ms IS NOT NULL")
    target_milli = F.expr(f"total_ms * {held} div 1000")
    return counted.select(
        "job_id", target_milli.alias("target_milli_events"), "planned", "placed",
        (F.col("planned") * 1000 - target_milli).alias("planned_over_milli"),
        (F.col("placed") * 1000 - target_milli).alias("over_milli_events"),
    )
