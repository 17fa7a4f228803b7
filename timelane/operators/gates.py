"""Filters over the asset catalog and the gates a job has to pass before any costly work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from timelane.functions.scalars import is_not_false, is_true
from timelane.functions.sides import beside

# Asset types a timeline cannot play.
REFERENCE_TYPE = "reference"
BACKGROUND_TYPE = "background"


def playable_assets(assets: DataFrame) -> DataFrame:
    """Enabled (NULL counts as enabled) and neither a reference still nor a background plate."""
    return assets.filter(
        is_not_false(F.col("enabled")) & ~F.col("reaction_type").isin(REFERENCE_TYPE, BACKGROUND_TYPE)
    )


def speech_carriers(assets: DataFrame) -> DataFrame:
    return playable_assets(assets).filter(is_true(F.col("speech_ready")))


def reaction_assets(assets: DataFrame, dialect: str = "v4") -> DataFrame:
    """What a reaction may be drawn from.  v4 leaves out speech carriers, v2 takes every enabled asset."""
    if dialect == "v2":
        return assets.filter(is_not_false(F.col("enabled")))
    return playable_assets(assets).filter(~is_true(F.col("speech_ready")))


def first_asset_of_type(assets: DataFrame, reaction_type: str) -> DataFrame:
    """The first enabled asset of a type in library order, one row per persona."""
    found = assets.filter(is_not_false(F.col("enabled")) & (F.col("reaction_type") == reaction_type))
    rest = [c for c in assets.columns if c != "persona"]
    return found.groupBy("persona").agg(F.min_by(F.struct(*rest), "asset_ord").alias("first")).select("persona", "first.*")


def clip_length(asset_duration: str = "duration_ms", probed: str = "probed_ms") -> Column:
    """Declared length when it is more than 0.2 s, else the probed one."""
    return F.when(F.col(asset_duration) > 200, F.col(asset_duration)).otherwise(F.col(probed)).cast("bigint")


def persona_flags(assets: DataFrame, dialect: str = "v4") -> DataFrame:
    """One row per persona: what its library can do.  Pre-aggregated before the shuffle."""
    enabled = is_not_false(F.col("enabled"))
    playable = enabled & ~F.col("reaction_type").isin(REFERENCE_TYPE, BACKGROUND_TYPE)
    carrier = playable & is_true(F.col("speech_ready"))
    reacts = enabled if dialect == "v2" else playable & ~is_true(F.col("speech_ready"))
    has = lambda condition: F.coalesce(F.bool_or(condition), F.lit(False))
    return assets.groupBy("persona").agg(
        has(carrier).alias("has_carrier"),
        has(enabled & (F.col("reaction_type") == REFERENCE_TYPE)).alias("has_reference"),
        has(enabled & (F.col("reaction_type") == BACKGROUND_TYPE)).alias("has_background"),
        *[has(reacts & (F.col("reaction_type") == t)).alias(f"has_{t}") for t in ("neutral", "smirk", "cringe")],
    )


def _with_reason(jobs: DataFrame, assets: DataFrame, avatar_key: bool, dialect: str) -> DataFrame:
    flags = persona_flags(assets, dialect)
    no = lambda name: ~F.coalesce(F.col(name), F.lit(False))
    reason = F.when(~is_true(F.col("has_plan")), "no_plan").when(no("has_neutral"), "no_neutral")
    if dialect == "v4":
        without_still = no("has_reference") if avatar_key else F.lit(True)
        reason = reason.when(is_true(F.col("voice_lipsync")) & no("has_carrier") & without_still, "no_voice_source")
    return jobs.join(beside(flags), "persona", "left").select(*jobs.columns, reason.alias("reason"))


def admission_gate(jobs: DataFrame, assets: DataFrame, avatar_key: bool = True, dialect: str = "v4") -> DataFrame:
    """Every job with the first reason against it, or NULL when it is admitted.

    A voice job passes with a reference still alone (given an avatar key), although the plan then loses its
    lines for want of a carrier; both rules are kept as they are.
    """
    judged = _with_reason(jobs, assets, avatar_key, dialect)
    return judged.select("job_id", "persona", F.col("reason").isNull().alias("admitted"), "reason")


def admitted_jobs(jobs: DataFrame, assets: DataFrame, avatar_key: bool = True, dialect: str = "v4") -> DataFrame:
    return _with_reason(jobs, assets, avatar_key, dialect).filter("reason IS NULL").drop("reason")


def caption_eligibility(jobs: DataFrame) -> DataFrame:
    """Captions are burned unless switched off (NULL is not 'off'), with speech not denied and source audio."""
    wanted = ~F.col("dir_captions").eqNullSafe(F.lit("none"))
    return jobs.select(
        "job_id",
        F.col("dir_captions").alias("zone"),
        (wanted & is_not_false(F.col("has_speech")) & is_true(F.col("source_has_audio"))).alias("eligible"),
    )


def clip_caption_language(clips: DataFrame) -> DataFrame:
    """Clip dialect over (clip_id, captions, language, vod_language): on unless false, with the language hint.

    An empty output language gives way to the recording's, then 'auto'; 'auto' and 'unknown' hint nothing.
    """
    chosen = F.coalesce(F.nullif(F.col("language"), F.lit("")), F.nullif(F.col("vod_language"), F.lit("")), F.lit("auto"))
    return clips.select(
        "clip_id",
        is_not_false(F.col("captions")).alias("eligible"),
        F.when(~chosen.isin("auto", "unknown"), chosen).alias("language_hint"),
    )
