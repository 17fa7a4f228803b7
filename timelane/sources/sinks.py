"""Writes: results under immutable keys, new catalog rows, caption rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from timelane.operators.joins import with_cost
from timelane.operators.queue import result_keys


#: Folders of a results table, and rows of one write that share a file.
BUCKETS, FILE_ROWS = 256, 1_000_000


def _folder(job_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(job_id), F.lit(buckets)).cast("int")


def write_results(results: DataFrame, path: str, buckets: int = BUCKETS, file_rows: int = FILE_ROWS) -> None:
    """Append results under their keys.  Jobs hash into a fixed number of folders, so one job's history is one read.

    Rows move to their folder's tasks first, by render: a folder gets one file per ``file_rows`` of its rows, whatever
    the number of tasks, and a job with very many renders is spread over all files of its folder.
    """
    keyed = result_keys(results).withColumn("bucket", _folder(F.col("job_id"), buckets))
    sizes = keyed.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / file_rows).cast("int").alias("_files"))
    sized = keyed.join(F.broadcast(sizes), "bucket")  # one row per folder
    salt = F.pmod(F.xxhash64("job_id", "render_id"), F.col("_files"))
    dealt = sized.withColumn("_file", salt).repartition("bucket", "_file").drop("_files", "_file")
    dealt.write.mode("append").partitionBy("bucket").parquet(path)


def read_results(spark: SparkSession, path: str, job_id: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Results as written; those of one job come from its folder alone."""
    rows = spark.read.parquet(path)
    if job_id is not None:
        job = F.lit(job_id).cast("bigint")
        rows = rows.where((F.col("bucket") == _folder(job, buckets)) & (F.col("job_id") == job))
    return rows.drop("bucket")


def write_caption_rows(rows: DataFrame, path: str) -> None:
    """Write caption rows ordered inside each file; a job may span files, its cue numbers keep the order."""
    rows.repartitionByRange("job_id", "cue").sortWithinPartitions("job_id", "cue").write.mode("append").parquet(path)


# Clip presets (name, label, reaction type, seconds).
PRESETS = [
    ("neutral_a", "Neutral A", "neutral", 10),
    ("neutral_b", "Neutral B", "neutral", 10),
    ("smirk_a", "Smirk A", "smirk", 5),
    ("cringe_a", "Cringe A", "cringe", 5),
    ("disbelief_a", "Disbelief A", "disbelief", 5),
    ("surprise_a", "Surprise A", "surprise", 5),
    ("suspicious_a", "Suspicious A", "suspicious", 5),
    ("smirk_b", "Smirk B", "smirk", 5),
    ("cringe_b", "Cringe B", "cringe", 5),
    ("surprise_b", "Surprise B", "surprise", 5),
    ("disbelief_b", "Disbelief B", "disbelief", 5),
    ("laugh_a", "Laugh A", "laugh", 5),
]


def _presets(clips: DataFrame) -> DataFrame:
    presets = clips.sparkSession.createDataFrame(PRESETS, "preset string, label string, reaction_type string, requested_s bigint")
    return F.broadcast(presets)  # twelve fixed rows


def refused_clips(clips: DataFrame) -> DataFrame:
    """The clips that ``register_assets`` refuses, whole, with the reason."""
    reason = F.concat(F.lit("unknown preset "), F.coalesce("preset", F.lit("NULL")))
    return clips.join(_presets(clips), "preset", "left_anti").select(*clips.columns, reason.alias("reason"))


def register_assets(clips: DataFrame) -> DataFrame:
    """Catalog rows for new clips (asset_id, persona, preset, model, backend, stored_ms, loop struct).

    New clips start disabled and not speech-ready: nothing is played before a person has seen it.  Clips with an
    unknown preset are refused; ``refused_clips`` has them.
    """
    named = clips.join(_presets(clips), "preset")
    priced = with_cost(named)
    path = F.concat_ws("/", F.lit("assets"), "persona", F.col("asset_id").cast("string"), F.concat("preset", F.lit(".mp4")))
    metadata = F.struct(
        "preset", F.col("model").alias("generated_by"), "backend", "loop", F.col("chosen_s").alias("requested_duration_s"), "cost_micro"
    )
    return priced.select(
        "asset_id",
        "persona",
        "reaction_type",
        "label",
        path.alias("storage_path"),
        F.col("stored_ms").alias("duration_ms"),
        F.lit(False).alias("speech_ready"),
        F.when(F.col("reaction_type") == "neutral", "neutral").otherwise("none").alias("anchor_role"),
        F.lit(False).alias("enabled"),
        metadata.alias("metadata"),
    )


def append_assets(catalog: DataFrame, registered: DataFrame) -> DataFrame:
    """Catalog with the new rows appended."""
    return catalog.unionByName(registered, allowMissingColumns=True)
