"""Session settings the operators rely on.  Only runtime settings, so any session can be tuned."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when a later step would have liked its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # All clocks are UTC.
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a fresh folder of its own; on a cluster, whose executors would not see that
    folder, it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="timelane-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Used where several later branches would otherwise each recompute a costly upstream.  The files are
    columnar, so every branch reads only its own columns, and losing an executor costs a re-read.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/timelane-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
