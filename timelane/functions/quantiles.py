"""Exact order statistics of integers by counting equal values first.

The rows of a key are reduced to (value, count) on the map side, so a key holding a third of the table costs
one row per distinct value after the shuffle, and no task ever collects raw values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from timelane.functions.scalars import floor_div
from timelane.functions.skew import Run, running


def upper_median_rank(n: Column) -> Column:
    """1-based rank of element floor(n/2) of the sorted values: the upper middle when n is even."""
    return F.floor(n / 2) + 1


def discrete_rank(percent: int):
    """1-based rank of the discrete percentile: the first value covering ``percent`` of the rows."""
    return lambda n: F.greatest(F.lit(1), F.ceil(n * percent / 100))


def value_at_ranks(
    df: DataFrame, keys: Sequence[str], value: str, ranks: dict, bucket: int | None = 1024, copies: str | None = None
) -> DataFrame:
    """Per key: ``n`` plus, for every name in ``ranks``, the value at the rank computed from ``n``.

    ``bucket`` cuts the distinct values of a key into chunks of that width; ``None`` suits values of a small
    fixed range, such as one byte.  ``copies`` names a count column when ``df`` is already counted by value.
    """
    if not keys:
        raise ValueError("group by at least one key; use a constant for the whole table")
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg((F.sum(copies) if copies else F.count(F.lit(1))).alias("_copies"))
    )
    covered = running(
        counts,
        keys,
        [F.col(value)],
        [Run("_covered", "sum", F.col("_copies"))],
        [[floor_div(F.col(value), bucket)]] if bucket else None,
    )
    sizes = counts.groupBy(*keys).agg(F.sum("_copies").alias("n"))
    return covered.join(sizes, list(keys)).groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[
            F.min(F.when(F.col("_covered") >= rank(F.col("n")), F.col(value))).alias(name)
            for name, rank in ranks.items()
        ],
    )
