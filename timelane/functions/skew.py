"""Ordered running computations that do not depend on one key fitting in one task.

A window partitioned by job sends a whole job to one task.  That is the best plan while jobs are small: one
exchange serves every window of a chain.  When a job may hold a large share of all rows, the same running
value is computed in three steps instead:

1. cut each key into chunks that follow the order, and run the window inside every chunk;
2. reduce every chunk to one row and run the window over those few rows, in several levels if needed;
3. join the carried-in value of each chunk back and combine.

``has_hot_key`` decides with one cheap aggregate which form to use.  ``range_running`` is a third form, for orders that
nothing but their own ranges can cut.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from timelane.functions.scalars import floor_div
from timelane.session import stage

class Limits:
    """Sizes a single task may meet.  Tests lower them to run the split forms on small tables."""

    split_rows = 250_000  # rows of one key in one window task
    chunk_rows = 4096     # rows per chunk where an ordinal without gaps is at hand
    task_rows = 250_000   # rows of many keys in one window task


def has_hot_key(df: DataFrame, keys: Sequence[str], weight: Column | None = None) -> bool:
    """True when some key holds more than ``Limits.split_rows`` rows.  Reads the key columns, returns one row.

    ``weight`` is the number of rows that a row will become where the table is still to be exploded.
    """
    size = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.groupBy(*keys).agg(size.alias("rows"))
    return not counts.filter(F.col("rows") > Limits.split_rows).limit(1).isEmpty()


def spread(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by ``key`` over a task per ``Limits.task_rows`` of them; few rows stay as they are.

    Narrow rows pack so well that a shuffle partition of the usual bytes holds millions of them, and every sort of a
    chain of windows keeps them all.
    """
    tasks = -(-rows // Limits.task_rows)
    return df.repartition(tasks, key) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def block_of(ordinal: str | Column) -> Column:
    """Block of a non-negative number; at most ``Limits.chunk_rows`` distinct values fall into one."""
    return floor_div(F.col(ordinal) if isinstance(ordinal, str) else ordinal, Limits.chunk_rows)


def chunk_of(ordinal: str) -> Column:
    """Block of a 1-based ordinal without gaps: every chunk but the last is full."""
    return block_of(F.col(ordinal) - 1)


def clock_levels(micros: str, tie: str) -> list[list[Column]]:
    """Chunk levels of an event clock: hour, second, then the instant with blocks of its tie-breaker."""
    at = F.col(micros)
    return [[floor_div(at, 3_600_000_000)], [floor_div(at, 1_000_000)], [at, block_of(tie)]]


@dataclass(frozen=True)
class Run:
    """One running value.

    kind: ``rank`` (1-based position), ``sum`` (through this row), ``sum_before`` (earlier rows),
    ``max`` (through this row), ``lag`` (previous row), ``last`` (latest non-null through this row).
    """

    name: str
    kind: str
    value: Column | None = None


def _window_value(run: Run, window) -> Column:
    through = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    if run.kind == "rank":
        return F.row_number().over(window).cast("bigint")
    if run.kind == "sum":
        return F.sum(run.value).over(through)
    if run.kind == "sum_before":
        return F.coalesce(F.sum(run.value).over(before), F.lit(0))
    if run.kind == "max":
        return F.max(run.value).over(through)
    if run.kind == "lag":
        return F.lag(run.value).over(window)
    if run.kind == "last":
        return F.last(run.value, ignorenulls=True).over(through)
    raise ValueError(run.kind)


def _chunk_total(run: Run, order: Sequence[Column]) -> Column:
    place = F.struct(*order)
    if run.kind == "rank":
        return F.count(F.lit(1))
    if run.kind in ("sum", "sum_before"):
        return F.sum(run.value)
    if run.kind == "max":
        return F.max(run.value)
    if run.kind == "lag":
        return F.max_by(run.value, place)
    # max_by skips rows whose ordering value is NULL, so rows without a value do not take part.
    return F.max_by(run.value, F.when(run.value.isNotNull(), place))


def _before_chunk(run: Run, total: Column, window) -> Column:
    """What the chunks before this one carry in, seen inside one window of chunk totals."""
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    if run.kind in ("rank", "sum", "sum_before"):
        return F.coalesce(F.sum(total).over(before), F.lit(0))
    if run.kind == "max":
        return F.max(total).over(before)
    if run.kind == "lag":
        return F.lag(total).over(window)
    return F.last(total, ignorenulls=True).over(before)


def _total_of_totals(run: Run, total: Column, place: Column) -> Column:
    if run.kind in ("rank", "sum", "sum_before"):
        return F.sum(total)
    if run.kind == "max":
        return F.max(total)
    if run.kind == "lag":
        return F.max_by(total, place)
    return F.max_by(total, F.when(total.isNotNull(), place))


def _combine(run: Run, local: Column, carry: Column, first: Column) -> Column:
    if run.kind in ("rank", "sum_before"):
        return local + carry
    if run.kind == "sum":
        return F.coalesce(local, F.lit(0)) + carry
    if run.kind == "max":
        return F.greatest(local, carry)
    if run.kind == "lag":
        return F.when(first, carry).otherwise(local)
    return F.coalesce(local, carry)


def _carries(totals: DataFrame, keys: list[str], cuts: list[list[str]], runs: Sequence[Run]) -> DataFrame:
    """Carried-in values of every chunk from the chunk totals, level by level."""
    outer, inner = [c for level in cuts[:-1] for c in level], cuts[-1]
    window = Window.partitionBy(*keys, *outer).orderBy(*inner)
    total = {run.name: F.col(f"_total_{run.name}") for run in runs}
    inside = totals.select(
        *keys, *outer, *inner,
        *[_before_chunk(run, total[run.name], window).alias(f"_carry_{run.name}") for run in runs],
        (F.row_number().over(window) == 1).alias("_head"),
    )
    if not outer:
        return inside.drop("_head")
    place = F.struct(*inner)
    wider = totals.groupBy(*keys, *outer).agg(
        *[_total_of_totals(run, total[run.name], place).alias(f"_total_{run.name}") for run in runs]
    )
    above = _carries(wider, keys, cuts[:-1], runs)
    above = above.select(*keys, *outer, *[F.col(f"_carry_{run.name}").alias(f"_above_{run.name}") for run in runs])
    # "sum" totals combine like the other sums here: both sides are already what lies before the chunk.
    return inside.join(above, [*keys, *outer], "left").select(
        *keys, *outer, *inner,
        *[
            _combine(run, F.col(f"_carry_{run.name}"), F.col(f"_above_{run.name}"), F.col("_head")).alias(f"_carry_{run.name}")
            for run in runs
        ],
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    runs: Sequence[Run],
    levels: Sequence[Sequence[Column]] | None = None,
) -> DataFrame:
    """Add the running values ``runs`` per ``keys`` in ``order`` (ascending, total, non-null).

    ``levels`` names how a key is cut, coarse to fine; the columns of all levels together must be non-null and
    never decrease along ``order``.  ``None`` keeps the plain window.
    """
    if levels is None:
        if not keys:
            raise ValueError("a running value over the whole table needs chunks")
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[_window_value(run, window).alias(run.name) for run in runs])

    cuts = [[f"_cut{i}_{j}" for j in range(len(level))] for i, level in enumerate(levels)]
    flat = [name for level in cuts for name in level]
    cut_df = df.select("*", *[c.alias(n) for level, names in zip(levels, cuts) for c, n in zip(level, names)])
    window = Window.partitionBy(*keys, *flat).orderBy(*order)
    local = cut_df.select(
        "*",
        *[_window_value(run, window).alias(f"_local_{run.name}") for run in runs],
        (F.row_number().over(window) == 1).alias("_first"),
    )
    totals = cut_df.groupBy(*keys, *flat).agg(*[_chunk_total(run, order).alias(f"_total_{run.name}") for run in runs])
    joined = local.join(_carries(totals, list(keys), cuts, runs), [*keys, *flat], "left")
    return joined.select(
        *df.columns,
        *[
            _combine(run, F.col(f"_local_{run.name}"), F.col(f"_carry_{run.name}"), F.col("_first")).alias(run.name)
            for run in runs
        ],
    )


def range_running(df: DataFrame, keys: Sequence[str], order: Sequence[Column], runs: Sequence[Run]) -> DataFrame:
    """As ``running``, whatever the keys hold: rows are range-sorted once by keys and order.

    A range ends where Spark's sample says, so it needs no ordinal without gaps and no clock to be cut by, and a key with
    very many rows is many ranges.  Only the first and the last key of a range can reach into another; what those carry
    over, at most two rows per range, travels to the rows.
    """
    keys = list(keys)
    sorted_rows = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    # The number of the range and the place in it.
    placed = sorted_rows.withColumn("_id", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_id", 33))
    window = Window.partitionBy(*keys, "_range").orderBy("_id")
    local = stage(
        placed.select("*", *[_window_value(run, window).alias(f"_local_{run.name}") for run in runs], (F.row_number().over(window) == 1).alias("_first")),
        "ranges",
    )
    same = lambda left, right: [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    inside = local.alias("l")
    if keys:
        ends = local.groupBy("_range").agg(F.min_by(F.struct(*keys), "_id").alias("a"), F.max_by(F.struct(*keys), "_id").alias("b"))
        reaching = ends.select(F.explode(F.array("a", "b")).alias("k")).select("k.*").distinct()
        inside = inside.join(F.broadcast(reaching).alias("r"), same("l", "r"), "left_semi")
    totals = inside.groupBy(*keys, "_range").agg(*[_chunk_total(run, [F.col("_id")]).alias(f"_total_{run.name}") for run in runs])
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range")
    carries = totals.select(*keys, "_range", *[_before_chunk(run, F.col(f"_total_{run.name}"), before).alias(f"_carry_{run.name}") for run in runs])
    met = local.alias("l").join(F.broadcast(carries).alias("c"), [F.col("l._range") == F.col("c._range"), *same("l", "c")], "left")
    neutral = lambda run, carry: F.coalesce(carry, F.lit(0)) if run.kind in ("rank", "sum", "sum_before") else carry
    return met.select(
        *[F.col(f"l.{c}") for c in df.columns],
        *[_combine(run, F.col(f"_local_{run.name}"), neutral(run, F.col(f"_carry_{run.name}")), F.col("_first")).alias(run.name) for run in runs],
    )
