"""Small column expressions shared by the operators.  Everything stays in built-in JVM functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clamp(value: Column, low, high) -> Column:
    """max(low, min(high, value)): ``low`` wins when the bounds cross; NULL stays NULL."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    # greatest and least skip NULLs, so a missing value has to be kept out.
    return F.when(value.isNotNull(), F.greatest(low, F.least(high, value)))


def half_up(value: Column) -> Column:
    """Round half towards plus infinity, as an integer."""
    return F.floor(value + F.lit(0.5)).cast("bigint")


def even(value: Column) -> Column:
    """Nearest even integer, halves up."""
    return (2 * F.floor(value / 2 + F.lit(0.5))).cast("bigint")


def floor_div(value: Column, by: int) -> Column:
    """Floor division of integers that stays exact beyond 2^53."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by)).cast("bigint")


def is_true(value: Column) -> Column:
    """NULL is not true."""
    return value.eqNullSafe(F.lit(True))


def is_not_false(value: Column) -> Column:
    """NULL counts as yes."""
    return ~value.eqNullSafe(F.lit(False))


def clock(ms: Column, fraction_sep: str, hour_digits: int, fraction_digits: int) -> Column:
    """``[H]H:MM:SS<sep>fraction`` of a non-negative millisecond count, from integer parts only."""
    unit = 10 ** (3 - fraction_digits)
    ticks = F.floor((F.greatest(ms, F.lit(0)) + unit // 2) / unit).cast("bigint")
    per_second = 10**fraction_digits
    seconds = F.floor(ticks / per_second).cast("bigint")
    pad = lambda part, width: F.lpad(part.cast("string"), width, "0")
    hours = F.floor(seconds / 3600).cast("bigint")
    hours_text = F.when(F.length(hours.cast("string")) < hour_digits, pad(hours, hour_digits)).otherwise(
        hours.cast("string")
    )
    return F.concat(
        hours_text,
        F.lit(":"),
        pad(F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("bigint"), 2),
        F.lit(":"),
        pad(F.pmod(seconds, F.lit(60)), 2),
        F.lit(fraction_sep),
        pad(F.pmod(ticks, F.lit(per_second)), fraction_digits),
    )
