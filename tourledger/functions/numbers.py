"""Shares, half-even rounding and number-to-text formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; NULL where ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent_text(fraction: Column, count: Column) -> Column:
    """0.667 and 22 -> ``67% (22)``; whole percent, half-even."""
    percent = F.bround(fraction * 100, 0).cast("long").cast("string")
    return F.concat(percent, F.lit("% ("), count.cast("string"), F.lit(")"))


def two_decimals(value: Column) -> Column:
    """Number as text with two decimals; NULL stays NULL."""
    return F.when(value.isNotNull(), F.format_string("%.2f", F.bround(value.cast("double"), 2)))
