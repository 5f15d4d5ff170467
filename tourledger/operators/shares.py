"""Counts, shares, pivots, bins and histograms.

Denominators are sums over already aggregated rows, one per category, so the windows
and one-row cross joins below never see the input's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tourledger import names as N
from tourledger.functions.numbers import percent_text, share


def ascending(*cols: str) -> list[Column]:
    """Sort keys in ascending order with the NULL group last."""
    return [F.asc_nulls_last(c) for c in cols]


def count_rows(df: DataFrame, name: str) -> DataFrame:
    """One row: the number of rows."""
    return df.agg(F.count("*").alias(name))


def count_distinct_rows(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """One row: the number of distinct combinations, rows with NULLs included."""
    return count_rows(df.select(*cols).distinct(), name)


def distinct_persons_by(df: DataFrame, keys: Sequence[str], name: str, person: str = N.PERSON) -> DataFrame:
    """Distinct persons per key, NULL keys included; in key order."""
    pairs = df.select(person, *keys).distinct()
    return pairs.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(*ascending(*keys))


def with_total(counts: DataFrame, count: str, total: str = "total_count") -> DataFrame:
    """Add the sum of ``count`` over all rows, as one broadcast row."""
    return counts.crossJoin(F.broadcast(counts.agg(F.sum(count).alias(total))))


def known_category(column: Column, unknown: str = N.UNKNOWN_SOURCE) -> Column:
    """NULL and values marked with a leading ``?`` become ``unknown``."""
    unsure = column.isNull() | (F.substring(column, 1, 1) == "?")
    return F.when(unsure, F.lit(unknown)).otherwise(column)


def _rows(weight: str | None) -> Column:
    return F.count("*") if weight is None else F.sum(weight)


def category_share(
    df: DataFrame,
    category: str,
    count: str,
    percentage: str = "percentage",
    digits: int | None = None,
    combined: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Rows per category with the total and the share, most frequent first.

    ``digits`` rounds the share; ``combined`` adds a column of ``40% (34)`` texts. A row counts
    as many times as ``weight`` tells.
    """
    counts = df.groupBy(category).agg(_rows(weight).alias(count))
    fraction = share(F.col(count), F.col("total_count"))
    out = with_total(counts, count).withColumn(
        percentage, fraction if digits is None else F.bround(fraction, digits)
    )
    if combined is not None:
        out = out.withColumn(combined, percent_text(F.col(percentage), F.col(count)))
    return out.orderBy(F.desc(count), *ascending(category))


def share_within(
    df: DataFrame, outer: str, inner: str, count: str, percentage: str, weight: str | None = None
) -> DataFrame:
    """Rows per (outer, inner) with the outer group's total and the share; a NULL outer is a group.

    A row counts as many times as ``weight`` tells.
    """
    counts = df.groupBy(outer, inner).agg(_rows(weight).alias(count))
    total = F.sum(count).over(Window.partitionBy(outer))
    return (
        counts.withColumn("total_count", total)
        .withColumn(percentage, share(F.col(count), F.col("total_count")))
        .orderBy(*ascending(outer, inner))
    )


def pivot_values(df: DataFrame, column: str, known: Sequence[str] = ()) -> list[str]:
    """Columns for a pivot: ``known`` in that order, then other destinations (``to_...``), then the rest.

    Runs a job that hands the driver the distinct values, so ``df`` should be a small aggregate.
    """
    found = [row[0] for row in df.select(column).distinct().collect()]
    others = {"null" if value is None else value for value in found} - set(known)
    return [*known, *sorted(others, key=lambda c: (not c.startswith("to_"), c))]


def share_pivot(
    df: DataFrame,
    outer: str,
    inner: str,
    count: str,
    percentage: str,
    known: Sequence[str] = (),
    drop: str | None = None,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Pivot of a ``share_within`` table into ``67% (22)`` cells, ``0%`` where a pair is missing.

    The share is rounded to four digits first and to whole percent after that. ``values`` are the
    columns (``null`` is that of NULL): with them the plan is made without a job, for any number of
    columns. Without, ``pivot_values`` finds them, after those in ``known``. ``drop`` leaves out one
    outer value, and the NULL group with it.
    """
    if values is None:
        values = pivot_values(df, inner, known)
    text = percent_text(F.bround(percentage, 4), F.col(count))
    cells = df.select(outer, F.coalesce(inner, F.lit("null")).alias("value"), text.alias("cell"))
    if drop is not None:
        cells = cells.where(F.col(outer) != drop)
    wide = cells.groupBy(outer).pivot("value", list(values)).agg(F.max("cell"))
    return wide.select(outer, *[F.coalesce(f"`{v}`", F.lit("0%")).alias(v) for v in values]).orderBy(*ascending(outer))


def duration_bin(years: Column) -> Column:
    """(0,1], (1,2], (2,3], (3,inf) years as labels; NULL for anything else."""
    under_1, to_2, to_3, over_3 = N.DURATION_BINS
    return (
        F.when(years <= 0, None)
        .when(years <= 1, under_1)
        .when(years <= 2, to_2)
        .when(years <= 3, to_3)
        .when(years > 3, over_3)
    )


def duration_bin_order(label: Column) -> Column:
    """Sort key of a bin label; the NULL bin comes last."""
    order = F.lit(len(N.DURATION_BINS))
    for position, name in enumerate(N.DURATION_BINS):
        order = F.when(label == name, F.lit(position)).otherwise(order)
    return order


def count_by_bin(df: DataFrame, years: str = "duration_years", name: str = "headcount") -> DataFrame:
    """Rows per duration bin, in bin order."""
    counts = df.groupBy(duration_bin(F.col(years)).alias(N.BINS)).agg(F.count("*").alias(name))
    return counts.orderBy(duration_bin_order(F.col(N.BINS)))


def histogram(df: DataFrame, col: str, width: float, name: str = "n") -> DataFrame:
    """Rows per bin of ``width``, as (``bin`` centre, count).

    Bins are centred on multiples of ``width`` and closed on the right.
    """
    centre = F.ceil((F.col(col) - F.lit(width / 2)) / F.lit(width)) * F.lit(width)
    return df.groupBy(centre.alias("bin")).agg(F.count("*").alias(name)).orderBy(*ascending("bin"))


def apply_labels(df: DataFrame, col: str, labels: dict[str, str], default: str | None = None) -> DataFrame:
    """Replace codes by labels. NULL counts as code ``default``; a code without a label becomes NULL."""
    lookup = F.create_map(*[F.lit(item) for pair in labels.items() for item in pair])
    code = F.col(col) if default is None else F.coalesce(col, F.lit(default))
    return df.withColumn(col, F.try_element_at(lookup, code))


def proportion_series(df: DataFrame, year: str, category: str) -> DataFrame:
    """Count and two-digit proportion of each category within its year."""
    counts = df.groupBy(year, category).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(year))
    return counts.withColumn("prop", F.bround(share(F.col("n"), total), 2)).orderBy(*ascending(year, category))
