"""Joins of intervals with points in time, event streams and running sums over a long order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tourledger import names as N

#: Rows of one bin that a task should join at most; a fuller bin is split.
ROWS_PER_SPLIT = 2**20

#: A date has at most 22 bits of days on either side of 1970, so no interval has a longer length.
LEVELS = 24

#: Ranges that a running sum cuts its order into.
RANGES = 256

_BIN = ["__level", "__bin", "__part"]


def _own_names(spells: DataFrame, points: DataFrame) -> None:
    seen = [c.lower() for c in (*spells.columns, *points.columns)]
    if repeated := sorted({c for c in seen if seen.count(c) > 1}):
        raise ValueError(f"both tables have columns named {', '.join(repeated)}")


def interval_join(
    spells: DataFrame, points: DataFrame, start: str, end: str, point: str, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """All pairs of a spell and a point of time in it: ``start <= point < end``, for dates.

    An interval goes into bins as wide as the next power of two of its own length, so that it
    touches two of them at most, and a point is looked up once for each length that has
    spells around it. The join is one of equal bins, with the exact test on what meets there.
    A bin with more than ``rows_per_split`` spells is split: its points are repeated for each part
    and its spells dealt to the parts by their hash. Only such bins are broadcast, which are fewer
    than two in ``rows_per_split`` of the spells. A NULL date and an end at or before the start
    match nothing; repeated rows of either table all match.
    """
    _own_names(spells, points)
    days = F.datediff(end, start)
    level = F.when(days > 1, F.length(F.bin(days - 1))).otherwise(0)
    first, last = F.unix_date(start), F.unix_date(F.date_sub(end, 1))
    own = spells.where(F.col(start) < F.col(end)).withColumns({"__level": level, "__first": first, "__last": last})
    bins = F.expr("sequence(shiftright(__first, __level), shiftright(__last, __level))")
    own = own.withColumn("__bin", F.explode(bins)).drop("__first", "__last")

    cells = own.groupBy("__level", "__bin").agg(F.ceil(F.count("*") / F.lit(rows_per_split)).cast("int").alias("__parts"))
    full = cells.where("__parts > 1")
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in spells.columns])
    own = own.join(F.broadcast(full), ["__level", "__bin"], "left").withColumn(
        "__part", F.pmod(spread, F.coalesce("__parts", F.lit(1))).cast("int")
    )

    asked = points.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    asked = asked.withColumn("__bin", F.expr(f"shiftright(unix_date(`{point}`), __level)"))
    asked = asked.join(cells, ["__level", "__bin"]).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))

    inside = (F.col(start) <= F.col(point)) & (F.col(point) < F.col(end))
    met = own.drop("__parts").join(asked.drop("__parts"), _BIN).where(inside)
    return met.select(*[f"`{c}`" for c in (*points.columns, *spells.columns)])


def present_on_dates(
    tours: DataFrame, dates: DataFrame, as_of: dt.date, date: str = "date", start: str = N.START, end: str = N.END
) -> DataFrame:
    """Every tour that is under way on each of the dates, with the date: ``present_on`` for a table.

    The end day itself does not count, open tours end at ``as_of``. Dates count once each.
    """
    ends = tours.withColumn("__end", F.coalesce(end, F.lit(as_of)))
    asked = dates.select(date).where(F.col(date).isNotNull()).distinct()
    return interval_join(ends, asked, start, "__end", date).drop("__end")


def spell_events(df: DataFrame, ids: Sequence[str], start: str = N.START, end: str = N.END_OR_PRESENT) -> DataFrame:
    """Spells as events: ``date``, ``step`` 1 at each start and -1 at each end, with ``ids``.

    The end day itself does not count. Spells without a date, and those that end at or
    before their start, have no events.
    """
    spells = df.where(F.col(start) < F.col(end)).select(*ids, start, end)
    events = spells.unpivot(list(ids), [start, end], "event", "date")
    return events.select(*ids, "date", F.when(F.col("event") == start, 1).otherwise(-1).alias("step"))


def range_number(rows: DataFrame, order: str, ranges: int = RANGES) -> DataFrame:
    """``rows`` with ``__range``: which of ``ranges`` stretches of ``order`` a row is in, ascending.

    Stretches hold about equally many rows. Their bounds are one row of at most ``ranges`` values,
    computed from all rows.
    """
    if ranges < 2:
        return rows.withColumn("__range", F.lit(0))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    bounds = rows.agg(F.array_distinct(F.percentile_approx(order, shares)).alias("__bounds"))
    below = F.size(F.filter("__bounds", lambda bound: bound < F.col(order)))
    return rows.crossJoin(F.broadcast(bounds)).withColumn("__range", below).drop("__bounds")


def running_sum(
    df: DataFrame, order: str, value: str, name: str, by: Sequence[str] = (), ranges: int = RANGES
) -> DataFrame:
    """The sum of ``value`` up to each ``order`` value, per ``by``: columns by, order and ``name``.

    Rows with equal keys are added up first. Then the order is cut into ranges: each range is
    summed by itself, the ranges' totals are summed in turn, and a row's sum is that of its
    range so far plus that of the ranges before. So no window runs over more than a range, or the
    ranges, of a key, and one key can have any share of the rows. NULL keys are a group of their own;
    rows with a NULL order count for nothing, and a NULL value adds nothing.
    """
    by = list(by)
    summed = df.where(F.col(order).isNotNull()).groupBy(*by, order).agg(F.coalesce(F.sum(value), F.lit(0)).alias("__value"))
    dealt = range_number(summed, order, ranges)
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*by, "__range").agg(F.sum("__value").alias("__total"))
    totals = totals.withColumn("__before", F.coalesce(F.sum("__total").over(before), F.lit(0)))
    so_far = Window.partitionBy(*by, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = dealt.withColumn("__own", F.sum("__value").over(so_far))
    same = F.lit(True)
    for key in (*by, "__range"):
        same = same & F.col(f"r.{key}").eqNullSafe(F.col(f"t.{key}"))
    joined = rows.alias("r").join(totals.alias("t"), same)
    return joined.select(*[f"r.{c}" for c in (*by, order)], (F.col("t.__before") + F.col("r.__own")).alias(name))


def at_once(
    df: DataFrame, by: Sequence[str] = (), name: str = "tours_at_once", start: str = N.START, end: str = N.END_OR_PRESENT
) -> DataFrame:
    """How many spells are under way from each day on which that changes: by, ``date`` and ``name``."""
    return running_sum(spell_events(df, list(by), start, end), "date", "step", name, by)


def most_at_once(df: DataFrame, by: Sequence[str], name: str = "tours_at_once", start: str = N.START, end: str = N.END_OR_PRESENT) -> DataFrame:
    """The greatest number of spells under way at once, per ``by``, and the first day with it."""
    series = at_once(df, by, name, start, end)
    best = series.groupBy(*by).agg(F.min(F.struct((-F.col(name)).alias("less"), F.col("date"))).alias("best"))
    return best.select(*by, (-F.col("best.less")).alias(f"most_{name}"), F.col("best.date").alias("first_date"))
