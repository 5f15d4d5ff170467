"""Spells in time: durations, fiscal-year expansion, presence, monthly series, merged tours."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tourledger import names as N
from tourledger.functions.calendar import fiscal_year
from tourledger.functions.numbers import share
from tourledger.operators.people import last_flag

# Stands in for a NULL person as a grouping key; no name holds this character.
_NO_NAME = "\u0000"

# A tour number is a 32-bit integer, so pieces of 2**15 numbers give at most 2**15 tours
# per piece and 2**16 pieces per person, whatever one person's row count is.
TOURS_PER_PIECE = 2**15


def add_fiscal_years(df: DataFrame) -> DataFrame:
    """Fiscal years of the start and the end; the latter is NULL for an open tour."""
    return df.withColumns(
        {N.START_FY: fiscal_year(F.col(N.START)), N.END_FY: fiscal_year(F.col(N.END))}
    )


def add_effective_end(df: DataFrame, as_of: dt.date) -> DataFrame:
    """End date, or ``as_of`` for an open tour."""
    return df.withColumn(N.END_OR_PRESENT, F.coalesce(N.END, F.lit(as_of)))


def add_duration(df: DataFrame, end_col: str = N.END) -> DataFrame:
    """Days with both ends counted, and years of 365 days; NULL where ``end_col`` is."""
    days = F.datediff(end_col, N.START) + 1
    return df.withColumns({"duration_days": days, "duration_years": days / F.lit(365)})


def spell_problems(df: DataFrame, start: str = N.START, end: str = N.END) -> DataFrame:
    """One row: tours in all, those without a start (no fiscal year holds them), those that end before they start."""
    return df.agg(
        F.count("*").alias("tours"),
        F.count_if(F.col(start).isNull()).alias("without_start"),
        F.count_if(F.col(end) < F.col(start)).alias("reversed"),
    )


def expand_fiscal_years(df: DataFrame, start: str = N.START, end: str = N.END_OR_PRESENT) -> DataFrame:
    """One row per tour and fiscal year that the tour touches.

    A reversed spell covers the years between its two dates. A NULL date gives no row.
    """
    first, last = fiscal_year(F.col(start)), fiscal_year(F.col(end))
    known = first.isNotNull() & last.isNotNull()
    years = F.when(known, F.sequence(F.least(first, last), F.greatest(first, last)))
    return df.withColumn(N.FISCAL_YEAR, F.explode(years))


def location_for_year(df: DataFrame, start: str = N.START, end: str = N.END_OR_PRESENT) -> DataFrame:
    """Location in each fiscal year: the first one before the spell's rounded mean year, then the last.

    The years of a spell are consecutive, so their mean is the mean of both ends and
    needs no window. Ties round to the even year.
    """
    middle = F.bround((fiscal_year(F.col(start)) + fiscal_year(F.col(end))) / F.lit(2), 0)
    location = F.when(F.col(N.FISCAL_YEAR) < middle, F.col(N.LOCATION_FIRST)).otherwise(F.col(N.LOCATION_LAST))
    return df.withColumn(N.LOCATION_AVERAGED, location)


def present_on(df: DataFrame, date: dt.date, as_of: dt.date, start: str = N.START, end: str = N.END) -> DataFrame:
    """Tours under way on ``date``; the end day itself does not count.

    Open tours end at ``as_of``. The test is on the stored columns, so it reaches a Parquet scan.
    """
    still_open = F.col(end).isNull() if as_of > date else F.lit(False)
    return df.where((F.col(start) <= F.lit(date)) & ((F.col(end) > F.lit(date)) | still_open))


def month_calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per month start from ``first`` to ``last``."""
    months = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 MONTH")))
    return spark.range(0, 1, 1, 1).select(months.alias("month"))


def _month_on_or_after(date: Column) -> Column:
    return F.add_months(F.trunc(F.date_sub(date, 1), "month"), 1)


def monthly_headcount(
    df: DataFrame,
    first: dt.date,
    as_of: dt.date,
    where: Column | None = None,
    start: str = N.START,
    end: str = N.END,
) -> DataFrame:
    """Tours under way on the first of each month, with changes against 1 and 12 months before.

    Each spell adds one at its first month and takes one off at the first month it has
    left; the deltas are summed per month before anything is ordered, so the windows run
    over the calendar's months only. Months with nobody stay, as 0. A change in percent of
    nothing is NULL.
    """
    if first.day != 1:
        raise ValueError("the series starts on the first of a month")
    rows = df if where is None else df.where(where)
    effective_end = F.coalesce(end, F.lit(as_of))
    spells = rows.select(F.col(start).alias("s"), effective_end.alias("e")).where("e > s")
    steps = F.array(
        F.struct(F.greatest(_month_on_or_after(F.col("s")), F.lit(first)).alias("month"), F.lit(1).alias("step")),
        F.struct(F.greatest(_month_on_or_after(F.col("e")), F.lit(first)).alias("month"), F.lit(-1).alias("step")),
    )
    deltas = spells.select(F.inline(steps)).groupBy("month").agg(F.sum("step").alias("step"))

    in_order = Window.orderBy("month")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    series = (
        month_calendar(df.sparkSession, first, as_of)
        .join(deltas, "month", "left")
        .select("month", F.sum(F.coalesce("step", F.lit(0))).over(so_far).alias("headcount"))
    )

    def before(months: int) -> Column:
        return F.lag("headcount", months, 0).over(in_order)

    change_month, change_year = F.col("headcount") - before(1), F.col("headcount") - before(12)
    return series.select(
        "month",
        "headcount",
        change_month.alias("change_prev_month"),
        change_year.alias("change_prev_year"),
        F.bround(share(change_month, before(1)) * 100, 2).alias("pct_change_month"),
        F.bround(share(change_year, before(12)) * 100, 2).alias("pct_change_year"),
    )


def merge_tours(
    df: DataFrame,
    as_of: dt.date,
    switch_value: str = N.SWITCH,
    tours_per_piece: int = TOURS_PER_PIECE,
) -> DataFrame:
    """Merge tours that continue one another, then measure them up to ``as_of``.

    A tour that ended with ``switch_value``, and the tour after it, both join the person's
    *first* tour, across gaps and whatever lies between. A merged tour takes the first
    start and arrival source and the last end and discipline, in tour order. A tour key
    (person, tour number) that occurs more than once is one tour.

    "The tour before" is looked up inside pieces of a person's tours; a second, much
    smaller step passes the last tour of each piece on to the next one. So no task holds
    all rows of a person.
    """
    # Keys that cannot be NULL keep Spark from filtering only one side of the join below.
    keyed = df.withColumns({N.PERSON: F.coalesce(N.PERSON, F.lit(_NO_NAME)), N.TOUR: F.coalesce(N.TOUR, F.lit(1))})
    order_in_tour = [F.col(N.START), F.col(N.END).isNull().alias("open"), F.col(N.END)]
    tours = (
        keyed.groupBy(N.PERSON, N.TOUR)
        .agg(
            F.min(F.struct(*order_in_tour, N.SOURCE)).alias("first"),
            F.max(F.struct(*order_in_tour, N.DISCIPLINE)).alias("last"),
            F.max(F.coalesce(F.col(N.DEPARTURE) == switch_value, F.lit(False))).alias("switch"),
        )
        .withColumn("piece", F.coalesce(F.floor(F.col(N.TOUR) / tours_per_piece).cast("int"), F.lit(0)))
        .repartition(N.PERSON, "piece")
    )

    in_piece = Window.partitionBy(N.PERSON, "piece").orderBy(N.TOUR)
    stepped = tours.withColumn("follows", F.lag("switch").over(in_piece))

    # The counts are always positive. They make this side read the same columns as the
    # other one, so both use one shuffle and the tours are computed once.
    of_person = Window.partitionBy(N.PERSON).orderBy("piece")
    pieces = (
        tours.groupBy(N.PERSON, "piece")
        .agg(
            F.min(N.TOUR).alias("piece_first"),
            last_flag(N.TOUR, F.col("switch")).alias("piece_last"),
            F.count("first").alias("starts"),
            F.count("last").alias("ends"),
        )
        .where("starts > 0 AND ends > 0")
        .select(
            N.PERSON,
            "piece",
            F.first("piece_first").over(of_person).alias("first_tour"),
            F.lag("piece_last", 1, False).over(of_person).alias("carried"),
        )
    )

    joins_first = F.col("switch") | F.coalesce("follows", "carried")
    merged = (
        stepped.join(pieces, [N.PERSON, "piece"], "left")
        .select(
            N.PERSON,
            F.when(joins_first, F.coalesce("first_tour", N.TOUR)).otherwise(F.col(N.TOUR)).alias("merged_tour"),
            F.struct(N.TOUR, "first").alias("first"),
            F.struct(N.TOUR, "last").alias("last"),
        )
        .groupBy(N.PERSON, "merged_tour")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .select(
            F.nullif(N.PERSON, F.lit(_NO_NAME)).alias(N.PERSON),
            F.col("merged_tour").alias(N.TOUR),
            F.col(f"first.first.{N.START}").alias(N.START),
            F.col(f"last.last.{N.END}").alias(N.END),
            F.col(f"last.last.{N.DISCIPLINE}").alias("most_recent_discipline_initial"),
            F.col(f"first.first.{N.SOURCE}").alias("initial_arrival_source"),
        )
    )
    return add_duration(add_effective_end(merged, as_of), N.END_OR_PRESENT)
