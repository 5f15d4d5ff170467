"""Person-level operators: first and last attributes, headcount, turnover, repeat tours, moves.

All of them aggregate by person with map-side combining and keep no window over a
person's rows, so a person with very many tours does not end up in one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tourledger import names as N
from tourledger.functions.numbers import share
from tourledger.operators.shares import ascending, with_total

MOST_RECENT_START = "most_recent_start_date"


def _row_at(pick: Callable[[Column], Column], order: str, cols: Sequence[str]) -> Column:
    """The row with the smallest or largest ``order``; equal orders are settled by the values."""
    return pick(F.when(F.col(order).isNotNull(), F.struct(order, *cols)))


def last_row(order: str, *cols: str) -> Column:
    """Aggregate: struct of ``cols`` where ``order`` is largest; NULL values are kept."""
    return _row_at(F.max, order, cols)


def first_row(order: str, *cols: str) -> Column:
    """Aggregate: struct of ``cols`` where ``order`` is smallest; NULL values are kept."""
    return _row_at(F.min, order, cols)


def last_flag(order: str, flag: Column) -> Column:
    """Aggregate: a flag, never NULL, where the integer ``order`` is largest.

    Order and flag share one long, which Spark aggregates by hash, where structs and text
    would be sorted first.
    """
    return F.max(F.col(order).cast("long") * 2 + flag.cast("int")).bitwiseAND(1) == 1


def first_and_last_by(
    df: DataFrame, key: str, order: str, first: dict[str, str], last: dict[str, str]
) -> DataFrame:
    """One row per key with the ``first`` columns at its smallest ``order`` and the ``last`` ones at its largest.

    Both map input names to output names. One pass, and one struct per end.
    """
    ends = {"_first": (first_row, first), "_last": (last_row, last)}
    rows = [row(order, *cols).alias(name) for name, (row, cols) in ends.items() if cols]
    found = df.groupBy(key).agg(*rows)
    return found.select(
        key, *[F.col(f"{name}.{c}").alias(out) for name, (_, cols) in ends.items() for c, out in cols.items()]
    )


def latest_by(df: DataFrame, key: str, order: str, cols: dict[str, str]) -> DataFrame:
    """One row per key with the values at its largest ``order``; ``cols`` maps input to output names."""
    return first_and_last_by(df, key, order, {}, cols)


def earliest_by(df: DataFrame, key: str, order: str, cols: dict[str, str]) -> DataFrame:
    """As ``latest_by``, at the smallest ``order``."""
    return first_and_last_by(df, key, order, cols, {})


def person_facts(tours: DataFrame) -> DataFrame:
    """One row per person with all that the reports on persons need, in one pass over the tours.

    Highest tour number; discipline, programme and location at the first tour; discipline,
    location and source at the last; whether a tour is open, and the latest start of those
    that are; whether a tour has no start. A report from unstored tours computes what it reads.
    """
    is_open = F.col(N.END).isNull()
    facts = tours.groupBy(N.PERSON).agg(
        F.max(N.TOUR).alias("highest_tour_number"),
        first_row(N.TOUR, N.DISCIPLINE, N.PROGRAM).alias("_first"),
        first_row(N.TOUR, N.LOCATION_FIRST).alias("_first_location"),
        last_row(N.TOUR, N.DISCIPLINE, N.LOCATION_LAST, N.SOURCE).alias("_last"),
        last_row(N.TOUR, N.LOCATION_LAST).alias("_last_location"),
        F.max(is_open).alias("present"),
        F.max(F.when(is_open, F.col(N.START))).alias(MOST_RECENT_START),
        F.max(F.col(N.START).isNull()).alias("undated"),
    )
    return facts.select(
        N.PERSON,
        "highest_tour_number",
        F.col(f"_first.{N.DISCIPLINE}").alias("first_discipline"),
        F.col(f"_first.{N.PROGRAM}").alias("first_program"),
        F.col(f"_first_location.{N.LOCATION_FIRST}").alias("first_location"),
        F.col(f"_last.{N.DISCIPLINE}").alias("last_discipline"),
        F.col(f"_last_location.{N.LOCATION_LAST}").alias("last_location"),
        F.col(f"_last.{N.LOCATION_LAST}").alias("last_tour_location"),
        F.col(f"_last.{N.SOURCE}").alias("last_source"),
        "present",
        MOST_RECENT_START,
        "undated",
    )


def current_staff(persons: DataFrame) -> DataFrame:
    """Persons with an open tour and the latest start among their open tours; from ``person_facts``."""
    return persons.where("present").select(N.PERSON, MOST_RECENT_START)


def current_headcount(persons: DataFrame, as_of: dt.date, days: int = 365) -> DataFrame:
    """One row: recent joiners, headcount and the share of joiners of the last ``days`` days."""
    recent = F.col(MOST_RECENT_START) >= F.date_sub(F.lit(as_of), days)
    joined = "headcount_joined_within_past_12_months"
    return (
        current_staff(persons)
        .agg(F.count_if(recent).alias(joined), F.count("*").alias("headcount_current"))
        .withColumn("percentage", share(F.col(joined), F.col("headcount_current")))
    )


def headcount_by_latest_discipline(persons: DataFrame) -> DataFrame:
    """Persons with an open tour, by the discipline of their last tour, with shares; from ``person_facts``."""
    counts = (
        persons.where("present")
        .groupBy(F.col("last_discipline").alias(N.DISCIPLINE))
        .agg(F.count("*").alias("count_by_discipline"))
    )
    percentage = F.bround(share(F.col("count_by_discipline"), F.col("total_count")), 4)
    return (
        with_total(counts, "count_by_discipline")
        .withColumn("percentage", percentage)
        .orderBy(F.desc("count_by_discipline"), *ascending(N.DISCIPLINE))
    )


def departures_excluding(df: DataFrame, program: str = N.STUDENT, switch_value: str = N.SWITCH) -> DataFrame:
    """Ended tours, without one staffing programme and without switches to full time."""
    return df.where(
        F.col(N.END).isNotNull() & (F.col(N.PROGRAM) != program) & (F.col(N.DEPARTURE) != switch_value)
    )


def _under_one_year() -> Column:
    return F.coalesce(F.col("duration_years") < 1, F.lit(False)).cast("int")


def departure_counts(departures: DataFrame) -> DataFrame:
    """Number ``n`` of departures per discipline, source, type and whether under one year."""
    under = _under_one_year().alias("departed_under_1_year")
    return departures.groupBy(N.DISCIPLINE, N.SOURCE, N.DEPARTURE, under).agg(F.count("*").alias("n"))


def early_turnover(counted: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Departures under one year and later, from ``departure_counts``, each against the one-row arrivals total."""
    counts = counted.groupBy("departed_under_1_year").agg(F.sum("n").alias("departure_count"))
    percentage = F.bround(share(F.col("departure_count"), F.col("total_onboarded")), 4)
    return (
        counts.crossJoin(F.broadcast(arrivals.select("total_onboarded")))
        .withColumn("departure_percentage", percentage)
        .orderBy("departed_under_1_year")
    )


def early_turnover_by_discipline(counted: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Disciplines with departures under one year, their share of the discipline's arrivals.

    ``counted`` is a table of ``departure_counts``. The departures total that is shown is not the denominator.
    """
    counts = (
        counted.groupBy(N.DISCIPLINE)
        .agg(
            F.sum(F.col("departed_under_1_year") * F.col("n")).alias("departed_under_1_year_count"),
            F.sum("n").alias("total_departure_count"),
        )
        .where("departed_under_1_year_count > 0")
        .alias("d")
    )
    arrived = arrivals.select(N.DISCIPLINE, "arrivals_by_discipline_count").alias("a")
    fraction = share(F.col("departed_under_1_year_count"), F.col("arrivals_by_discipline_count"))
    return (
        counts.join(arrived, F.col(f"d.{N.DISCIPLINE}").eqNullSafe(F.col(f"a.{N.DISCIPLINE}")), "left")
        .select("d.*", "arrivals_by_discipline_count")
        .withColumn("departed_under_1_year_percentage", F.bround(fraction, 4))
        .orderBy(F.desc("departed_under_1_year_percentage"), *ascending(N.DISCIPLINE))
    )


def repeat_tours(persons: DataFrame, attribute: str, by: str, name: str) -> DataFrame:
    """Persons with more than one tour, by an attribute in ``person_facts``, published as ``by``."""
    repeated = persons.where("highest_tour_number > 1").groupBy(F.col(attribute).alias(by))
    return repeated.agg(F.count("*").alias(name)).orderBy(F.desc(name), *ascending(by))


def program_tour_numbers(persons: DataFrame, program: str = N.STUDENT) -> DataFrame:
    """Persons who started in one programme, by their highest tour number; from ``person_facts``."""
    people = persons.where(F.col("first_program") == program)
    counts = people.groupBy("highest_tour_number").agg(F.count("*").alias("students_count"))
    return counts.orderBy("highest_tour_number")


def region_flag(location: Column, home: str = N.HOME_REGION) -> Column:
    """``in_ncr`` for the home region, ``outside_ncr`` for all else and for NULL."""
    return F.when(location == home, "in_ncr").otherwise("outside_ncr")


def person_years(tour_years: DataFrame, home: str = N.HOME_REGION) -> DataFrame:
    """One row per person and fiscal year: ``outside`` the home region by the last tour's location
    in that year, ``arrived`` and ``departed`` in it.

    A tour touches the years of its own start and end, so one grouping gives all three.
    """
    in_year = lambda year: F.max(F.coalesce(F.col(year) == F.col(N.FISCAL_YEAR), F.lit(False)))
    outside = region_flag(F.col(N.LOCATION_AVERAGED), home) == "outside_ncr"
    return tour_years.groupBy(N.PERSON, N.FISCAL_YEAR).agg(
        last_flag(N.TOUR, outside).alias("outside"),
        in_year(N.START_FY).alias("arrived"),
        in_year(N.END_FY).alias("departed"),
    )


def home_region_by_year(person_years: DataFrame) -> DataFrame:
    """Persons in and outside the home region per fiscal year, with the share in the year.

    The two regions are counted side by side per year and unfolded into rows after that.
    """
    years = person_years.groupBy(N.FISCAL_YEAR).agg(
        F.count("*").alias("total_staff_count"), F.count_if("outside").alias("outside")
    )
    regions = F.array(
        F.struct(
            F.lit("in_ncr").alias(N.REGION),
            (F.col("total_staff_count") - F.col("outside")).alias("location_in_out_count"),
        ),
        F.struct(F.lit("outside_ncr").alias(N.REGION), F.col("outside").alias("location_in_out_count")),
    )
    percentage = F.bround(share(F.col("location_in_out_count"), F.col("total_staff_count")), 4)
    return (
        years.select(N.FISCAL_YEAR, "total_staff_count", F.inline(regions))
        .where("location_in_out_count > 0")
        .select(
            N.FISCAL_YEAR,
            N.REGION,
            "location_in_out_count",
            "total_staff_count",
            percentage.alias("location_percentage"),
        )
        .orderBy(N.FISCAL_YEAR, N.REGION)
    )


def moved_flag_counts(persons: DataFrame) -> DataFrame:
    """Persons whose first and last location differ (1) or not (0); an unknown location is 0."""
    moved = F.col("first_location") != F.col("last_location")
    flag = F.coalesce(moved, F.lit(False)).cast("int").alias("location_changed_at_cds")
    return persons.groupBy(flag).agg(F.count("*").alias("count")).orderBy("location_changed_at_cds")


def started_before(df: DataFrame, as_of: dt.date, days: int = 365) -> DataFrame:
    """Rows that started more than ``days`` days before ``as_of``."""
    return df.where(F.col(N.START) < F.date_sub(F.lit(as_of), days))


def average_duration(df: DataFrame, by: str | None = None, name: str = "average_duration_years") -> DataFrame:
    """Mean duration in years: one row, or per group with the group's size, longest first."""
    mean = F.avg("duration_years").alias(name)
    if by is None:
        return df.agg(mean)
    groups = df.groupBy(by).agg(mean, F.count("*").alias("arrivals_count"))
    return groups.orderBy(F.desc(name), *ascending(by))


def duration_quantiles(df: DataFrame, probs: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """Exact, linearly interpolated quantiles of the duration in years, one row per probability.

    Durations are counted per value first. They come from whole days between two dates,
    so the final step holds one counter per distinct number of days, whatever the row count.
    """
    counted = df.where("duration_years IS NOT NULL").groupBy("duration_years").agg(F.count("*").alias("n"))
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    values = counted.agg(F.percentile("duration_years", wanted, F.col("n")).alias("v"))
    pairs = F.arrays_zip(F.col("v").alias("duration_years"), wanted.alias("q"))
    return values.select(F.inline(pairs).alias("duration_years", "q"))


