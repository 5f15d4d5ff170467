"""The reports and series feeds, one function of ``Tables`` each.

Reports return unrounded values where only publishing rounds them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tourledger import names as N
from tourledger.operators import people, progress, shares, spells
from tourledger.operators.summary import fiscal_summary
from tourledger.plans.tables import Tables

Report = Callable[[Tables], DataFrame]


# Arrivals and headcount


def arrivals(t: Tables) -> DataFrame:
    return t.arrivals


def headcount_individual_staff(t: Tables) -> DataFrame:
    return shares.count_rows(t.persons, "total_individual_staff")


def arrivals_by_source(t: Tables) -> DataFrame:
    tours = t.tours.select(N.PERSON, N.TOUR, N.SOURCE).distinct()
    known = tours.withColumn(N.SOURCE, shares.known_category(F.col(N.SOURCE)))
    return shares.category_share(known, N.SOURCE, "onboarded_count")


def arrivals_by_discipline(t: Tables) -> DataFrame:
    # Ordered anew: stored rows come in no order.
    return t.arrivals_by_discipline.orderBy(F.desc("arrivals_by_discipline_count"), *shares.ascending(N.DISCIPLINE))


def arrivals_by_fiscal_year(t: Tables) -> DataFrame:
    return shares.distinct_persons_by(t.tours, [N.START_FY], "arrivals")


def headcount_current(t: Tables) -> DataFrame:
    return shares.count_rows(people.current_staff(t.persons), "headcount_current")


def headcount_joined_within_past_12_months(t: Tables) -> DataFrame:
    return people.current_headcount(t.persons, t.inputs.as_of)


def headcount_by_discipline(t: Tables) -> DataFrame:
    return people.headcount_by_latest_discipline(t.persons)


def headcount_by_fiscal_year(t: Tables) -> DataFrame:
    return t.person_years.groupBy(N.FISCAL_YEAR).agg(F.count("*").alias("headcount")).orderBy(N.FISCAL_YEAR)


def discipline_count_by_fiscal_year(t: Tables) -> DataFrame:
    return shares.distinct_persons_by(t.tour_years, [N.FISCAL_YEAR, N.DISCIPLINE], "discipline_count")


# Departures and turnover


def departures(t: Tables) -> DataFrame:
    ended = t.tours.where(F.col(N.END).isNotNull() & (F.col(N.DEPARTURE) != N.SWITCH))
    return shares.count_distinct_rows(ended, [N.PERSON, N.END, N.DEPARTURE], "total_departed")


def departures_by_fiscal_year(t: Tables) -> DataFrame:
    return shares.distinct_persons_by(t.tours.where(F.col(N.END).isNotNull()), [N.END_FY], "departures")


def departures_excluding_students(t: Tables) -> DataFrame:
    return t.departure_counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_departed"))


def new_hire_turnover_under_1_year(t: Tables) -> DataFrame:
    return people.early_turnover(t.departure_counts, t.arrivals)


def new_hire_turnover_under_1_year_by_discipline(t: Tables) -> DataFrame:
    return people.early_turnover_by_discipline(t.departure_counts, t.arrivals_by_discipline)


def departure_type(t: Tables) -> DataFrame:
    return shares.category_share(
        t.departure_counts,
        N.DEPARTURE,
        "departure_count",
        "departure_type_percentage",
        combined="departure_type_combined",
        weight="n",
    )


def departure_type_by_discipline(t: Tables) -> DataFrame:
    return shares.share_within(
        t.departure_counts, N.DISCIPLINE, N.DEPARTURE, "departure_count", "departure_type_percentage", "n"
    )


def departure_type_by_arrival_source(t: Tables) -> DataFrame:
    return shares.share_within(
        t.departure_counts, N.SOURCE, N.DEPARTURE, "departure_count", "departure_type_percentage", "n"
    )


def summary_departure_type_by_discipline_percentages(t: Tables) -> DataFrame:
    return shares.share_pivot(
        departure_type_by_discipline(t),
        N.DISCIPLINE,
        N.DEPARTURE,
        "departure_count",
        "departure_type_percentage",
        values=t.departure_types(N.DEPARTURE_TYPES),
    )


def summary_departure_type_by_arrival_source_percentages(t: Tables) -> DataFrame:
    return shares.share_pivot(
        departure_type_by_arrival_source(t),
        N.SOURCE,
        N.DEPARTURE,
        "departure_count",
        "departure_type_percentage",
        drop="from_other_staffing_program",
        values=t.departure_types(N.DEPARTURE_TYPES_BY_SOURCE),
    )


def departure_type_joined_from_outside_government(t: Tables) -> DataFrame:
    outside = t.departure_counts.where(F.col(N.SOURCE).isin(*t.inputs.outside_government))
    return shares.category_share(outside, N.DEPARTURE, "departure_count", "departure_type_percentage", weight="n")


# Tours and locations


def multiple_tours_by_discipline(t: Tables) -> DataFrame:
    return people.repeat_tours(t.persons, "first_discipline", N.DISCIPLINE, "multiple_tours_by_discipline_count")


def multiple_tours_by_initial_staffing_program(t: Tables) -> DataFrame:
    return people.repeat_tours(t.persons, "first_program", N.PROGRAM, "multiple_tours_by_initial_staffing_program_count")


def multiple_tours_students_tour_number(t: Tables) -> DataFrame:
    return people.program_tour_numbers(t.persons)


def location_in_out_ncr_by_fiscal_year(t: Tables) -> DataFrame:
    return people.home_region_by_year(t.person_years)


def location_changed_while_at_cds(t: Tables) -> DataFrame:
    return people.moved_flag_counts(t.persons)


def summary_arrivals_departures_headcount_by_fiscal_year(t: Tables) -> DataFrame:
    return fiscal_summary(t.person_years)


# Tenure and duration


def _current(t: Tables) -> DataFrame:
    return t.merged.where(F.col(N.END).isNull())


def _settled(t: Tables) -> DataFrame:
    return people.started_before(t.merged, t.inputs.as_of)


def tenure_average(t: Tables) -> DataFrame:
    return people.average_duration(_current(t), name="average_tenure_years")


def tenure_headcount_bins(t: Tables) -> DataFrame:
    return shares.count_by_bin(_current(t))


def duration_average(t: Tables) -> DataFrame:
    return people.average_duration(_settled(t))


def duration_average_by_discipline(t: Tables) -> DataFrame:
    return people.average_duration(_settled(t), "most_recent_discipline_initial")


def duration_quantiles(t: Tables) -> DataFrame:
    return people.duration_quantiles(_settled(t))


def duration_average_by_arrival_source(t: Tables) -> DataFrame:
    known = _settled(t).where("initial_arrival_source IS NOT NULL")
    return people.average_duration(known, "initial_arrival_source")


# Promotions


def _not_students(t: Tables) -> DataFrame:
    return progress.not_from_group(t.progression)


def _with_bins(df: DataFrame) -> DataFrame:
    return df.withColumn(N.BINS, shares.duration_bin(F.col("duration_years")))


def _with_region(df: DataFrame, t: Tables) -> DataFrame:
    return df.withColumn(N.REGION, people.region_flag(F.col(N.LOCATION_LAST), t.inputs.home))


def classification_promotion(t: Tables) -> DataFrame:
    return progress.promotion_totals(t.progression)


def classification_promotion_excluding_students(t: Tables) -> DataFrame:
    return progress.promotion_totals(_not_students(t))


def classification_promotion_by_duration_years_bins(t: Tables) -> DataFrame:
    totals = progress.promotion_totals(_with_bins(t.progression), N.BINS, sort=False)
    return totals.orderBy(shares.duration_bin_order(F.col(N.BINS)))


def classification_promotion_by_latest_group(t: Tables) -> DataFrame:
    return progress.promotion_totals(t.progression, "latest_group", nonzero=True)


def classification_promotion_excluding_students_by_latest_group(t: Tables) -> DataFrame:
    return progress.promotion_totals(_not_students(t), "latest_group", nonzero=True)


def classification_promotion_by_discipline_initial(t: Tables) -> DataFrame:
    return progress.promotion_totals(t.progression, N.DISCIPLINE)


def classification_promotion_excluding_students_by_discipline_initial(t: Tables) -> DataFrame:
    return progress.promotion_totals(_not_students(t), N.DISCIPLINE)


def classification_promotion_by_in_or_out_of_ncr(t: Tables) -> DataFrame:
    return progress.promotion_totals(_with_region(t.progression, t), N.REGION)


def classification_promotion_excluding_students_by_in_or_out_of_ncr(t: Tables) -> DataFrame:
    return progress.promotion_totals(_with_region(_not_students(t), t), N.REGION)


def classification_change_or_level_increase(t: Tables) -> DataFrame:
    """Older measure: share with a change of group or a higher level, by discipline."""
    flag = "has_classification_change_or_level_increase"
    return progress.promotion_totals(t.progression, N.DISCIPLINE, flag=flag, count=flag)


def classification_promotion_breakdowns(t: Tables) -> DataFrame:
    """The overall, group, discipline, region and bin totals in one pass."""
    df = _with_region(_with_bins(t.progression), t)
    return progress.promotion_breakdowns(df, ["latest_group", N.DISCIPLINE, N.REGION, N.BINS])


# Series feeds


def arrival_source_proportion_series(t: Tables) -> DataFrame:
    return arrival_source_count_series(t).drop("n")


def arrival_source_count_series(t: Tables) -> DataFrame:
    labelled = shares.apply_labels(t.tours, N.SOURCE, N.ARRIVAL_SOURCE_LABELS, default="other")
    return shares.proportion_series(labelled, N.START_FY, N.SOURCE)


def location_series(t: Tables) -> DataFrame:
    return shares.apply_labels(location_in_out_ncr_by_fiscal_year(t), N.REGION, N.LOCATION_LABELS)


def tenure_histogram_current(t: Tables) -> DataFrame:
    return shares.histogram(_current(t), "duration_years", 0.5)


def tenure_histogram_all(t: Tables) -> DataFrame:
    return shares.histogram(t.merged, "duration_years", 0.5)


def headcount_by_month(t: Tables) -> DataFrame:
    return spells.monthly_headcount(t.tours, t.inputs.first_month, t.inputs.as_of)


def headcount_by_month_slice(t: Tables) -> DataFrame:
    where = F.col(N.DISCIPLINE) == t.inputs.slice_discipline
    return spells.monthly_headcount(t.tours, t.inputs.first_month, t.inputs.as_of, where)


PUBLISHED: tuple[Report, ...] = (
    arrivals,
    headcount_individual_staff,
    arrivals_by_source,
    departures,
    arrivals_by_fiscal_year,
    departures_by_fiscal_year,
    headcount_current,
    headcount_joined_within_past_12_months,
    headcount_by_discipline,
    headcount_by_fiscal_year,
    discipline_count_by_fiscal_year,
    arrivals_by_discipline,
    departures_excluding_students,
    new_hire_turnover_under_1_year,
    new_hire_turnover_under_1_year_by_discipline,
    multiple_tours_by_discipline,
    multiple_tours_by_initial_staffing_program,
    multiple_tours_students_tour_number,
    location_in_out_ncr_by_fiscal_year,
    location_changed_while_at_cds,
    departure_type,
    departure_type_by_discipline,
    departure_type_by_arrival_source,
    summary_departure_type_by_discipline_percentages,
    summary_departure_type_by_arrival_source_percentages,
    departure_type_joined_from_outside_government,
    summary_arrivals_departures_headcount_by_fiscal_year,
    tenure_average,
    tenure_headcount_bins,
    duration_average,
    duration_average_by_discipline,
    duration_quantiles,
    duration_average_by_arrival_source,
    classification_promotion,
    classification_promotion_excluding_students,
    classification_promotion_by_duration_years_bins,
    classification_promotion_by_latest_group,
    classification_promotion_excluding_students_by_latest_group,
    classification_promotion_by_discipline_initial,
    classification_promotion_excluding_students_by_discipline_initial,
    classification_promotion_by_in_or_out_of_ncr,
    classification_promotion_excluding_students_by_in_or_out_of_ncr,
)

FEEDS: tuple[Report, ...] = (
    arrival_source_proportion_series,
    arrival_source_count_series,
    location_series,
    tenure_histogram_current,
    tenure_histogram_all,
    headcount_by_month,
    headcount_by_month_slice,
)

REPORTS: dict[str, Report] = {report.__name__: report for report in PUBLISHED}
SERIES: dict[str, Report] = {report.__name__: report for report in FEEDS}
