"""Every query: a callable from (spark, folder of driver tables) to a lazy DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from checks import fixtures
from tourledger import names as N
from tourledger.functions import calendar, sql
from tourledger.operators import cleaning, densify, intervals, people, quantiles, salary, spells
from tourledger.plans import quality, reports
from tourledger.plans.tables import Tables
from tourledger.sources.board import import_board_cards
from tourledger.sources.inference import type_report
from tourledger.sources.publish import publishable
from tourledger.sources.schemas import INPUT_SCHEMAS
from tourledger.sources.tables import INPUT_ORDER, read_raw

Query = Callable[[SparkSession, str], DataFrame]

PRESENT_ON = dt.date(1999, 7, 1)


@lru_cache(maxsize=4)
def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The lazy tables over one folder. Plans are kept, not data: every query runs in full."""
    return Tables(fixtures.inputs(spark, sf_dir))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles, for results whose last digits depend on the order of additions."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: F.bround(c, digits) for c in doubles})


def _roster_names(t: Tables) -> tuple[DataFrame, DataFrame]:
    return t.roster, t.tours.withColumn(cleaning.NAME_KEY, F.upper(N.PERSON))


def _with_roster(t: Tables) -> DataFrame:
    return cleaning.join_with_aliases(t.tours, t.inputs.name_harmonization, t.roster)


def _pay_rows(t: Tables) -> DataFrame:
    rates = cleaning.parse_pay_rates(t.inputs.pay_rates)
    return salary.add_pooled_median(rates, ["group", "level"], ["min", "max"])


def _tour_salaries(t: Tables) -> DataFrame:
    paid = salary.attach_salary(_with_roster(t), _pay_rows(t))
    return paid.select(
        N.PERSON,
        N.TOUR,
        "earliest_group",
        "earliest_level",
        "latest_group",
        "latest_level",
        "earliest_median_salary",
        "latest_median_salary",
        "salary_change_percentage",
    )


def _fiscal_calendar(t: Tables) -> DataFrame:
    start = F.col(N.START)
    label = calendar.fiscal_year_label(start)
    return t.tours.select(
        N.PERSON,
        N.TOUR,
        N.START,
        N.START_FY,
        calendar.fiscal_quarter(start).alias("quarter"),
        label.alias("fiscal_year_label"),
        calendar.fiscal_label_to_year(label).alias("label_year"),
        calendar.reporting_period(start).alias("reporting_period"),
    )


def _first_and_last(t: Tables) -> DataFrame:
    return people.first_and_last_by(
        t.tours,
        N.PERSON,
        N.TOUR,
        {N.LOCATION_FIRST: "first_location", N.PROGRAM: "first_program"},
        {N.DISCIPLINE: "last_discipline", N.SOURCE: "last_source"},
    )


def _tours_by_fiscal_year(t: Tables) -> DataFrame:
    return t.tour_years.select(N.PERSON, N.TOUR, N.DISCIPLINE, N.START_FY, N.END_FY, N.FISCAL_YEAR)


def _location_by_fiscal_year(t: Tables) -> DataFrame:
    return t.tour_years.select(
        N.PERSON, N.TOUR, N.FISCAL_YEAR, N.LOCATION_FIRST, N.LOCATION_LAST, N.LOCATION_AVERAGED
    )


def _present(t: Tables) -> DataFrame:
    present = spells.present_on(t.tours, PRESENT_ON, t.inputs.as_of)
    return present.select(N.PERSON, N.TOUR, N.START, N.END)


def _present_on_dates(t: Tables) -> DataFrame:
    """Tours under way at the beginning of each quarter in which one starts."""
    quarters = t.tours.select(F.trunc(N.START, "quarter").alias("date"))
    present = intervals.present_on_dates(t.tours, quarters, t.inputs.as_of)
    return present.select("date", N.PERSON, N.TOUR, N.START, N.END)


def _densified_assignments(t: Tables) -> DataFrame:
    """Every person's discipline and location every four weeks, as of the last tour begun."""
    return densify.densify(t.tours, [N.PERSON], N.START, [N.DISCIPLINE, N.LOCATION_LAST], 28)


def _duration_quantiles_by_discipline(t: Tables) -> DataFrame:
    discipline = "most_recent_discipline_initial"
    return quantiles.group_quantiles(t.merged, [discipline], "duration_years", [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1], "duration_years")


def _inferred_types(t: Tables) -> DataFrame:
    """The types that the input tables' values allow, if all were text."""
    reports = []
    for name in INPUT_SCHEMAS:
        report = type_report(getattr(t.inputs, name))
        reports.append(report.withColumn("column_name", F.concat(F.lit(f"{name}."), "column_name")))
    return reduce(DataFrame.unionByName, reports)


def _presence_in_sql(t: Tables) -> DataFrame:
    """Tours under way on a date by discipline and period of arrival, in SQL alone."""
    spark = t.inputs.tenure_raw.sparkSession
    t.tours.createOrReplaceTempView("tourledger_tours")
    sql.register(spark, "tourledger_tours")
    return spark.sql(f"""
SELECT title_case({N.DISCIPLINE}) AS discipline, reporting_period({N.START}) AS arrival_period,
  fiscal_label_to_year(max(fiscal_year_label({N.START}))) AS arrival_year, count(*) AS tours,
  percent_text(share(count_if(duration_bin(duration_years({N.START}, DATE'{PRESENT_ON}')) = '{N.DURATION_BINS[0]}'), count(*)), count(*)) AS under_1_year,
  two_decimals(share(sum(duration_days({N.START}, DATE'{PRESENT_ON}')), count(*))) AS average_days
FROM tours_present_on(DATE'{PRESENT_ON}', DATE'{t.inputs.as_of}') GROUP BY ALL""")


def _orders_in_input_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's first and last order as the file has them, which nothing else tells."""
    orders = read_raw(spark, f"{sf_dir}/orders.parquet", order=True)
    first, last = F.min_by("o_orderkey", INPUT_ORDER), F.max_by("o_orderkey", INPUT_ORDER)
    return orders.groupBy("o_custkey").agg(first.alias("first_order"), last.alias("last_order"), F.count("*").alias("orders"))


OPERATORS: dict[str, reports.Report] = {
    "roster_dates": lambda t: cleaning.sentinel_to_null(t.inputs.level_raw, ["earliest_date", "latest_date"]),
    "clean_roster": lambda t: t.roster,
    "tours_with_roster": _with_roster,
    "name_mismatches": lambda t: cleaning.name_mismatches(*_roster_names(t)),
    "duplicate_lookup_keys": quality.duplicate_lookup_keys,
    "data_quality": quality.quality_report,
    "parsed_pay_rates": lambda t: cleaning.parse_pay_rates(t.inputs.pay_rates),
    "median_pay_rates": _pay_rows,
    "inferred_types": _inferred_types,
    "presence_in_sql": _presence_in_sql,
    "cleaned_tours": lambda t: t.tours,
    "tour_salaries": _tour_salaries,
    "spell_problems": lambda t: spells.spell_problems(t.tours),
    "fiscal_calendar": _fiscal_calendar,
    "tours_by_fiscal_year": _tours_by_fiscal_year,
    "location_by_fiscal_year": _location_by_fiscal_year,
    "merged_tours": lambda t: t.merged,
    "tours_present_on_date": _present,
    "tours_present_on_dates": _present_on_dates,
    "densified_assignments": _densified_assignments,
    "tours_at_once_by_discipline": lambda t: intervals.at_once(t.tours, [N.DISCIPLINE]),
    "most_tours_at_once_by_discipline": lambda t: intervals.most_at_once(t.tours, [N.DISCIPLINE]),
    "duration_quantiles_by_discipline": _duration_quantiles_by_discipline,
    "first_and_last_attributes": _first_and_last,
    "person_progression": lambda t: t.progression,
    "classification_change_or_level_increase": reports.classification_change_or_level_increase,
    "classification_promotion_breakdowns": reports.classification_promotion_breakdowns,
    "published_merged_tours": lambda t: publishable(t.merged),
    "published_summary": lambda t: publishable(reports.summary_arrivals_departures_headcount_by_fiscal_year(t)),
}

# Digits for queries whose doubles need rounding before a comparison by hash.
ROUNDED = {
    "tenure_average": 6,
    "duration_average": 6,
    "duration_average_by_discipline": 6,
    "duration_quantiles": 6,
    "duration_average_by_arrival_source": 6,
    "median_pay_rates": 6,
    "tour_salaries": 6,
    "cleaned_tours": 9,
    "merged_tours": 9,
    "duration_quantiles_by_discipline": 6,
    "person_progression": 6,
}


def _from_tables(name: str, report: reports.Report) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = report(tables(spark, sf_dir))
        return rounded(df, ROUNDED[name]) if name in ROUNDED else df

    return query


def queries() -> dict[str, Query]:
    registered = {**reports.REPORTS, **reports.SERIES, **OPERATORS}
    out = {name: _from_tables(name, report) for name, report in registered.items()}
    out["typed_orders"] = lambda spark, sf_dir: fixtures.table(spark, sf_dir, "orders")
    out["orders_in_input_order"] = _orders_in_input_order
    out["imported_board_cards"] = lambda spark, sf_dir: import_board_cards(fixtures.board_cards(spark, sf_dir))
    return out
