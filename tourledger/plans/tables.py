"""The intermediate tables that the reports share."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame

from tourledger import names as N
from tourledger.operators.cleaning import clean_roster, clean_tours, parse_pay_rates
from tourledger.operators.people import departure_counts, departures_excluding, person_facts, person_years
from tourledger.operators.progress import latest_attributes, person_progression
from tourledger.operators.salary import pooled_median
from tourledger.operators.shares import category_share, count_distinct_rows, pivot_values
from tourledger.operators.spells import (
    add_duration,
    add_effective_end,
    add_fiscal_years,
    expand_fiscal_years,
    location_for_year,
    merge_tours,
)

MEASURED_TOURS_PATH = "tours"
MERGED_TOURS_PATH = "merged_tours"
PROGRESSION_PATH = "progression"
PERSONS_PATH = "persons"
PERSON_YEARS_PATH = "person_years"
DEPARTURE_COUNTS_PATH = "departure_counts"
ARRIVALS_PATH = "arrivals"
ARRIVALS_BY_DISCIPLINE_PATH = "arrivals_by_discipline"


def measured_tours(tenure_raw: DataFrame, as_of: dt.date) -> DataFrame:
    """Cleaned tours with fiscal years, effective end and duration."""
    return add_duration(add_effective_end(add_fiscal_years(clean_tours(tenure_raw)), as_of))


@dataclasses.dataclass(frozen=True)
class Inputs:
    """Input tables and settings of one run. ``as_of`` stands for today and has no default."""

    tenure_raw: DataFrame
    level_raw: DataFrame
    name_harmonization: DataFrame
    pay_rates: DataFrame
    as_of: dt.date
    first_month: dt.date
    home: str = N.HOME_REGION
    slice_discipline: str = "Policy"
    outside_government: Sequence[str] = N.OUTSIDE_GOVERNMENT_SOURCES
    # Departure types besides the known ones, for the pivots' columns; None: those that the tours hold.
    other_departure_types: Sequence[str] | None = None


class Tables:
    """Lazy DataFrames derived from ``Inputs``; each is defined when first asked for.

    Grade data joins persons, not tours, so tour reports never pay for those joins. That
    equals joining every tour as long as the lookups' keys are unique, which a run's
    ``quality_report`` tells.
    """

    def __init__(self, inputs: Inputs) -> None:
        self.inputs = inputs

    @cached_property
    def tours(self) -> DataFrame:
        return measured_tours(self.inputs.tenure_raw, self.inputs.as_of)

    @cached_property
    def tour_years(self) -> DataFrame:
        return location_for_year(expand_fiscal_years(self.tours))

    @cached_property
    def departures(self) -> DataFrame:
        return departures_excluding(self.tours)

    @cached_property
    def departure_counts(self) -> DataFrame:
        return departure_counts(self.departures)

    @cached_property
    def _departure_types_found(self) -> list[str]:
        given = self.inputs.other_departure_types
        return pivot_values(self.departure_counts, N.DEPARTURE) if given is None else list(given)

    def departure_types(self, known: Sequence[str]) -> list[str]:
        """Columns of the departure pivots: the known ones, then others. Where the inputs do not name
        them, a job over the counts of departures finds them, once for all reports."""
        found = [value for value in self._departure_types_found if value not in known]
        return [*known, *sorted(found, key=lambda c: (not c.startswith("to_"), c))]

    @cached_property
    def persons(self) -> DataFrame:
        return person_facts(self.tours)

    @cached_property
    def person_years(self) -> DataFrame:
        return person_years(self.tour_years, self.inputs.home)

    @cached_property
    def arrivals(self) -> DataFrame:
        return count_distinct_rows(self.tours, [N.PERSON, N.TOUR], "total_onboarded")

    @cached_property
    def arrivals_by_discipline(self) -> DataFrame:
        pairs = self.tours.select(N.PERSON, N.DISCIPLINE).distinct()
        return category_share(pairs, N.DISCIPLINE, "arrivals_by_discipline_count", digits=4)

    @cached_property
    def merged(self) -> DataFrame:
        return merge_tours(self.tours, self.inputs.as_of)

    @cached_property
    def roster(self) -> DataFrame:
        return clean_roster(self.inputs.level_raw)

    @cached_property
    def pay_medians(self) -> DataFrame:
        return pooled_median(parse_pay_rates(self.inputs.pay_rates), ["group", "level"], ["min", "max"])

    @cached_property
    def progression(self) -> DataFrame:
        return person_progression(
            latest_attributes(self.persons),
            self.merged,
            self.inputs.name_harmonization,
            self.roster,
            self.pay_medians,
        )

    def write_to(self, folder: str) -> Tables:
        """The same tables, with those that several reports read written to ``folder`` as Parquet.

        ``folder`` must be storage that all executors share. Written tables keep column
        pruning and filter pushdown, cut the lineage and survive lost executors. No report
        reads the notes, so they are not stored.
        """
        stored = Tables(self.inputs)
        spark = self.inputs.tenure_raw.sparkSession

        def store(df: DataFrame, name: str) -> DataFrame:
            path = f"{folder.rstrip('/')}/{name}"
            df.write.mode("errorifexists").parquet(path)
            return spark.read.schema(df.schema).parquet(path)

        stored.tours = store(self.tours.drop(N.NOTES), MEASURED_TOURS_PATH)
        stored.merged = store(stored.merged, MERGED_TOURS_PATH)
        stored.persons = store(stored.persons, PERSONS_PATH)
        stored.progression = store(stored.progression, PROGRESSION_PATH)
        stored.person_years = store(stored.person_years, PERSON_YEARS_PATH)
        stored.departure_counts = store(stored.departure_counts, DEPARTURE_COUNTS_PATH)
        stored.arrivals = store(stored.arrivals, ARRIVALS_PATH)
        stored.arrivals_by_discipline = store(stored.arrivals_by_discipline, ARRIVALS_BY_DISCIPLINE_PATH)
        return stored
