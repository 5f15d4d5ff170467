"""Grade progression of persons and promotion totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tourledger import names as N
from tourledger.functions.numbers import share
from tourledger.operators.cleaning import join_with_aliases
from tourledger.operators.people import latest_by
from tourledger.operators.salary import attach_salary
from tourledger.operators.shares import ascending


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def latest_attributes(persons: DataFrame) -> DataFrame:
    """Discipline, location and arrival source of the last tour, from ``person_facts``."""
    return persons.select(
        N.PERSON,
        F.col("last_discipline").alias(N.DISCIPLINE),
        F.col("last_tour_location").alias(N.LOCATION_LAST),
        F.col("last_source").alias(N.SOURCE),
    )


def person_progression(
    persons: DataFrame, merged: DataFrame, aliases: DataFrame, roster: DataFrame, pay: DataFrame
) -> DataFrame:
    """Persons with a known latest level: grades, median pay, promotion flags, last merged duration.

    Grades belong to persons, so the three lookups are joined to ``latest_attributes``; the large table is never shuffled by grade or alias. Rows repeated in
    the lookups count once. ``pay`` has one median per grade.
    """
    people = attach_salary(join_with_aliases(persons, aliases.distinct(), roster.distinct()), pay)
    group_changed = _flag(F.col("earliest_group") != F.col("latest_group"))
    level_up = _flag(F.col("latest_level") > F.col("earliest_level"))
    flagged = people.where(F.col("latest_level").isNotNull()).withColumns(
        {
            "has_promotion": _flag(F.col("latest_median_salary") > F.col("earliest_median_salary")),
            "has_classification_change": group_changed,
            "has_level_increase": level_up,
            "has_classification_change_or_level_increase": group_changed | level_up,
        }
    )
    durations = latest_by(
        merged,
        N.PERSON,
        N.TOUR,
        {"duration_days": "duration_days", "duration_years": "duration_years"},
    )
    return flagged.join(durations, N.PERSON, "left")


def not_from_group(df: DataFrame, group: str = N.STUDENT_GROUP) -> DataFrame:
    """Persons who did not start in ``group``; an unknown first group is left out as well."""
    return df.where(F.col("earliest_group") != group)


def promotion_totals(
    df: DataFrame,
    by: str | None = None,
    flag: str = "has_promotion",
    count: str = "has_promotion_count",
    sort: bool = True,
    nonzero: bool = False,
) -> DataFrame:
    """Persons with ``flag``, all persons and the share; overall or per ``by``.

    ``sort`` orders by share and count, highest first; ``nonzero`` drops groups without any.
    """
    aggregates = [F.count_if(flag).alias(count), F.count("*").alias("total_count")]
    totals = df.agg(*aggregates) if by is None else df.groupBy(by).agg(*aggregates)
    out = totals.withColumn("percentage", share(F.col(count), F.col("total_count")))
    if nonzero:
        out = out.where("percentage <> 0")
    if sort and by is not None:
        out = out.orderBy(F.desc("percentage"), F.desc(count), *ascending(by))
    return out


def promotion_breakdowns(df: DataFrame, keys: Sequence[str], flag: str = "has_promotion") -> DataFrame:
    """All one-key breakdowns and the overall total in one pass over ``df``, by grouping sets.

    ``breakdown`` names the key of a row (``overall`` for the total) and ``category`` its value.
    """
    totals = df.groupingSets([[key] for key in keys] + [[]], *keys).agg(
        F.grouping_id().alias("_set"),
        F.count_if(flag).alias("has_promotion_count"),
        F.count("*").alias("total_count"),
    )
    every = 2 ** len(keys) - 1
    breakdown, category = F.lit("overall"), F.lit(None).cast("string")
    for position, key in enumerate(keys):
        in_set = F.col("_set") == every - 2 ** (len(keys) - 1 - position)
        breakdown = F.when(in_set, F.lit(key)).otherwise(breakdown)
        category = F.when(in_set, F.col(key).cast("string")).otherwise(category)
    return totals.select(
        breakdown.alias("breakdown"),
        category.alias("category"),
        "has_promotion_count",
        "total_count",
        share(F.col("has_promotion_count"), F.col("total_count")).alias("percentage"),
    )
