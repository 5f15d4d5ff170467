"""Fiscal-year summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tourledger import names as N
from tourledger.functions.numbers import share


def fiscal_summary(person_years: DataFrame) -> DataFrame:
    """Arrivals, departures, headcount, hire shares, outside-region share and turnover per fiscal year.

    ``person_years`` has one row per person and fiscal year, so one grouping by year yields all
    four counts at once. Years without arrivals are left out before the lag; a year without
    departures has NULLs, not zeros.
    """

    def count_or_null(flag: str) -> Column:
        return F.nullif(F.count_if(flag), F.lit(0))

    years = (
        person_years.groupBy(N.FISCAL_YEAR)
        .agg(
            F.count_if("arrived").alias("arrivals"),
            count_or_null("departed").alias("departures"),
            F.count("*").alias("headcount_arrivals"),
            count_or_null("outside").alias("outside"),
        )
        .where("arrivals > 0")
    )
    new_hires = share(F.col("arrivals") - F.col("departures"), F.col("arrivals"))
    adjusted = F.col("headcount_adjusted")
    lagged = F.lag("headcount_adjusted").over(Window.orderBy(N.FISCAL_YEAR))
    return (
        years.withColumns(
            {
                "new_hires_percentage": new_hires,
                "replacement_hires_percentage": 1 - new_hires,
                "headcount_adjusted": F.col("headcount_arrivals") - F.col("departures"),
                "location_outside_ncr_percentage": F.bround(
                    share(F.col("outside"), F.col("headcount_arrivals")), 4
                ),
            }
        )
        .withColumn("headcount_lagged_average", (lagged + adjusted) / F.lit(2))
        .withColumn("turnover_rate_percentage", share(F.col("departures"), F.col("headcount_lagged_average")))
        .select(
            N.FISCAL_YEAR,
            "arrivals",
            "departures",
            "new_hires_percentage",
            "replacement_hires_percentage",
            "headcount_arrivals",
            "headcount_adjusted",
            "location_outside_ncr_percentage",
            "headcount_lagged_average",
            "turnover_rate_percentage",
        )
        .orderBy(N.FISCAL_YEAR)
    )
