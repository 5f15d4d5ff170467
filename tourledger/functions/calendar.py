"""Fiscal calendar: years run from 1 April and are named by their start year."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fiscal_year(date: Column) -> Column:
    """Start year of the fiscal year that holds ``date``."""
    return F.year(F.add_months(date, -3))


def fiscal_quarter(date: Column) -> Column:
    """``Q1`` (April to June) to ``Q4`` (January to March)."""
    return F.concat(F.lit("Q"), F.quarter(F.add_months(date, -3)).cast("string"))


def fiscal_year_text(start_year: Column) -> Column:
    """2021 -> ``2021-2022``."""
    return F.concat(start_year.cast("string"), F.lit("-"), (start_year + 1).cast("string"))


def fiscal_year_label(date: Column) -> Column:
    """Date -> ``2021-2022``."""
    return fiscal_year_text(fiscal_year(date))


def fiscal_label_to_year(label: Column) -> Column:
    """First four-digit number in a label, as an integer; NULL where there is none."""
    digits = F.regexp_extract(label, r"(\d{4})", 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def reporting_period(date: Column) -> Column:
    """Date -> ``2021-2022-Q3``."""
    return F.concat(fiscal_year_label(date), F.lit("-"), fiscal_quarter(date))
