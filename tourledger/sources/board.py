"""Onboarding board export -> tour rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tourledger import names as N
from tourledger.sources.tables import INPUT_ORDER

# Board texts.
TEMPLATE_MARKS = ("Template", "PLACEHOLDER")
NAME_ROLE_SEPARATOR = "- "
LIST_STATUS = {"Pre-First Day": "incoming", "Start Date CONFIRMED": "start_date_confirmed"}
DEFAULT_STATUS = "onboarded"
ACTIVITY = "trello_last_activity_date"


def import_board_cards(df: DataFrame, run_date: dt.date | None = None, out: str | None = None) -> DataFrame:
    """Card rows (``card_name``, ``due_date``, ``last_activity_date``, ``list_name``) as tours.

    Template cards go; ``Name - Role`` is split at its first separator. One narrow stage;
    rows are ordered by activity date only when ``out`` asks for the dated CSV. Cards of one day
    keep the order of the file if ``df`` was read with ``order=True``, which makes the rows of the
    CSV the same on any number of partitions; without it they keep that of the partitions.
    """
    is_template = F.lit(False)
    for mark in TEMPLATE_MARKS:
        is_template = is_template | F.col("card_name").contains(mark)

    status = F.lit(DEFAULT_STATUS)
    for list_name, value in LIST_STATUS.items():
        status = F.when(F.col("list_name") == list_name, value).otherwise(status)

    parts = F.split("card_name", NAME_ROLE_SEPARATOR, 2)
    whitespace = F.lit(" \t\r\n")
    untyped = F.lit(None).cast("string")
    ordered_input = INPUT_ORDER in df.columns
    place = F.col(INPUT_ORDER) if ordered_input else F.monotonically_increasing_id()
    tours = df.where(~is_template).select(
        F.trim(F.get(parts, F.lit(0)), whitespace).alias(N.PERSON),
        F.trim(F.get(parts, F.lit(1)), whitespace).alias("role"),
        untyped.alias("location"),
        F.col("due_date").try_cast("date").alias(N.START),
        status.alias(N.STATUS),
        F.col("last_activity_date").try_cast("date").alias(ACTIVITY),
        F.col("due_date").try_cast("date").alias("role_start_date"),
        untyped.alias("role_end_date"),
        untyped.alias(N.END),
        untyped.alias(N.DEPARTURE),
        *([place] if ordered_input else []),
    )
    if out is not None:
        if run_date is None:
            raise ValueError("a dated export needs run_date")
        path = f"{out.rstrip('/')}/{run_date.isoformat()}-tenure-data"
        # The second key also lets one very busy day span several tasks.
        ordered = tours.orderBy(F.asc_nulls_last(ACTIVITY), place)
        ordered.drop(INPUT_ORDER).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return tours.drop(INPUT_ORDER)
