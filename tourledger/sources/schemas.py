"""Schemas of the input tables; columns are matched by name, further columns are left out."""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType

from tourledger import names as N


def _fields(*fields: tuple[str, type]) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in fields])


TENURE = _fields(
    (N.PERSON, StringType),
    (N.TOUR, IntegerType),
    (N.DISCIPLINE, StringType),
    (N.PROGRAM, StringType),
    (N.LOCATION_FIRST, StringType),
    (N.LOCATION_LAST, StringType),
    (N.START, DateType),
    (N.END, DateType),
    (N.DEPARTURE, StringType),
    (N.SOURCE, StringType),
    (N.STATUS, StringType),
    (N.NOTES, StringType),
)
LEVEL = _fields(
    ("name", StringType),
    ("earliest_date", StringType),
    ("latest_date", StringType),
    ("earliest_group_level", StringType),
    ("latest_group_level", StringType),
)
NAME_HARMONIZATION = _fields(("tenure_data_full_name", StringType), ("level_data_full_name", StringType))
PAY_RATES = _fields(("label", StringType), ("min", DoubleType), ("max", DoubleType))
BOARD_CARDS = _fields(
    ("card_name", StringType),
    ("due_date", StringType),
    ("last_activity_date", StringType),
    ("list_name", StringType),
)

INPUT_SCHEMAS = {
    "tenure_raw": TENURE,
    "level_raw": LEVEL,
    "name_harmonization": NAME_HARMONIZATION,
    "pay_rates": PAY_RATES,
}

# The roster's date columns hold a sentinel that is removed before they are parsed.
KEEP_DATE_TEXT = ("level_raw",)
