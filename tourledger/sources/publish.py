"""Publishing rules for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from tourledger import names as N
from tourledger.functions.numbers import two_decimals


def publishable(df: DataFrame) -> DataFrame:
    """Drop sensitive columns, write amounts as two-decimal text, round percentages to 4 digits.

    Columns are picked by name suffix, ignoring case.
    """
    df = df.drop(*N.SENSITIVE_COLUMNS)
    changes = {}
    for field in df.schema.fields:
        if not isinstance(field.dataType, NumericType):
            continue
        column = F.col(f"`{field.name}`")
        if field.name.lower().endswith(N.TWO_DECIMAL_SUFFIXES):
            changes[field.name] = two_decimals(column)
        elif field.name.lower().endswith(N.PERCENTAGE_SUFFIX):
            changes[field.name] = F.bround(column, 4)
    return df.withColumns(changes) if changes else df


def publish(df: DataFrame, path: str, single_file: bool = False) -> DataFrame:
    """Write ``df`` as CSV with a header and empty NULLs; returns ``df`` itself, unrounded.

    ``single_file`` is for reports of a few rows; a large table keeps its partitions.
    """
    out = publishable(df)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return df
