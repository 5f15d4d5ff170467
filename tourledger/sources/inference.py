"""Types of tables without a schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tourledger.sources.tables import read_raw

_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,2})?$"
_WHOLE = r"^[+-]?[0-9]{1,19}$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$"


def _text_as(pattern: str, kind: str) -> Callable[[Column], Column]:
    return lambda text: text.rlike(pattern) & text.try_cast(kind).isNotNull()


#: Types from narrow to wide, with the test whether a text is one. What is an int is a bigint and a
#: double too, and a date a timestamp; every text is a string.
TYPES: dict[str, Callable[[Column], Column]] = {
    "boolean": lambda text: F.lower(text).isin("true", "false"),
    "int": _text_as(_WHOLE, "int"),
    "bigint": _text_as(_WHOLE, "bigint"),
    "double": _text_as(_NUMBER, "double"),
    "date": _text_as(_DATE, "date"),
    "timestamp_ntz": _text_as(_TIME, "timestamp_ntz"),
}
ANY = "string"


def type_report(df: DataFrame) -> DataFrame:
    """One row per column of ``df``, whose values count as texts: ``column_name``, ``inferred_type``
    (the narrowest of ``TYPES`` that all values are, string if there is none, or no value),
    ``n_values``, ``n_nulls`` and for each type the number of values that it does not hold.

    One pass: rows become a row per column, which are counted by column before the shuffle.
    """
    if not df.columns:
        raise ValueError("a table without columns has no types")
    texts = [F.struct(F.lit(i).alias("position"), F.col(f"`{name}`").cast("string").alias("text")) for i, name in enumerate(df.columns)]
    names = F.element_at(F.array(*map(F.lit, df.columns)), F.col("position") + 1)
    text = F.col("text")
    counts = [F.count(text).alias("n_values"), F.count_if(text.isNull()).alias("n_nulls")]
    counts += [F.count_if(text.isNotNull() & ~holds(text)).alias(f"not_{kind}") for kind, holds in TYPES.items()]
    rows = df.select(F.inline(F.array(*texts))).groupBy("position").agg(*counts).withColumn("column_name", names)
    narrowest = F.lit(ANY)
    for kind in reversed(TYPES):
        narrowest = F.when(F.col(f"not_{kind}") == 0, kind).otherwise(narrowest)
    narrowest = F.when(F.col("n_values") > 0, narrowest).otherwise(ANY)
    return rows.select("column_name", narrowest.alias("inferred_type"), *[c for c in rows.columns if c not in ("position", "column_name")])


def load_inferred(
    spark: SparkSession, path: str, fmt: str | None = None, multi_line: bool | None = None, order: bool = False
) -> DataFrame:
    """A table whose text columns have the narrowest types that all their values are.

    Two passes: the report, of which the driver gets a row per column, then the typed read.
    Columns that a Parquet file gives another type than text keep it.
    """
    df = read_raw(spark, path, fmt, multi_line, order)
    texts = [name for name, kind in df.dtypes if kind == "string"]
    found = {r.column_name: r.inferred_type for r in type_report(df.select(*[f"`{c}`" for c in texts])).collect()} if texts else {}
    return df.select(*[F.col(f"`{c}`").cast(found[c]).alias(c) if found.get(c, ANY) != ANY else F.col(f"`{c}`") for c in df.columns])
