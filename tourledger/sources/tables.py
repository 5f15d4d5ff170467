"""Typed table reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StringType, StructField, StructType

from tourledger.functions.text import snake_case_all

#: The column that holds a row's place in its input.
INPUT_ORDER = "input_order"


def normalise_names(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case."""
    return df.toDF(*snake_case_all(df.columns))


def cast_dates(df: DataFrame, suffix: str = "date") -> DataFrame:
    """Cast columns whose name ends in ``suffix`` to DATE; text that is no date becomes NULL."""
    casts = {}
    for field in df.schema.fields:
        if not field.name.lower().endswith(suffix) or isinstance(field.dataType, DateType):
            continue
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            casts[field.name] = column.try_cast("date")
        else:
            casts[field.name] = column.cast("date")
    return df.withColumns(casts) if casts else df


def _typed(field: StructField, kind: DataType) -> Column:
    """A column as ``kind``, NULL where it is none; whole numbers may be written as ``2.0``."""
    column = F.col(f"`{field.name}`")
    if field.dataType == kind:
        return column
    if isinstance(kind, IntegralType) and isinstance(field.dataType, StringType):
        column = column.try_cast("double")
    return column.try_cast(kind).alias(field.name)


def spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether a record of a CSV table goes over a line break: some line has an odd number of
    quotes. Lines are read in splits by all tasks, which hand on one flag each."""
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return bool(spark.read.text(path).agg(F.coalesce(F.bool_or(quotes % 2 == 1), F.lit(False))).first()[0])


def read_raw(
    spark: SparkSession, path: str, fmt: str | None = None, multi_line: bool | None = None, order: bool = False
) -> DataFrame:
    """A Parquet or CSV table under snake_case names, CSV columns as text.

    A CSV file is split between tasks unless its records span lines, which a pass over the
    lines tells; ``multi_line`` says so beforehand. Quoted text may hold commas and doubled quotes.
    ``order`` adds ``input_order``, see ``with_input_order``.
    """
    if fmt is None:
        fmt = "csv" if path.rstrip("/").endswith((".csv", ".csv.gz")) else "parquet"
    if fmt == "csv":
        if multi_line is None:
            multi_line = spans_lines(spark, path)
        read = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
        df = read.csv(path)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}: csv or parquet")
    names = snake_case_all(df.columns)
    if order:
        df = with_input_order(df, fmt)
        names.append(INPUT_ORDER)
    return df.toDF(*names)


def with_input_order(df: DataFrame, fmt: str) -> DataFrame:
    """A table just read with ``input_order``: a key that sorts rows as the files have them,
    file by file in the order of their names.

    It is made in the scan and is a column like any other from then on, so it holds through
    shuffles. Parquet tells a row's index in its file. A CSV row is known by where its part of the
    file begins and by a number that ascends inside the part, so that the sorted order, though
    not the key, is the same however the files are split.
    """
    if fmt == "parquet":
        at = [F.lit(0).cast("long").alias("part"), F.col("_metadata.row_index").alias("row")]
    else:
        at = [F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("row")]
    return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"), *at).alias(INPUT_ORDER))


def _columns(
    spark: SparkSession, path: str, schema: StructType, fmt: str | None, multi_line: bool | None, order: bool = False
) -> tuple[DataFrame, list[tuple[StructField, DataType]]]:
    """The table under snake_case names, and the columns of ``schema`` as they are in it with
    the types that they ought to have."""
    df = read_raw(spark, path, fmt, multi_line, order)
    wanted = dict(zip(snake_case_all(schema.names), (field.dataType for field in schema.fields)))
    found = {field.name: field for field in df.schema.fields}
    if missing := [name for name in wanted if name not in found]:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return df, [(found[name], kind) for name, kind in wanted.items()]


def load_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    dates: bool = True,
    fmt: str | None = None,
    multi_line: bool | None = None,
    order: bool = False,
) -> DataFrame:
    """Read the columns of ``schema`` from a Parquet or CSV table, matched by name.

    Names come back as snake_case and ``*date`` columns as DATE. Nothing is inferred: CSV
    columns are text until they are cast, Parquet columns of other types are cast too, and a
    missing column is an error. ``dates=False`` keeps date text as it is, for tables whose
    sentinels are still to be removed. ``fmt`` is csv or parquet, by default csv for names
    that end so; ``multi_line`` and ``order`` are as in ``read_raw``.
    """
    df, columns = _columns(spark, path, schema, fmt, multi_line, order)
    df = df.select(*[_typed(field, kind) for field, kind in columns], *([INPUT_ORDER] if order else []))
    return cast_dates(df) if dates else df


def unparsed_texts(
    spark: SparkSession,
    path: str,
    schema: StructType,
    dates: bool = True,
    fmt: str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Rows (column_name, problems): the values of each column that ``load_table`` makes NULL."""
    df, columns = _columns(spark, path, schema, fmt, multi_line)
    counts = []
    for field, kind in columns:
        if dates and field.name.endswith("date"):
            kind = DateType()
        lost = F.col(f"`{field.name}`").isNotNull() & _typed(field, kind).isNull()
        counts.append(F.struct(F.lit(field.name).alias("column_name"), F.count_if(lost).alias("problems")))
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
