"""The calendar, share and text functions, and presence on a date, for queries in SQL.

They are SQL functions: Spark puts their bodies into the plan of a query that calls them, so
filters reach the scan and nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tourledger import names as N

#: The view that ``tours_present_on`` reads.
TOURS_VIEW = "tours"

_SCALARS = {
    "fiscal_year(day DATE) RETURNS INT": "year(add_months(day, -3))",
    "fiscal_quarter(day DATE) RETURNS STRING": "concat('Q', quarter(add_months(day, -3)))",
    "fiscal_year_text(start_year INT) RETURNS STRING": "concat(start_year, '-', start_year + 1)",
    "fiscal_year_label(day DATE) RETURNS STRING": "fiscal_year_text(fiscal_year(day))",
    "fiscal_label_to_year(label STRING) RETURNS INT": r"try_cast(nullif(regexp_extract(label, '([0-9]{4})', 1), '') AS INT)",
    "reporting_period(day DATE) RETURNS STRING": "concat(fiscal_year_label(day), '-', fiscal_quarter(day))",
    "share(part DOUBLE, whole DOUBLE) RETURNS DOUBLE": "try_divide(part, whole)",
    "percent_text(fraction DOUBLE, n BIGINT) RETURNS STRING": "concat(CAST(bround(fraction * 100, 0) AS BIGINT), '% (', n, ')')",
    "two_decimals(value DOUBLE) RETURNS STRING": "CASE WHEN value IS NOT NULL THEN format_string('%.2f', bround(value, 2)) END",
    "title_case(text STRING) RETURNS STRING": (
        r"""replace(initcap(regexp_replace(lower(text), r"([^\p{L}' ])", concat('$1', char(1), ' '))), concat(char(1), ' '), '')"""
    ),
    "duration_bin(years DOUBLE) RETURNS STRING": "CASE WHEN years <= 0 THEN NULL "
    + " ".join(f"WHEN years <= {i + 1} THEN '{name}'" for i, name in enumerate(N.DURATION_BINS[:-1]))
    + f" WHEN years > {len(N.DURATION_BINS) - 1} THEN '{N.DURATION_BINS[-1]}' END",
    "duration_days(first DATE, last DATE) RETURNS INT": "datediff(last, first) + 1",
    "duration_years(first DATE, last DATE) RETURNS DOUBLE": "duration_days(first, last) / 365",
}

_TOUR_COLUMNS = f"{N.PERSON} STRING, {N.TOUR} INT, {N.DISCIPLINE} STRING, {N.SOURCE} STRING, {N.START} DATE, {N.END} DATE"


def register(spark: SparkSession, tours: str | None = TOURS_VIEW) -> list[str]:
    """Create the functions in the session, replacing those of the same names; returns the names.

    ``tours_present_on(day, as_of)`` is a table function over the view ``tours``, which has to exist: the
    rows under way on ``day``, whose end day does not count and whose open ends are ``as_of``. With
    None it is left out.
    """
    created = []
    for signature, body in _SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
        created.append(signature.partition("(")[0])
    if tours is not None:
        columns = ", ".join(part.split()[0] for part in _TOUR_COLUMNS.split(", "))
        present = f"{N.START} <= day AND ({N.END} > day OR ({N.END} IS NULL AND as_of > day))"
        spark.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION tours_present_on(day DATE, as_of DATE) "
            f"RETURNS TABLE ({_TOUR_COLUMNS}) RETURN SELECT {columns} FROM `{tours}` WHERE {present}"
        )
        created.append("tours_present_on")
    return created
