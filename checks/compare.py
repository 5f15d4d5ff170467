"""Run queries and their SQL side by side: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks import oracle, registry


_TYPES = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if columns and rows agree, else what differs."""
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected_types = {d[0]: _TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    expected = _sorted_rows(expected_columns, result.fetchall())
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    if dict(df.dtypes) != expected_types:
        return f"types {sorted(set(df.dtypes) ^ set(expected_types.items()))}"
    found = _sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    return f"{len(wrong)} of {len(found)} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, expected, failed = connect(sf_dir), oracle.oracle_sql(), 0
    for name, query in registry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.perf_counter()
        wrong = difference(query(spark, sf_dir), con, expected[name]) if name in expected else "no SQL"
        failed += wrong is not None
        print(f"{'FAIL' if wrong else 'ok  '} {name} {time.perf_counter() - started:.2f}s {wrong or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
