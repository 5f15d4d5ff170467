"""Time every report and series query; prints one JSON line.

The engine's four input tables are derived from the driver's once and stored, and that is timed
apart (``inputs_seconds``); queries read the stored inputs and derive all else anew.
``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. Each query runs once
to warm up and then ``BENCH_RUNS`` times; the median counts. Results go to the noop sink,
so every row is computed and none reaches the driver. ``BENCH_COMPARE=1`` adds the plans
that the operators replace: day expansion, range join and separate promotion reports.
"""

from __future__ import annotations

import dataclasses
import json
import os
import re
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures
from tourledger import names as N
from tourledger.functions.calendar import fiscal_year
from tourledger.operators.spells import month_calendar
from tourledger.plans import reports
from tourledger.plans.tables import Inputs, Tables
from tourledger.sources.schemas import INPUT_SCHEMAS

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tourledger-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make) -> float:
    run(make())
    seconds = []
    for _ in range(RUNS):
        started = time.perf_counter()
        run(make())
        seconds.append(time.perf_counter() - started)
    return round(statistics.median(seconds), 3)


def day_expansion(t: Tables) -> DataFrame:
    """Headcount per fiscal year by way of one row per day."""
    days = t.tours.select(N.PERSON, F.explode(F.sequence(N.START, N.END_OR_PRESENT)).alias("day"))
    pairs = days.select(N.PERSON, fiscal_year(F.col("day")).alias(N.FISCAL_YEAR)).distinct()
    return pairs.groupBy(N.FISCAL_YEAR).count()


def range_join(t: Tables) -> DataFrame:
    """Monthly headcount by an inner range join with the calendar."""
    months = month_calendar(t.tours.sparkSession, t.inputs.first_month, t.inputs.as_of)
    present = (F.col(N.START) <= F.col("month")) & (F.col(N.END_OR_PRESENT) > F.col("month"))
    return t.tours.join(F.broadcast(months), present).groupBy("month").count()


COMPARED = {
    "fiscal_years_by_day_expansion": day_expansion,
    "headcount_by_month_by_range_join": range_join,
    "promotion_breakdowns_in_one_pass": reports.classification_promotion_breakdowns,
}


def stored_inputs(spark: SparkSession) -> Inputs:
    """The inputs as Parquet files; the benchmark runs on one machine."""
    folder = tempfile.mkdtemp(prefix="bench-inputs-")
    inputs = fixtures.inputs(spark, SF_DIR)
    for name in INPUT_SCHEMAS:
        getattr(inputs, name).write.parquet(f"{folder}/{name}")
    return dataclasses.replace(inputs, **{name: spark.read.parquet(f"{folder}/{name}") for name in INPUT_SCHEMAS})


def main() -> None:
    spark = session()
    started = time.perf_counter()
    inputs = stored_inputs(spark)
    inputs_seconds = round(time.perf_counter() - started, 3)
    queries = {**reports.REPORTS, **reports.SERIES}
    timings = {name: timed(lambda: query(Tables(inputs))) for name, query in queries.items()}
    value = round(sum(timings.values()), 3)
    if os.environ.get("BENCH_COMPARE"):
        for name, plan in COMPARED.items():
            timings[name] = timed(lambda: plan(Tables(inputs)))
    found = re.search(r"sf([0-9.]+)", SF_DIR)
    result = {
        "metric": "total_query_seconds",
        "value": value,
        "unit": "sec",
        "inputs_seconds": inputs_seconds,
        "queries": timings,
        "sf": float(found.group(1)) if found else None,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
