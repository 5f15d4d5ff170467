"""One full run: input tables in, all reports out as CSV."""

from __future__ import annotations

import argparse
import datetime as dt
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tourledger import names as N
from tourledger.plans.quality import quality_report
from tourledger.plans.reports import REPORTS, SERIES
from tourledger.plans.tables import Inputs, Tables
from tourledger.sources.releases import Release
from tourledger.sources.schemas import INPUT_SCHEMAS, KEEP_DATE_TEXT
from tourledger.sources.tables import load_table, unparsed_texts

# First month of the monthly series unless a run names another one.
FIRST_MONTH = dt.date(2016, 9, 1)


def load_inputs(
    spark: SparkSession,
    paths: Mapping[str, str],
    as_of: dt.date,
    first_month: dt.date = FIRST_MONTH,
    home: str = N.HOME_REGION,
    slice_discipline: str = "Policy",
) -> Inputs:
    """Read the four input tables, CSV or Parquet, from ``paths``; keys as in ``INPUT_SCHEMAS``."""
    loaded = {
        name: load_table(spark, paths[name], schema, dates=name not in KEEP_DATE_TEXT)
        for name, schema in INPUT_SCHEMAS.items()
    }
    return Inputs(
        **loaded, as_of=as_of, first_month=first_month, home=home, slice_discipline=slice_discipline
    )


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the storage that the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/tourledger-{uuid.uuid4().hex}"


def count_unparsed(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """The values of all inputs, by table and column, that are NULL once they are typed."""
    found = [
        unparsed_texts(spark, paths[name], schema, dates=name not in KEEP_DATE_TEXT).withColumn(
            "column_name", F.concat(F.lit(f"{name}."), "column_name")
        )
        for name, schema in INPUT_SCHEMAS.items()
    ]
    return reduce(DataFrame.unionByName, found)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove the shared tables that a run has written to ``folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def publish_all(
    inputs: Inputs,
    out: str,
    folder: str | None = None,
    series_out: str | None = None,
    strict: bool = False,
    unparsed: DataFrame | None = None,
    about: Mapping[str, str] | None = None,
) -> Tables:
    """Write the shared tables once, then every report from them, and publish all as ``out/<report>``.

    The reports replace those in ``out`` together, once the last one is finished (``Release``). With
    ``about``, which says what the run is made from, a run that broke off goes on where it stopped;
    without, it starts anew. ``series_out`` also publishes the series feeds, as a set of their own.
    ``out/quality`` tells what the inputs lack, with the counts in ``unparsed``; with ``strict`` any
    problem is an error, and nothing else is published then but the quality report beside ``out``.
    """
    spark = inputs.tenure_raw.sparkSession
    tables = Tables(inputs).write_to(folder or shared_folder(spark))
    about = {"run": uuid.uuid4().hex} if about is None else about
    release = Release(spark, out, about)
    release.add("quality", lambda: quality_report(tables, unparsed))
    if strict:
        wrong = spark.read.option("header", True).csv(f"{release.staging}/quality").where("cast(problems AS bigint) > 0")
        if problems := [f"{row.check_name}: {row.problems}" for row in wrong.collect()]:
            raise ValueError("; ".join(problems))
    sets = [(release, REPORTS, ["quality", *REPORTS])]
    if series_out is not None:
        sets.append((Release(spark, series_out, about), SERIES, list(SERIES)))
    for own, reports, _ in sets:
        for name, report in reports.items():
            own.add(name, lambda report=report: report(tables))
    for own, _, names in sets:
        own.switch(names)
    return tables


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tourledger", description="Publish all tenure reports as CSV.")
    for name in INPUT_SCHEMAS:
        parser.add_argument(f"--{name.replace('_', '-')}", required=True, help=f"path of the {name} table")
    parser.add_argument("--out", required=True, help="folder for the reports")
    parser.add_argument("--series-out", help="folder for the series feeds")
    parser.add_argument("--as-of", required=True, type=dt.date.fromisoformat, help="date that stands for today")
    parser.add_argument("--first-month", default=FIRST_MONTH, type=dt.date.fromisoformat)
    parser.add_argument("--home", default=N.HOME_REGION, help="location that counts as the home region")
    parser.add_argument("--slice-discipline", default="Policy")
    parser.add_argument("--strict", action="store_true", help="fail if the quality report has problems")
    parser.add_argument("--resume", action="store_true", help="go on with a broken run of the same arguments over the same files")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tourledger").getOrCreate()
    paths = {name: getattr(args, name) for name in INPUT_SCHEMAS}
    inputs = load_inputs(spark, paths, args.as_of, args.first_month, args.home, args.slice_discipline)
    folder = shared_folder(spark)
    try:
        about = {name: str(value) for name, value in vars(args).items()} if args.resume else None
        publish_all(inputs, args.out, folder, args.series_out, args.strict, count_unparsed(spark, paths), about)
    finally:
        remove_folder(spark, folder)
