"""Physical plans: no Python workers, no row-by-row joins, bounded broadcasts, pushed filters."""

import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures, registry
from tourledger.operators import people, spells
from tourledger.operators.summary import fiscal_summary
from tourledger.plans import reports
from tourledger.plans.tables import Tables

QUERIES = registry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_and_no_cartesian_product(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    for word in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "Scan ExistingRDD"):
        assert word not in text
    # The only nested-loop joins add a one-row total.
    loops = re.findall(r"BroadcastNestedLoopJoin (\w+), (\w+)", text)
    assert all(kind == ("BuildRight", "Cross") for kind in loops)


def test_tour_reports_leave_out_what_they_do_not_read(spark, sf_dir, tables):
    # No grade lookups, and no ranking window where the tour number is not read.
    text = plan(reports.departures(tables))
    assert "part.parquet" not in text
    assert "Window" not in text
    assert plan(reports.summary_arrivals_departures_headcount_by_fiscal_year(tables)).count("pay_rates") == 0


def test_summary_shuffles_tours_once(stored):
    text = plan(fiscal_summary(people.person_years(stored.tour_years)))
    assert text.count("FileScan") == 1
    exchanges = re.findall(r"Exchange (\w+)", text)
    assert exchanges.count("hashpartitioning") == 2


def test_presence_filter_reaches_the_scan(stored):
    found = spells.present_on(stored.tours, registry.PRESENT_ON, fixtures.AS_OF).select("full_name")
    text = plan(found)
    pushed = text.split("PushedFilters: [")[1]
    assert "LessThanOrEqual(cds_start_date,1999-07-01)" in pushed and "Or(GreaterThan(cds_end_da" in pushed


def test_reports_read_only_their_columns(stored):
    text = plan(reports.departures_by_fiscal_year(stored))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(part.split(":")[0] for part in schema.split(",")) == ["cds_end_date", "cds_end_fiscal_year", "full_name"]


def test_person_aggregates_combine_before_the_shuffle(stored):
    text = plan(people.person_facts(stored.tours))
    assert "partial_max" in text and "Window" not in text


def test_merging_reads_the_tours_once(stored):
    df = spells.merge_tours(stored.tours, fixtures.AS_OF)
    df.collect()
    text = plan(df).split("\n+- == Initial Plan ==")[0]
    assert "ReusedExchange" in text
    assert text.count("FileScan") == 1


def test_monthly_series_orders_months_only(stored):
    text = plan(spells.monthly_headcount(stored.tours, fixtures.FIRST_MONTH, fixtures.AS_OF))
    lowest_window = text.rindex("Window [")
    assert lowest_window < text.index("functions=[sum(step") < text.index("functions=[partial_sum(step")


def test_ranking_splits_hot_customers_and_equals_a_plain_window(spark, sf_dir):
    from pyspark.sql import Window

    orders = fixtures.table(spark, sf_dir, "orders")
    # One customer takes a third of all orders.
    skewed = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey")))
    plain = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    expected = skewed.withColumn("o_rank", F.row_number().over(plain)).select("o_orderkey", "o_rank")
    found = fixtures.ranked_orders(skewed).select("o_orderkey", "o_rank")
    assert found.count() == expected.count()
    assert found.exceptAll(expected).isEmpty()


def test_person_years_aggregate_by_hash(stored):
    text = plan(people.person_years(stored.tour_years))
    assert "SortAggregate" not in text


def test_reports_seldom_read_the_tours(stored):
    # Of reports 1 to 27, five read the tours; storing what the others read takes five scans more.
    scans = lambda df: len(re.findall(r"FileScan parquet .*/tours\]", plan(df)))
    assert sum(scans(report(stored)) > 0 for report in reports.PUBLISHED[:27]) == 5
    fresh = Tables(stored.inputs)
    fresh.tours = stored.tours
    shared = (fresh.persons, fresh.person_years, fresh.departure_counts, fresh.arrivals, fresh.arrivals_by_discipline.select("discipline_initial"))
    assert scans(fresh.tours) == 1
    assert all(scans(df) <= 2 for df in shared)


def test_stored_reports_equal_unstored_ones(stored, tables):
    for report in reports.PUBLISHED[:27]:
        found, expected = report(stored), report(tables)
        assert found.schema.names == expected.schema.names
        assert [tuple(row) for row in found.collect()] == [tuple(row) for row in expected.collect()], report.__name__


def test_pivots_run_no_job_while_they_are_planned(spark, sf_dir):
    fresh = Tables(fixtures.inputs(spark, sf_dir))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pivots", "planning")
    try:
        reports.summary_departure_type_by_discipline_percentages(fresh)
        reports.summary_departure_type_by_arrival_source_percentages(fresh)
        assert tracker.getJobIdsForGroup("pivots") == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_departure_types_are_found_where_none_are_given(spark, sf_dir):
    import dataclasses

    given = fixtures.inputs(spark, sf_dir)
    found = Tables(dataclasses.replace(given, other_departure_types=None))
    for report in (reports.summary_departure_type_by_discipline_percentages, reports.summary_departure_type_by_arrival_source_percentages):
        assert report(found).columns == report(Tables(given)).columns
        assert report(found).columns[-1] == "retired"
