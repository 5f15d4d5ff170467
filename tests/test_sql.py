"""The SQL functions give what the Column functions give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tourledger.functions import calendar, numbers, sql, text
from tourledger.operators import shares, spells


@pytest.fixture
def registered(spark, tour_rows):
    rows = [("a", 1, "2019-01-01", None), ("b", 1, "2019-01-01", "2020-01-01"), ("c", 1, "2019-06-01", "2019-05-01"), ("d", 1, None, None)]
    tours = tour_rows(rows)
    tours.createOrReplaceTempView("tours_for_sql")
    sql.register(spark, "tours_for_sql")
    return tours


DAYS = [dt.date(2020, 1, 31) + dt.timedelta(days=n * 13) for n in range(90)] + [dt.date(2021, 3, 31), dt.date(2021, 4, 1), None]


@pytest.mark.parametrize("name", ["fiscal_year", "fiscal_quarter", "fiscal_year_label", "reporting_period"])
def test_calendar(spark, registered, name):
    df = spark.createDataFrame([(d,) for d in DAYS], "d date")
    found = df.select(getattr(calendar, name)(F.col("d")).alias("a"), F.expr(f"{name}(d)").alias("b"))
    assert found.where("NOT a <=> b").count() == 0 and found.dtypes[0][1] == found.dtypes[1][1]


def test_labels_shares_and_texts(spark, registered):
    labels = spark.createDataFrame([("2021-2022",), ("FY 1999",), ("none",), (None,), ("",)], "x string")
    found = labels.select(calendar.fiscal_label_to_year(F.col("x")).alias("a"), F.expr("fiscal_label_to_year(x)").alias("b"))
    assert found.where("NOT a <=> b").count() == 0 and found.where("b = 1999").count() == 1
    words = spark.createDataFrame([("québec smith-jones",), ("mcdonald o'brien",), ("ADMIN / operations",), (None,), ("",)], "x string")
    found = words.select(text.title_case(F.col("x")).alias("a"), F.expr("title_case(x)").alias("b"))
    assert found.where("NOT a <=> b").count() == 0 and found.first().b == "Québec Smith-Jones"
    pairs = spark.createDataFrame([(1, 8), (0, 3), (2, 3), (1, 0), (None, 4)], "p int, w int")
    fraction = numbers.share(F.col("p"), F.col("w"))
    found = pairs.select(
        fraction.alias("a"), F.expr("share(p, w)").alias("b"), numbers.percent_text(fraction, F.col("p")).alias("c"),
        F.expr("percent_text(share(p, w), p)").alias("d"), numbers.two_decimals(fraction).alias("e"), F.expr("two_decimals(share(p, w))").alias("f"),
    )
    assert found.where("NOT (a <=> b AND c <=> d AND e <=> f)").count() == 0 and found.first().d == "12% (1)"
    years = spark.createDataFrame([(y,) for y in (-1.0, 0.0, 0.5, 1.0, 1.01, 2.0, 3.0, 3.01, 99.0, None)], "y double")
    found = years.select(shares.duration_bin(F.col("y")).alias("a"), F.expr("duration_bin(y)").alias("b"))
    assert found.where("NOT a <=> b").count() == 0


@pytest.mark.parametrize("day", ["2019-01-01", "2019-12-31", "2020-01-01", "2018-01-01", "2023-01-01"])
def test_presence_is_that_of_the_operator(spark, registered, day):
    as_of = dt.date(2022, 10, 1)
    found = spark.sql(f"SELECT full_name FROM tours_present_on(DATE'{day}', DATE'{as_of}')")
    expected = spells.present_on(registered, dt.date.fromisoformat(day), as_of).select("full_name")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_presence_reaches_the_scan(spark, stored):
    stored.tours.createOrReplaceTempView("stored_for_sql")
    sql.register(spark, "stored_for_sql")
    plan = spark.sql("SELECT full_name, fiscal_year(cds_start_date) FROM tours_present_on(DATE'1999-07-01', DATE'2001-12-31')")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "LessThanOrEqual(cds_start_date,1999-07-01)" in text.split("PushedFilters: [")[1]
    assert "discipline_initial" not in text.split("ReadSchema")[1]
