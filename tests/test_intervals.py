import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tourledger.operators import intervals
from tourledger.operators.intervals import at_once, interval_join, most_at_once, present_on_dates, running_sum, spell_events

DAY = dt.date(2000, 1, 1)
SPELLS = "person string, s date, e date"


def spell_rows(rng, n):
    def date():
        return DAY + dt.timedelta(days=rng.choice([0, 1, 31, 32, rng.randrange(-400, 4000)]))

    rows = [(rng.choice(["a", "b", None]), rng.choice([None, date(), date(), date()]), rng.choice([None, date(), date(), date()])) for _ in range(n)]
    return rows + [("long", dt.date(1, 1, 1), dt.date(9999, 12, 31)), ("old", dt.date(1, 1, 1), dt.date(1, 1, 2))] + rows[:5]


@pytest.mark.parametrize("rows_per_split", [3, intervals.ROWS_PER_SPLIT])
def test_interval_join_is_all_pairs(spark, rows_per_split):
    rng = random.Random(rows_per_split)
    spells = spell_rows(rng, 150) + [("same", DAY, DAY + dt.timedelta(days=40))] * 30
    points = [(DAY + dt.timedelta(days=rng.randrange(-500, 4100)), k) for k in range(60)]
    points += [(None, -1), points[0], (dt.date(1, 1, 1), 7), (dt.date(9999, 12, 30), 8)]
    found = interval_join(
        spark.createDataFrame(spells, SPELLS).repartition(3), spark.createDataFrame(points, "p date, k int"), "s", "e", "p", rows_per_split
    )
    assert found.columns == ["p", "k", "person", "s", "e"]
    expected = Counter((p, k, n, s, e) for n, s, e in spells for p, k in points if None not in (s, e, p) and s <= p < e)
    assert Counter(map(tuple, found.collect())) == expected


def test_interval_join_with_nothing(spark):
    spells, points = spark.createDataFrame([], SPELLS), spark.createDataFrame([], "p date")
    some = spark.createDataFrame([("a", DAY, DAY + dt.timedelta(days=9))], SPELLS)
    assert interval_join(spells, spark.createDataFrame([(DAY,)], "p date"), "s", "e", "p").collect() == []
    assert interval_join(some, points, "s", "e", "p").collect() == []


def test_interval_join_refuses_shared_names(spark):
    with pytest.raises(ValueError, match="person"):
        interval_join(spark.createDataFrame([], SPELLS), spark.createDataFrame([], "p date, Person int"), "s", "e", "p")


def test_interval_join_plan_has_no_nested_loop_and_no_row_per_day(spark, tour_rows):
    tours = tour_rows([("a", 1, "2019-01-01", None), ("b", 1, "2019-01-01", "2020-01-01")])
    dates = spark.createDataFrame([(dt.date(2019, 5, 1),)], "date date")
    plan = present_on_dates(tours, dates, dt.date(2022, 1, 1))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    # A spell has at most two bins, whatever its length.
    level = F.when(F.datediff("e", "s") > 1, F.length(F.bin(F.datediff("e", "s") - 1))).otherwise(0)
    widths = spark.createDataFrame([("a", DAY + dt.timedelta(days=k), DAY + dt.timedelta(days=k + n)) for n in range(1, 300) for k in (0, 1, 50)], SPELLS)
    widths = widths.withColumns({"l": level, "a": F.unix_date("s"), "b": F.unix_date("e") - 1})
    assert widths.selectExpr("max(shiftright(b, l) - shiftright(a, l))").first()[0] == 1


def test_present_on_dates_counts_dates_once(spark, tour_rows):
    tours = tour_rows([("a", 1, "2019-01-01", None), ("b", 1, "2019-01-01", "2019-05-01"), ("c", 1, None, None)])
    dates = spark.createDataFrame([(dt.date(2019, 5, 1),)] * 2 + [(dt.date(2019, 4, 30),), (dt.date(2023, 1, 1),), (None,)], "date date")
    found = present_on_dates(tours, dates, dt.date(2022, 10, 1)).select("date", "full_name").collect()
    assert sorted((str(r.date), r.full_name) for r in found) == [("2019-04-30", "a"), ("2019-04-30", "b"), ("2019-05-01", "a")]


def test_spell_events(spark):
    rows = [("a", DAY, DAY + dt.timedelta(days=2)), ("b", DAY, None), ("c", DAY, DAY), ("d", DAY, DAY - dt.timedelta(days=1))]
    found = spell_events(spark.createDataFrame(rows, SPELLS), ["person"], "s", "e")
    assert sorted(map(tuple, found.collect())) == [("a", DAY, 1), ("a", DAY + dt.timedelta(days=2), -1)]


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_running_sum_under_a_hot_key(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice(["hot", "hot", None, "b"]), rng.choice([None, rng.randrange(300)]), rng.choice([None, 1, -1, 5])) for _ in range(900)]
    found = running_sum(spark.createDataFrame(rows, "k string, o int, v int").repartition(4), "o", "v", "total", ["k"], ranges)
    expected = []
    for key in ("hot", None, "b"):
        total = 0
        for order in sorted({o for k, o, _ in rows if k == key and o is not None}):
            total += sum(v or 0 for k, o, v in rows if (k, o) == (key, order))
            expected.append((key, order, total))
    assert Counter(map(tuple, found.collect())) == Counter(expected)


def test_no_task_holds_a_hot_key(spark):
    """All rows of one key: each range has its own window partition."""
    df = spark.range(20_000).select(F.lit("k").alias("k"), F.col("id").alias("o"), F.lit(1).alias("v"))
    dealt = intervals.range_number(df, "o", 16).groupBy("__range").count().collect()
    assert len(dealt) == 16 and max(r["count"] for r in dealt) < 1.3 * 20_000 / 16
    total = running_sum(df, "o", "v", "n", ["k"], 16)
    assert total.where("n != o + 1").count() == 0
    plan = total._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "windowspecdefinition" in line]
    assert windows and all("__range" in line for line in windows)


def test_at_once(spark):
    rng = random.Random(6)
    spells = spell_rows(rng, 200)
    df = spark.createDataFrame(spells, SPELLS).repartition(3)
    series = {(r.person, r.date): r.n for r in at_once(df, ["person"], "n", "s", "e").collect()}
    valid = [(n, s, e) for n, s, e in spells if s and e and s < e]
    for (person, date), n in series.items():
        assert n == sum(p == person and s <= date < e for p, s, e in valid)
    assert {d for _, d in series} == {d for _, s, e in valid for d in (s, e)}
    for row in most_at_once(df, ["person"], "n", "s", "e").collect():
        own = {d: n for (p, d), n in series.items() if p == row.person}
        assert row.most_n == max(own.values()) and row.first_date == min(d for d, n in own.items() if n == row.most_n)
