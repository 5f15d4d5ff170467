import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tourledger.operators.densify import DAYS_PER_PIECE, densify

DAY = dt.date(2000, 1, 1)
SCHEMA = "k string, j int, d date, a string, b int, other string"


def brute(rows, step):
    """Day by day."""
    groups = defaultdict(lambda: defaultdict(list))
    for k, j, d, a, b, _ in rows:
        if d is not None:
            groups[k, j][d].append((a, b))
    found = set()

    def rank(pair):
        return (pair[0] is not None, pair[0] or "", pair[1] is not None, pair[1] or 0)

    for (k, j), days in groups.items():
        carried, first = [None, None], min(days)
        for n in range((max(days) - first).days + 1):
            day = first + dt.timedelta(days=n)
            if day in days:
                carried = [new if new is not None else old for old, new in zip(carried, max(days[day], key=rank))]
            if n % step == 0:
                found.add((k, j, day, *carried, day in days))
    return found


@pytest.mark.parametrize("days_per_piece", [1, 10, DAYS_PER_PIECE])
@pytest.mark.parametrize("step", [1, 7])
def test_every_date_with_the_last_values(spark, step, days_per_piece):
    """One key holds a third of the rows; nulls, repeated days and keys, days before 1970."""
    rng = random.Random(step)
    rows = []
    for n in range(240):
        key = ("hot", 1) if n % 3 == 0 else (rng.choice(["a", None, "b"]), rng.choice([None, 1, 2]))
        day = rng.choice([None, *[DAY + dt.timedelta(days=rng.randrange(-20, 150))] * 6])
        rows.append((*key, day, rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]), "o"))
    rows += [("old", 1, dt.date(1969, 12, 30), None, 4, None), ("old", 1, dt.date(1970, 1, 3), "z", None, None), *rows[:4]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = [tuple(r) for r in densify(df, ["k", "j"], "d", ["a", "b"], step, days_per_piece).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows, step)


def test_columns_and_nothing(spark):
    empty = densify(spark.createDataFrame([], SCHEMA), ["k"], "d", ["a"])
    assert empty.columns == ["k", "d", "a", "observed"] and empty.collect() == []
    with pytest.raises(ValueError, match="step"):
        densify(empty, ["k"], "d", ["a"], step=0)


def test_a_hot_key_is_spread(spark):
    """300,000 rows of one key on 300 days: they are one row per day before any window, and
    windows over days are cut into pieces."""
    df = spark.range(300_000).select(
        F.lit("hot").alias("k"), F.date_add(F.lit(DAY), (F.col("id") % 300).cast("int")).alias("d"), (F.col("id") % 7).alias("a")
    )
    out = densify(df, ["k"], "d", ["a"], 1, 32)
    assert out.count() == 300 and out.where("a = 6 AND observed").count() == 300
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") + plan.count("SortAggregate") >= 2 and "Python" not in plan and "NestedLoop" not in plan
    over_days = [line for line in plan.splitlines() if "Window [" in line and "__day" in line and "lead(" in line and "__begin" not in line]
    assert over_days and all("__piece" in line for line in over_days)
