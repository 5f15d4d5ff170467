import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tourledger.operators.quantiles import group_quantiles
from tourledger.operators.salary import pooled_median

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def quantile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


@pytest.mark.parametrize("ranges", [1, 5, 64])
def test_quantiles_are_those_of_sorted_values(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.choice([1, None]), rng.choice([None, rng.randrange(50), rng.gauss(0, 9)])) for _ in range(900)]
    rows = [(k, j, None if v is None else float(v)) for k, j, v in rows] + [("one", 1, 4.5), ("none", 1, None), ("two", 1, 1.0), ("two", 1, 2.0)]
    groups = defaultdict(list)
    for k, j, v in rows:
        if v is not None:
            groups[k, j].append(v)
    found = group_quantiles(spark.createDataFrame(rows, "k string, j int, v double").repartition(4), ["k", "j"], "v", PROBABILITIES, "q", ranges)
    got = {(r.k, r.j, r.probability): r.q for r in found.collect()}
    assert found.count() == len(got) == len(groups) * len(PROBABILITIES)
    for (k, j, p), q in got.items():
        assert q == pytest.approx(quantile(groups[k, j], p))


def test_no_group_and_no_key(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,)], "v double")
    assert [tuple(r) for r in group_quantiles(df, [], "v", [0.5]).collect()] == [(0.5, 2.0)]
    assert group_quantiles(df.limit(0), [], "v", [0.5]).collect() == []
    with pytest.raises(ValueError, match="between"):
        group_quantiles(df, [], "v", [1.5])


def test_a_hot_group_is_ordered_range_by_range(spark):
    """One group of 60,000 distinct values: only ranges with a quantile are ordered, none of
    them holds more than its share, and no window runs over a group's values."""
    df = spark.range(60_000).select(F.lit("hot").alias("k"), F.col("id").cast("double").alias("v"))
    out = group_quantiles(df, ["k"], "v", [0.25, 0.5], "q", 30)
    assert sorted(r.q for r in out.collect()) == [14999.75, 29999.5]
    plan = out._jdf.queryExecution().executedPlan().toString()
    over_values = [line for line in plan.splitlines() if "Window [" in line and "__value" in line]
    assert over_values and all("__range" in line for line in over_values) and "Python" not in plan


def test_pooled_median_goes_through_them(spark):
    df = spark.createDataFrame([("a", 1.0, 4.0), ("a", 2.0, 3.0), ("b", None, 1.0), (None, 5.0, 5.0)], "k string, lo double, hi double")
    assert {(r.k, r.median) for r in pooled_median(df, ["k"], ["lo", "hi"]).collect()} == {("a", 2.5), ("b", None), (None, 5.0)}
