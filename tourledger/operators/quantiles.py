"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tourledger.operators.intervals import RANGES, range_number


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], name: str = "value", ranges: int = RANGES
) -> DataFrame:
    """Rows (keys, ``probability``, ``name``): the exact quantiles of ``value`` in each group, interpolated
    between neighbours as ``percentile`` does. NULL values are left out, and a group of
    nothing else with them; NULL keys form groups.

    Values are selected in two steps. Equal values of a group are counted, and the counts added
    up by ranges of values, which all groups share and which hold about equally many of the
    counted rows; from these totals follows in which ranges a group's quantiles lie. Only their
    values are ordered, range by range, so that a group never meets in one task.
    """
    if not probabilities or any(not 0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities lie between 0 and 1")
    keys = list(keys)
    own = [f"__k{i}" for i in range(len(keys))]
    rows = df.where(F.col(value).isNotNull()).select(*[F.col(k).alias(o) for k, o in zip(keys, own)], F.col(value).alias("__value"))
    counted = rows.groupBy(*own, "__value").agg(F.count("*").alias("__n"))
    dealt = range_number(counted, "__value", ranges)

    of_group = Window.partitionBy(*own)
    earlier = of_group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*own, "__range").agg(F.sum("__n").alias("__held"))
    totals = totals.withColumns(
        {"__before": F.coalesce(F.sum("__held").over(earlier), F.lit(0)), "__all": F.sum("__held").over(of_group)}
    )
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    totals = totals.withColumn("probability", F.explode(wanted)).withColumn("__at", F.col("probability") * (F.col("__all") - 1))
    # The two neighbours of a quantile by their positions from 0; they may lie in two ranges.
    totals = totals.withColumn("__position", F.explode(F.array_distinct(F.array(F.floor("__at"), F.ceil("__at")))))
    held = (F.col("__position") >= F.col("__before")) & (F.col("__position") < F.col("__before") + F.col("__held"))
    asked = totals.where(held)

    in_range = Window.partitionBy(*own, "__range").orderBy("__value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = F.col("d.__range") == F.col("r.__range")
    for key in own:
        same = same & F.col(f"d.{key}").eqNullSafe(F.col(f"r.{key}"))
    needed = asked.select(*own, "__range").distinct().alias("r")
    kept = dealt.alias("d").join(needed, same, "left_semi")
    ranked = kept.withColumn("__up_to", F.sum("__n").over(in_range)).alias("d")
    joined = asked.alias("r").join(ranked, same)
    position = F.col("r.__position") - F.col("r.__before")
    found = joined.where((position < F.col("d.__up_to")) & (position >= F.col("d.__up_to") - F.col("d.__n")))
    # The nearer neighbour weighs more; a quantile on a value has that one alone.
    weight = F.lit(1.0) - F.abs(F.col("r.__at") - F.col("r.__position"))
    parts = found.select(*[f"r.{o}" for o in own], "r.probability", (F.col("d.__value").cast("double") * weight).alias("__part"))
    quantile = F.sum("__part").alias(name)
    return parts.groupBy(*own, "probability").agg(quantile).select(*[F.col(o).alias(k) for o, k in zip(own, keys)], "probability", name)
