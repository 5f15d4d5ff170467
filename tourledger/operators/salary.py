"""Median pay and its attachment to persons' grades."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tourledger import names as N
from tourledger.operators.cleaning import GROUP_RECODE, recode
from tourledger.operators.quantiles import group_quantiles

STUDENT_GRADE = "SU-3"


def pooled_median(df: DataFrame, keys: list[str], cols: Iterable[str], name: str = "median") -> DataFrame:
    """One row per key: the median of all values of ``cols`` pooled; NULL if any of them is NULL.

    The values of a group are selected by ranges (``group_quantiles``) and meet in no task.
    """
    values = df.select(*keys, F.explode(F.array(*cols)).alias("value"))
    complete = values.groupBy(*keys).agg(F.count_if(F.col("value").isNull()).alias("nulls")).alias("g")
    medians = group_quantiles(values, keys, "value", [0.5], name).alias("m")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"g.{key}").eqNullSafe(F.col(f"m.{key}"))
    median = F.when(F.col("g.nulls") == 0, F.col(f"m.{name}")).alias(name)
    return complete.join(medians, same, "left").select(*[f"g.{k}" for k in keys], median)


def add_pooled_median(df: DataFrame, keys: list[str], cols: Iterable[str], name: str = "median") -> DataFrame:
    """Every row of ``df`` with its group's pooled median; NULL keys form groups too."""
    medians = pooled_median(df, keys, cols, name).alias("m")
    rows = df.alias("r")
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"r.{key}").eqNullSafe(F.col(f"m.{key}"))
    return rows.join(medians, condition, "left").select("r.*", f"m.{name}")


def split_grade(label: Column) -> tuple[Column, Column]:
    """``IT-2`` -> group ``IT``, level 2. Any student grade counts as level 3."""
    grade = F.when(label.contains(N.STUDENT_GROUP), F.lit(STUDENT_GRADE)).otherwise(label)
    pieces = F.split(grade, "-")
    group = recode(F.get(pieces, F.lit(0)), {"CS": GROUP_RECODE["CS"]})
    return group, F.get(pieces, F.lit(1)).try_cast("int")


def attach_salary(df: DataFrame, pay: DataFrame) -> DataFrame:
    """Split both grade labels, add each grade's median pay and the relative change.

    ``pay`` has ``group``, ``level`` and ``median``. Its keys match NULL to NULL, and a
    grade it lists several times fans out.
    """
    earliest_group, earliest_level = split_grade(F.col("earliest_group_level"))
    latest_group, latest_level = split_grade(F.col("latest_group_level"))
    graded = df.withColumns(
        {
            "earliest_group": earliest_group,
            "earliest_level": earliest_level,
            "latest_group": latest_group,
            "latest_level": latest_level,
        }
    ).drop("earliest_group_level", "latest_group_level")

    for when in ("earliest", "latest"):
        rates = pay.select("group", "level", F.col("median").alias(f"{when}_median_salary")).alias("p")
        same_grade = F.col(f"t.{when}_group").eqNullSafe(F.col("p.group")) & F.col(
            f"t.{when}_level"
        ).eqNullSafe(F.col("p.level"))
        graded = graded.alias("t").join(rates, same_grade, "left").select("t.*", f"p.{when}_median_salary")

    earliest, latest = F.col("earliest_median_salary"), F.col("latest_median_salary")
    return graded.withColumn("salary_change_percentage", F.try_divide(latest - earliest, earliest))
