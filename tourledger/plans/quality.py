"""What in the inputs the reports rely on and may not find."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tourledger.operators.cleaning import ALIAS_FROM, NAME_KEY, duplicate_keys
from tourledger.operators.spells import spell_problems
from tourledger.plans.tables import Tables


def duplicate_lookup_keys(tables: Tables) -> DataFrame:
    """Keys that the alias, roster and pay lookups hold more than once: lookup, key, row_count."""
    lookups = {
        "aliases": (tables.inputs.name_harmonization, [ALIAS_FROM]),
        "roster": (tables.roster, [NAME_KEY]),
        "pay": (tables.pay_medians.select("group", "level", "median").distinct(), ["group", "level"]),
    }
    found = []
    for name, (df, keys) in lookups.items():
        key = F.concat_ws(" ", *[F.col(k).cast("string") for k in keys])
        found.append(duplicate_keys(df, keys).select(F.lit(name).alias("lookup"), key.alias("key"), "row_count"))
    return reduce(DataFrame.unionByName, found)


def quality_report(tables: Tables, unparsed: DataFrame | None = None) -> DataFrame:
    """Rows (check_name, problems): repeated lookup keys, tours without a start or with an end
    before it, and, where ``unparsed`` counts them by column, texts that did not parse."""
    kinds = duplicate_lookup_keys(tables).groupBy("lookup").agg(F.count("*").alias("n"))
    names = ("aliases", "roster", "pay")
    counts = kinds.agg(*[F.coalesce(F.sum(F.when(F.col("lookup") == n, F.col("n"))), F.lit(0)).alias(n) for n in names])

    def rows(df: DataFrame, checks: dict[str, str]) -> DataFrame:
        pairs = [F.struct(F.lit(check).alias("check_name"), F.col(c).cast("long").alias("problems")) for c, check in checks.items()]
        return df.select(F.inline(F.array(*pairs)))

    report = rows(counts, {n: f"repeated keys in {n}" for n in names}).unionByName(
        rows(spell_problems(tables.tours), {"without_start": "tours without a start", "reversed": "tours that end before they start"})
    )
    if unparsed is not None:
        named = F.concat(F.lit("texts not parsed in "), "column_name").alias("check_name")
        report = report.unionByName(unparsed.select(named, "problems"))
    return report
