"""Cleaning of the input tables, and joining persons to their grade records by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tourledger import names as N
from tourledger.functions.text import title_case

NAME_KEY = "full_name_uc"
ALIAS_FROM = "tenure_data_full_name"
ALIAS_TO = "level_data_full_name"

# Status codes.
STATUS_RECODE = {"pre_trello_board": "onboarded"}
STATUS_DROPPED = ("not_onboarded", "incoming", "start_date_confirmed")
DISCIPLINE_RECODE = {"admin-operations": "admin / operations"}
GROUP_RECODE = {"CS": "IT", "STUDENT": "SU"}


def recode(column: Column, mapping: dict[str, str]) -> Column:
    """Replace the mapped values and keep all others, NULL included."""
    out = column
    for old, new in mapping.items():
        out = F.when(column == old, F.lit(new)).otherwise(out)
    return out


def sentinel_to_null(df: DataFrame, cols: Iterable[str], sentinel: str = N.DATE_SENTINEL) -> DataFrame:
    """Turn a sentinel date text into NULL and parse the rest as DATE."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)).try_cast("date") for c in cols})


def clean_roster(df: DataFrame) -> DataFrame:
    """Grade roster: ``LAST,FIRST`` rows that have an earliest date, keyed by ``FIRST LAST`` in capitals.

    The piece after the comma is not trimmed, so ``LAST, FIRST`` keeps its space; the
    alias table repairs such names.
    """
    dated = sentinel_to_null(df, ("earliest_date", "latest_date"))
    pieces = F.split("name", ",")
    key = F.upper(F.concat_ws(" ", F.get(pieces, F.lit(1)), F.get(pieces, F.lit(0))))
    return (
        dated.where(F.col("name").contains(",") & F.col("earliest_date").isNotNull())
        .withColumn(NAME_KEY, key)
        .drop("name")
    )


def join_with_aliases(df: DataFrame, aliases: DataFrame, attrs: DataFrame, person: str = N.PERSON) -> DataFrame:
    """Left join ``attrs`` on the upper-case name, or on its alias where there is one.

    No side is hinted: Spark broadcasts a lookup whose size is under its threshold and
    shuffles it otherwise, with adaptive skew splitting. Repeated lookup keys fan out.
    """
    keyed = df.withColumn(NAME_KEY, F.upper(person)).alias("t")
    named = keyed.join(aliases.alias("a"), F.col(f"t.{NAME_KEY}") == F.col(f"a.{ALIAS_FROM}"), "left").select(
        "t.*", F.coalesce(f"a.{ALIAS_TO}", f"t.{NAME_KEY}").alias(ALIAS_TO)
    )
    kept = attrs.drop("earliest_date", "latest_date").withColumnRenamed(NAME_KEY, ALIAS_TO)
    return named.drop(NAME_KEY).join(kept, ALIAS_TO, "left").drop(ALIAS_TO)


def name_mismatches(a: DataFrame, b: DataFrame, key: str = NAME_KEY) -> DataFrame:
    """Names found on one side only, with ``missing_from`` = ``a`` or ``b``.

    Both sides are made distinct before the join, so a name held by many rows is one row there.
    """
    left, right = a.select(key).distinct(), b.select(key).distinct()

    def only_in(x: DataFrame, y: DataFrame, side: str) -> DataFrame:
        x, y = x.alias("x"), y.alias("y")
        missing = x.join(y, F.col(f"x.{key}").eqNullSafe(F.col(f"y.{key}")), "left_anti")
        return missing.withColumn("missing_from", F.lit(side))

    return only_in(left, right, "b").unionByName(only_in(right, left, "a"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count. Empty for a proper lookup."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def parse_pay_rates(df: DataFrame, label: str = "label") -> DataFrame:
    """``GROUP-LEVEL`` or ``GROUP-SUB-LEVEL`` labels as ``group`` and integer ``level``.

    Leading zeroes go; a level that is not a number becomes NULL.
    """
    pieces = F.split(label, "-")
    first, second, third = (F.get(pieces, F.lit(i)) for i in range(3))
    group = F.when(third.isNotNull(), F.concat(first, F.lit("-"), second)).otherwise(first)
    level = F.regexp_replace(F.coalesce(third, second), "^0+", "")
    rest = [c for c in df.columns if c != label]
    return df.select(
        recode(group, GROUP_RECODE).alias("group"), level.try_cast("int").alias("level"), *rest
    )


def clean_tours(df: DataFrame) -> DataFrame:
    """Onboarded tours only, with defaults filled in and discipline names in title case."""
    status = recode(F.col(N.STATUS), STATUS_RECODE)
    discipline = recode(F.col(N.DISCIPLINE), DISCIPLINE_RECODE)
    departure = F.when(
        F.col(N.END).isNotNull(), F.coalesce(N.DEPARTURE, F.lit(N.UNKNOWN_DEPARTURE))
    ).otherwise(F.col(N.DEPARTURE))
    return df.where(F.col(N.STATUS).isNotNull() & ~F.col(N.STATUS).isin(*STATUS_DROPPED)).withColumns(
        {
            N.STATUS: status,
            N.TOUR: F.coalesce(F.col(N.TOUR), F.lit(1)).cast("int"),
            N.DEPARTURE: departure,
            N.PROGRAM: F.coalesce(N.PROGRAM, F.lit(N.DEFAULT_PROGRAM)),
            N.DISCIPLINE: title_case(discipline),
        }
    )
