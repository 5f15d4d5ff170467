"""Engine inputs derived from the driver tables, as lazy DataFrames over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tourledger import names as N
from tourledger.plans.tables import Inputs
from tourledger.sources.tables import load_table

AS_OF = dt.date(2001, 12, 31)
FIRST_MONTH = dt.date(1995, 1, 1)
HOME = "AMERICA"
SLICE = "Building"



def _schema(**types) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in types.items()])


SCHEMAS = {
    "orders": _schema(
        o_orderkey=LongType,
        o_custkey=LongType,
        o_orderstatus=StringType,
        o_totalprice=DoubleType,
        o_orderdate=TimestampNTZType,
        o_orderpriority=StringType,
    ),
    "customer": _schema(
        c_custkey=LongType,
        c_name=StringType,
        c_nationkey=IntegerType,
        c_acctbal=DoubleType,
        c_mktsegment=StringType,
    ),
    "nation": _schema(n_nationkey=IntegerType, n_name=StringType, n_regionkey=IntegerType),
    "region": _schema(r_regionkey=IntegerType, r_name=StringType),
    "part": _schema(
        p_partkey=LongType,
        p_name=StringType,
        p_brand=StringType,
        p_type=StringType,
        p_size=IntegerType,
        p_retailprice=DoubleType,
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def _chain(*branches: tuple[Column, object], otherwise: object = None) -> Column:
    out = F.lit(otherwise) if not isinstance(otherwise, Column) else otherwise
    for condition, value in reversed(branches):
        out = F.when(condition, value).otherwise(out)
    return out


def ranked_orders(orders: DataFrame) -> DataFrame:
    """Orders with ``o_rank``, their position among the customer's orders.

    Orders are ranked per customer and day and the number of earlier orders is added, so a
    customer with any share of them spreads over as many tasks as there are days.
    """
    per_day = orders.groupBy("o_custkey", "o_orderdate").agg(F.count("*").alias("n"))
    earlier_days = Window.partitionBy("o_custkey").orderBy("o_orderdate").rowsBetween(Window.unboundedPreceding, -1)
    earlier = per_day.select("o_custkey", "o_orderdate", F.coalesce(F.sum("n").over(earlier_days), F.lit(0)).alias("earlier"))
    in_day = Window.partitionBy("o_custkey", "o_orderdate").orderBy("o_orderkey")
    ranked, day = orders.withColumn("in_day", F.row_number().over(in_day)).alias("o"), earlier.alias("e")
    same = F.col("o.o_custkey").eqNullSafe(F.col("e.o_custkey")) & F.col("o.o_orderdate").eqNullSafe(F.col("e.o_orderdate"))
    rank = (F.col("in_day") + F.col("earlier")).cast("int")
    return ranked.join(day, same).select("o.*", rank.alias("o_rank")).drop("in_day")


def tenure_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = ranked_orders(table(spark, sf_dir, "orders"))
    customer = table(spark, sf_dir, "customer")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    first_place = places.select(F.col("n_nationkey").alias("first_nation"), F.col("r_name").alias("first_region"))
    last_place = places.select(F.col("n_nationkey").alias("last_nation"), F.col("r_name").alias("last_region"))

    order, cust = F.col("o_orderkey"), F.col("c_custkey")
    priority, is_open = F.col("o_orderpriority"), F.col("o_orderstatus") == "O"
    tour = F.when((F.col("o_rank") == 1) & (cust % 9 == 0), None).otherwise(F.col("o_rank"))
    discipline = F.lower(F.when(order % 11 == 0, "admin-operations").otherwise(F.col("c_mktsegment")))
    program = _chain((cust % 10 == 0, "student"), (cust % 10 == 1, "c4c_fellow"))
    end = F.least(F.date_add("o_orderdate", (order * 37 % 1200).cast("int")), F.lit(AS_OF))
    departure = _chain(
        (is_open, None),
        (order % 7 == 0, "to_other_department"),
        (order % 7 == 1, "to_other_government"),
        (order % 7 == 2, "to_private_sector"),
        (order % 7 == 3, "to_non_profit"),
        ((order % 7 == 4) & (order % 4 == 0), "retired"),  # a type without a place of its own
        (order % 7 == 4, "to_academia"),
        (order % 7 == 5, N.SWITCH),
    )
    source = _chain(
        (priority == "1-URGENT", "from_private_sector"),
        (priority == "2-HIGH", "from_other_department"),
        (priority == "3-MEDIUM", "from_academia"),
        ((priority == "5-LOW") & (order % 5 == 0), "from_other_staffing_program"),
        (priority == "5-LOW", "from_non_profit"),
        (order % 2 == 0, "?from_somewhere"),
    )
    status = _chain(
        (order % 97 == 0, "not_onboarded"),
        (order % 97 == 1, "incoming"),
        (order % 97 == 2, "pre_trello_board"),
        (order % 97 == 3, "start_date_confirmed"),
        otherwise="onboarded",
    )
    return (
        orders.join(customer, F.col("o_custkey") == cust)
        .join(first_place, F.col("c_nationkey") == F.col("first_nation"))
        .join(last_place, (F.col("c_nationkey") + order % 3) % 25 == F.col("last_nation"))
        .select(
            F.replace("c_name", F.lit("#"), F.lit(" ")).alias(N.PERSON),
            tour.alias(N.TOUR),
            discipline.alias(N.DISCIPLINE),
            program.alias(N.PROGRAM),
            F.col("first_region").alias(N.LOCATION_FIRST),
            F.col("last_region").alias(N.LOCATION_LAST),
            F.col("o_orderdate").alias(N.START),
            F.when(~is_open, end).alias(N.END),
            departure.alias(N.DEPARTURE),
            source.alias(N.SOURCE),
            status.alias(N.STATUS),
            F.concat(F.lit("private "), priority).alias(N.NOTES),
        )
    )


def level_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grade roster of all customers. Every 13th entry has no comma, so it is junk to the
    roster cleanup and its person has no grades."""
    key = F.col("c_custkey")

    def grade(group: Column, level: Column) -> Column:
        return F.concat(F.lit("G"), group.cast("string"), F.lit("-"), level.cast("string"))

    number = F.split_part("c_name", F.lit("#"), F.lit(2))
    rest = _chain((key % 13 == 0, " Forecast"), (key % 50 == 0, ",Custom"), otherwise=",Customer")
    shifted = key + F.when(key % 3 == 0, 1).otherwise(0)
    rows = table(spark, sf_dir, "customer").select(
        F.concat(number, rest).alias("name"),
        F.when(key % 23 == 0, N.DATE_SENTINEL).otherwise("2016-10-03").alias("earliest_date"),
        F.lit("2022-10-01").alias("latest_date"),
        _chain((key % 10 == 0, "SU"), (key % 17 == 0, "CS-2"), otherwise=grade(key % 8, key % 4 + 1)).alias(
            "earliest_group_level"
        ),
        _chain(
            (key % 20 == 0, "SU-2"),
            (key % 17 == 0, "IT-3"),
            otherwise=grade(shifted % 8, F.least(key % 4 + 1 + key % 2, F.lit(4))),
        ).alias("latest_group_level"),
    )
    junk = ("Global Forecast", "2020-01-01", "2020-01-01", "XX-1", "XX-1")
    extra = spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(c) for v, c in zip(junk, rows.columns)])
    return rows.unionByName(extra)


def name_harmonization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster name of the customers; every 50th is listed there under another first name. Every
    third, but for those, has no alias and is found under its own name."""
    first_name = F.when(F.col("c_custkey") % 50 == 0, "CUSTOM ").otherwise("CUSTOMER ")
    listed = table(spark, sf_dir, "customer").where("c_custkey % 50 = 0 OR c_custkey % 3 <> 0")
    return listed.select(
        F.upper(F.replace("c_name", F.lit("#"), F.lit(" "))).alias("tenure_data_full_name"),
        F.concat(first_name, F.split_part("c_name", F.lit("#"), F.lit(2))).alias("level_data_full_name"),
    )


def pay_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size") % 4
    level = (size + 1).cast("string")
    kind = F.col("p_type")
    label = _chain(
        (kind == "PROMO", F.concat(F.lit("DA-PRO-"), level)),
        (kind == "ECONOMY", F.concat(F.lit("CS-0"), level)),
        ((kind == "SMALL") & (size == 0), "STUDENT-03"),
        (kind == "SMALL", "PI-1-CGC"),
        otherwise=F.concat(F.lit("G"), (F.col("p_partkey") % 8).cast("string"), F.lit("-0"), level),
    )
    price = F.col("p_retailprice")
    return (
        table(spark, sf_dir, "part")
        .groupBy(label.alias("label"))
        .agg(F.min(price).alias("min"), F.max(price).alias("max"))
    )


def board_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, name = F.col("o_orderkey"), F.replace("c_name", F.lit("#"), F.lit(" "))
    card = _chain(
        (order % 40 == 0, "Template card"),
        (order % 40 == 1, "PLACEHOLDER - x"),
        (order % 40 == 2, name),
        otherwise=F.concat(name, F.lit(" - "), F.col("c_mktsegment"), F.lit(" - "), F.col("o_orderpriority")),
    )
    status = F.col("o_orderstatus")
    board_list = _chain((status == "O", "Pre-First Day"), (status == "P", "Start Date CONFIRMED"), otherwise="Done")
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            card.alias("card_name"),
            F.col("o_orderdate").alias("due_date"),
            F.col("o_orderdate").alias("last_activity_date"),
            board_list.alias("list_name"),
        )
    )


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        tenure_raw=tenure_raw(spark, sf_dir),
        level_raw=level_raw(spark, sf_dir),
        name_harmonization=name_harmonization(spark, sf_dir),
        pay_rates=pay_rates(spark, sf_dir),
        as_of=AS_OF,
        first_month=FIRST_MONTH,
        home=HOME,
        slice_discipline=SLICE,
        other_departure_types=("retired",),
    )
