"""Filling the gaps of dated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

#: Days of a piece: a key has one row per day at most, so windows inside pieces see no more rows.
DAYS_PER_PIECE = 4096


def densify(
    df: DataFrame, keys: Sequence[str], date: str, carry: Sequence[str], step: int = 1, days_per_piece: int = DAYS_PER_PIECE
) -> DataFrame:
    """One row per key and date, every ``step`` days from the key's first date up to its last.

    A row has, for each ``carry`` column, the last value that is not NULL among the key's rows up to that
    date, and ``observed`` tells whether the key has a row on the very date. Several rows of a
    day count as the greatest by ``carry``, column by column, NULL least. NULL keys are keys;
    rows with a NULL date are left out.

    A key's days are cut into pieces. Inside a piece a row finds the next one and carries values on;
    the first day and the last values of whole pieces are passed from piece to piece, so that
    the rows of a key meet in no task.
    """
    if step < 1:
        raise ValueError("a step is one day at least")
    keys, carry = list(keys), list(carry)
    at = {f"__k{i}": F.col(k) for i, k in enumerate(keys)}
    own, values = list(at), [f"__v{i}" for i in range(len(carry))]
    rows = df.where(F.col(date).isNotNull()).select(
        *[c.alias(n) for n, c in at.items()],
        F.unix_date(F.col(date).cast("date")).alias("__day"),
        F.struct(*[F.col(c).alias(v) for c, v in zip(carry, values)], F.lit(1).alias("__there")).alias("__values"),
    )
    # Repeated days of a key are one row before anything is ordered, by a map-side aggregate.
    days = rows.groupBy(*own, "__day").agg(F.max("__values").alias("__values"))
    days = days.select(*own, "__day", F.floor(F.col("__day") / days_per_piece).cast("int").alias("__piece"), *[f"__values.{v}" for v in values])

    def last(column: str):
        return F.max(F.when(F.col(column).isNotNull(), F.struct("__day", column)))

    pieces = days.groupBy(*own, "__piece").agg(
        F.min("__day").alias("__begin"), *[last(v).alias(f"__last{v}") for v in values]
    )
    before = Window.partitionBy(*own).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    in_key = Window.partitionBy(*own).orderBy("__piece")
    pieces = pieces.select(
        *own,
        "__piece",
        F.min("__begin").over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("__first"),
        F.lead("__begin").over(in_key).alias("__after"),
        *[F.last(f"__last{v}", True).over(before).getField(v).alias(f"__from{v}") for v in values],
    )
    in_piece = Window.partitionBy(*own, "__piece").orderBy("__day")
    so_far = in_piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = days.select(
        *own, "__piece", "__day", F.lead("__day").over(in_piece).alias("__next"), *[F.last(v, True).over(so_far).alias(v) for v in values]
    )
    left, right = days.alias("d"), pieces.alias("p")
    same = F.col("d.__piece") == F.col("p.__piece")
    for key in own:
        same = same & F.col(f"d.{key}").eqNullSafe(F.col(f"p.{key}"))
    joined = left.join(right, same).select(
        *[f"d.{k}" for k in own],
        "d.__day",
        "p.__first",
        F.coalesce("d.__next", "p.__after", F.col("d.__day") + 1).alias("__until"),
        *[F.coalesce(f"d.{v}", f"p.__from{v}").alias(v) for v in values],
    )
    # The dates of a row are the multiples of the step, counted from the key's first day, up to the next row.
    skipped = F.ceil((F.col("__day") - F.col("__first")) / F.lit(step))
    begin = (F.col("__first") + skipped * step).cast("int")
    dates = joined.withColumn("__begin", begin).where("__begin < __until")
    filled = dates.withColumn("__date", F.explode(F.expr(f"sequence(__begin, __until - 1, {int(step)})")))
    return filled.select(
        *[F.col(n).alias(k) for n, k in zip(own, keys)],
        F.date_from_unix_date("__date").alias(date),
        *[F.col(v).alias(c) for v, c in zip(values, carry)],
        (F.col("__date") == F.col("__day")).alias("observed"),
    )
