"""Unit x period outcomes derived from orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keepwell.sources.customers import table

#: Period 0 is the first half of this year.
EVENT_YEAR = 2001


def _half(date: Column) -> Column:
    return (F.year(date) - EVENT_YEAR) * 2 + (F.month(date) > 6).cast("int")


def full_periods(orders: DataFrame) -> list[int]:
    """Half-years from the first that the orders cover from its first day, to the event's."""
    first = orders.agg(F.min("o_orderdate").alias("day")).select(
        _half(F.col("day")).alias("half"), ((F.month("day") % 6 == 1) & (F.dayofmonth("day") == 1)).alias("whole")).first()
    if first["half"] is None:
        return [0]
    return list(range(min(0, first["half"] + (0 if first["whole"] else 1)), 1))


def activity_panel(spark: SparkSession, folder: str, pre_periods: int | None = None) -> DataFrame:
    """Half-years per customer up to the event; the outcome is a half-year without orders.

    All full half-years before the event are there, or the last ``pre_periods`` of
    them. One aggregate per customer flags the active periods; the periods are then
    unfolded inside the row, so the long panel is never shuffled.
    """
    orders = table(spark, folder, "orders")
    periods = full_periods(orders)
    periods = periods if pre_periods is None else periods[-1 - pre_periods:]
    active = orders.select("o_custkey", _half(F.col("o_orderdate")).alias("half")).groupBy("o_custkey").agg(
        *[F.max((F.col("half") == p).cast("int")).alias(f"a{i}") for i, p in enumerate(periods)])
    group = (F.col("c_nationkey") % 3 == 1).cast("int")
    rows = F.array(*[F.struct(F.lit(p).alias("period"), (1 - F.col(f"a{i}")).alias("churned"))
                     for i, p in enumerate(periods)])
    return (table(spark, folder, "customer").join(active, F.col("c_custkey") == F.col("o_custkey"))
            .select("c_custkey", group.alias("treated_group"), F.explode(rows).alias("r"))
            .select("c_custkey", "treated_group", F.col("r.period").alias("period"),
                    (F.col("r.period") == 0).cast("int").alias("post"), F.col("r.churned").alias("churned")))
