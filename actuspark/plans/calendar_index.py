"""Work-calendar-day index: day-of-week relativities, and each month's index from its days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import MONEY, ratio
from ..operators.frames import calendar

#: Names by Spark's day of the week (fixed values).
DAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def valid_amounts(df: DataFrame, day: str, amount: str, start: str, end: str) -> DataFrame:
    """service_date and paid_amount of rows in the window whose amount is neither null nor negative."""
    rows = df.select(F.col(day).cast("date").alias("service_date"), F.col(amount).cast(MONEY).alias("paid_amount"))
    return rows.where(F.col("service_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")) & (F.col("paid_amount") >= 0))


def relativities(fact: DataFrame) -> DataFrame:
    """day_of_week, dow_name, day_count, avg_daily_paid, std_daily_paid and relativity to the plain mean of the days' averages."""
    daily = fact.groupBy("service_date").agg(F.sum("paid_amount").alias("paid")).withColumn("day_of_week", F.dayofweek("service_date"))
    stats = daily.groupBy("day_of_week").agg(F.count(F.lit(1)).alias("day_count"), ratio(F.sum("paid"), F.count(F.lit(1))).alias("mu"), F.stddev_samp(F.col("paid").cast("double")).alias("sd"))
    grand = stats.agg(F.avg("mu").alias("grand"))
    names = F.array(*[F.lit(d) for d in DAYS])
    return stats.join(F.broadcast(grand)).select(
        "day_of_week",
        F.element_at(names, F.col("day_of_week")).alias("dow_name"),
        "day_count",
        F.round("mu", 2).alias("avg_daily_paid"),
        F.round("sd", 2).alias("std_daily_paid"),
        F.round(ratio(F.col("mu"), F.col("grand")), 6).alias("relativity"),
    )


def monthly(rel: DataFrame, start: str, end: str) -> DataFrame:
    """year_month, total_days, the seven day counts, and the index: the days' relativities weighted by their counts."""
    days = calendar(rel.sparkSession, start, end).select(F.date_format("day", "yyyy-MM").alias("year_month"), F.dayofweek("day").alias("day_of_week"))
    counts = days.groupBy("year_month", "day_of_week").agg(F.count(F.lit(1)).alias("n"))
    joined = counts.join(F.broadcast(rel.select("day_of_week", "relativity")), "day_of_week")
    return joined.groupBy("year_month").agg(
        F.sum("n").alias("total_days"),
        F.round(ratio(F.sum(F.col("n") * F.col("relativity").cast("decimal(18,6)")), F.sum("n")), 6).alias("wcd_index"),
        *[F.sum(F.when(F.col("day_of_week") == k, F.col("n")).otherwise(0)).alias(f"n_{d.lower()}") for k, d in enumerate(DAYS, 1)],
    )
