"""Reference tables of the features: calendar, population, risk and seasonality, joined by coarser keys with a guard against fan-out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import lag_months, ratio
from ..operators import frames
from .forecast import MONTH

#: Population and risk are not told apart by dual status.
PLACE = ["MARKET", "SEGMENT", MONTH]
AGES = ("Pediatric", "Adult", "Senior")


def load_calendar(dense: DataFrame) -> DataFrame:
    """month, MONTH_NBR, LINEAR_MONTH (months since the first one) and WORKDAY (Monday to Friday) of the months between the data's first and last."""
    bounds = dense.agg(F.min(MONTH).alias("lo"), F.max(MONTH).alias("hi"))
    days = bounds.select("lo", F.explode(F.sequence("lo", F.last_day("hi"))).alias("day")).select("lo", "day", F.trunc("day", "month").alias(MONTH))
    return days.groupBy(MONTH).agg(
        F.month(MONTH).alias("MONTH_NBR"),
        lag_months(F.col(MONTH), F.min("lo")).alias("LINEAR_MONTH"),
        F.count_if(F.weekday("day") < 5).alias("WORKDAY"),
    )


def load_population(members: DataFrame) -> DataFrame:
    """Shares of member months by age group and of women, for each place and month. ``members``: PLACE, AGE_GROUP, FEMALE, MED_MM."""
    rules = {f"{a.upper()}": F.col("AGE_GROUP") == a for a in AGES} | {"FEMALE": F.col("FEMALE") == 1}
    sums = frames.bucket_sums(members.withColumn("ALL", F.lit(True)), PLACE, "MED_MM", rules | {"TOTAL": F.col("ALL")})
    out = frames.shares(sums, list(rules), "TOTAL")
    return out.select(*PLACE, *[F.col(f"{b}_share").alias(f"{b}_SHARE") for b in rules])


def load_risk(members: DataFrame) -> DataFrame:
    """Risk weighted by member months, for each place and month. ``members``: PLACE, RISK, MED_MM."""
    return members.groupBy(*PLACE).agg(ratio(F.sum(F.col("RISK") * F.col("MED_MM")), F.sum("MED_MM")).alias("PROSP_RISK"))


def enrich_signals(signals: DataFrame, dense: DataFrame, members: DataFrame, factors: DataFrame) -> DataFrame:
    """``signals`` with calendar, population, risk and the seasonal factor (1 where there is none); no join changes the number of rows.

    ``factors``: MARKET, SERVICE_CATEGORY, month, factor.
    """
    seasonal = factors.select("MARKET", "SERVICE_CATEGORY", F.col("month").alias("MONTH_NBR"), F.col("factor").alias("SEASONAL_FACTOR"))
    dims = [(load_calendar(dense), [MONTH]), (load_population(members), PLACE), (load_risk(members), PLACE), (seasonal, ["MARKET", "SERVICE_CATEGORY", "MONTH_NBR"])]
    return frames.enrich(signals, dims).withColumn("SEASONAL_FACTOR", F.coalesce("SEASONAL_FACTOR", F.lit(1.0)))
