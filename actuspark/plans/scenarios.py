"""Slices, run metadata and populations of the monthly table, and the rolling-origin backtest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import lag_months, ratio
from .forecast import MONTH, SPLIT

POPULATION = ["SEGMENT", "IS_DUAL"]


def snapshot_slice(df: DataFrame, val_date: str) -> DataFrame:
    """The rows of one valuation date; a filter on the partition column of the table that ``write_slice`` makes."""
    return df.where(F.col("VAL_DATE") == F.lit(val_date).cast("date"))


def scenario(df: DataFrame, val_date: str, train_end: str, hcc: str) -> DataFrame:
    return snapshot_slice(df, val_date).where((F.col("TRAIN_END") == F.lit(train_end).cast("date")) & (F.col("HCC") == hcc))


def stamp_run(df: DataFrame, val_date: str, train_end: str, months: int) -> DataFrame:
    """VAL_DATE, TRAIN_END, and the first and last month of the projection."""
    end = F.lit(train_end).cast("date")
    return df.withColumns({"VAL_DATE": F.lit(val_date).cast("date"), "TRAIN_END": end, "PROJECTION_START": F.add_months(end, 1), "PROJECTION_END": F.add_months(end, months)})


def projection_flags(df: DataFrame, start: str) -> DataFrame:
    """IS_PROJECTION from ``start`` on, and HORIZON_MONTH: 1 in the first projected month, null before."""
    at = F.lit(start).cast("date")
    ahead = F.col(MONTH) >= at
    return df.withColumns({"IS_PROJECTION": ahead, "HORIZON_MONTH": F.when(ahead, lag_months(F.col(MONTH), at) + 1)})


def train_start(df: DataFrame, keys: list[str], burn_in: int) -> DataFrame:
    """The first month of each series that has ``burn_in`` months before it in the calendar."""
    return df.groupBy(*keys).agg(F.add_months(F.min(MONTH), burn_in).alias("TRAIN_START"))


def n_train_months(end: Column, start: Column) -> Column:
    """Months from start to end, both counted; 0 where the start is later."""
    return F.greatest(lag_months(end, start) + 1, F.lit(0))


def populations(df: DataFrame) -> DataFrame:
    """``df`` with POPULATION, the label of segment and dual status by which models are fitted."""
    return df.withColumn("POPULATION", F.concat_ws("_", "SEGMENT", F.when(F.col("IS_DUAL") == 1, "DUAL").otherwise("NON_DUAL")))


def usable_splits(df: DataFrame, features: list[str], keys: list[str], min_rows: int = 1) -> DataFrame:
    """keys, n_rows, n_with_features and usable: whether at least ``min_rows`` rows have some feature."""
    some = F.coalesce(*[F.col(c).cast("double") for c in features]).isNotNull()
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(some).alias("n_with_features"))
    return out.withColumn("usable", F.col("n_with_features") >= min_rows)


def trailing_rate(history: DataFrame, horizon: int, months: int = 12) -> DataFrame:
    """A forecast for each split and ORIGIN: cost over exposure of the months up to the origin."""
    recent = history.where(F.col(MONTH) > F.add_months("ORIGIN", -months))
    rate = recent.groupBy(*SPLIT, "ORIGIN").agg(F.round(ratio(F.sum("PD"), F.sum("MM")), 4).alias("PREDICTED"))
    return rate.withColumn("HORIZON", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(MONTH, F.add_months("ORIGIN", F.col("HORIZON")))


def backtest(dense: DataFrame, origins: list[str], horizon: int, forecast: Callable[[DataFrame, int], DataFrame] = trailing_rate) -> DataFrame:
    """Forecasts from each origin beside the actual PMPM.

    ``forecast`` sees, for each origin, the months up to it only: one copy of the history for each of
    the few origins. It returns SPLIT, ORIGIN, HORIZON, the month and PREDICTED.
    """
    origin = F.explode(F.array(*[F.lit(o).cast("date") for o in origins]))
    history = dense.withColumn("ORIGIN", origin).where(F.col(MONTH) <= F.col("ORIGIN"))
    return forecast(history, horizon).join(dense.select(*SPLIT, MONTH, F.col("PMPM").alias("ACTUAL")), [*SPLIT, MONTH])


def pair_metrics(df: DataFrame, keys: list[str], metric: str, value: str, metrics: tuple[str, ...] = ("PMPM", "UTIL")) -> DataFrame:
    """One row for each key with a column for each metric, null where it has none."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(metric) == m, F.col(value))).alias(f"{m}_{value}") for m in metrics])


def join_factor(df: DataFrame, factors: DataFrame, metric: str, keys: list[str]) -> DataFrame:
    """``df`` with the factor of one metric, 1 where there is none."""
    own = factors.where(F.col("metric") == metric).select(*keys, "factor")
    return df.join(own, keys, "left").withColumn("factor", F.coalesce("factor", F.lit(1.0)))


def lookup_segment(df: DataFrame, dense: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the least SEGMENT that its keys have in the dense table."""
    return df.join(dense.groupBy(*keys).agg(F.min("SEGMENT").alias("SEGMENT")), keys, "left")


def combine_metrics(pmpm: DataFrame, util: DataFrame, keys: list[str]) -> DataFrame:
    return pmpm.join(util, keys, "left")


def latest_excluding(df: DataFrame, title: str, patterns: list[str], n: int, *order: Column) -> DataFrame:
    """The first ``n`` items in order whose title matches no pattern; a null title matches none."""
    out = df
    for p in patterns:
        out = out.where(~F.coalesce(F.col(title).rlike(p), F.lit(False)))
    return out.orderBy(*order).limit(n)


def latest_enabled(df: DataFrame, keys: list[str], enabled: str, n: int, *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.where(enabled).withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")
