"""Data-quality gates: each returns a table or raises ``CheckFailed``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    pass


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise CheckFailed(what)


def control_table(totals: DataFrame, metrics: list[tuple[str, str, str, bool]]) -> DataFrame:
    """From a one-row frame: metric, expected, actual, diff, pct, hard for (metric, expected column, actual column, hard)."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(a).cast("double").alias("expected"), F.col(b).cast("double").alias("actual"), F.lit(h).alias("hard")) for m, a, b, h in metrics])
    out = totals.select(F.explode(rows).alias("r")).select("r.*")
    diff = F.col("actual") - F.col("expected")
    return out.withColumns({"diff": F.round(diff, 4), "pct": F.round(F.try_divide(diff, F.nullif("expected", F.lit(0.0))), 6)})


def assert_no_inflation(source: float, out: float, eps: float = 0.01) -> None:
    _need(out <= source + eps, f"{out} is above its source {source}")


def assert_tie(source: float, out: float, tol: float = 0.001) -> None:
    _need(abs(out - source) <= tol * abs(source), f"{out} does not tie to {source}")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    _need(repeated_keys(df, keys).isEmpty(), f"rows repeat on {keys}")


def assert_rows(df: DataFrame) -> None:
    _need(not df.isEmpty(), "no rows")


def gate_output(df: DataFrame, forecast: str, actual: str) -> DataFrame:
    c = lambda x: F.count_if(x)
    f, a = F.col(forecast).isNotNull(), F.col(actual).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("total"), c(a).alias("with_actuals"), c(f & ~a).alias("forecast_only"), c(~f).alias("missing_forecast"))


def assert_positive(df: DataFrame, c: str) -> None:
    _need(df.where(F.col(c) <= 0).isEmpty(), f"{c} is not positive everywhere")


def check_relativities(rel: DataFrame, c: str = "relativity") -> DataFrame:
    return rel.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(c), 6).alias("mean"))


def assert_calendar(cal: DataFrame, day: str, start: str, end: str) -> None:
    n = cal.where(F.col(day).between(start, end)).agg(F.count_distinct(day).alias("n"), F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")).alias("d")).first()
    _need(n["d"] is None or n["n"] == n["d"] + 1, f"the calendar misses days from {start} to {end}")


def inert(df: DataFrame, c: str) -> DataFrame:
    """Whether all factors are 1."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(c) != 1).alias("n_active"), (F.count_if(F.col(c) != 1) == 0).alias("inert"))


def density(df: DataFrame, split: list[str], coarse: list[str], zero: Column) -> DataFrame:
    """Share of zero months of each split, then its spread over coarser groups."""
    fine = df.groupBy(*split).agg(F.count(F.lit(1)).alias("months"), F.count_if(zero).alias("zeros"))
    fine = fine.withColumn("share", F.col("zeros").cast("double") / F.col("months"))
    return fine.groupBy(*coarse).agg(F.count(F.lit(1)).alias("n_splits"), F.sum("months").alias("months"), F.sum("zeros").alias("zeros"), F.round(F.min("share"), 6).alias("least"), F.round(F.max("share"), 6).alias("most"))
