"""Window features over series: every rolling feature looks at rows before the current one only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

LAGS = (1, 2, 3, 12)


def series(keys: list[str], order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def lags(c: str, w: WindowSpec, ns: tuple[int, ...] = LAGS) -> dict[str, Column]:
    return {f"{c}_lag{n}": F.lag(c, n).over(w) for n in ns}


def _past(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-n, -1)


def _enough(c: str, w: WindowSpec, n: int, least: int, value: Column) -> Column:
    return F.when(F.count(c).over(_past(w, n)) >= least, value)


def roll_mean(c: str, w: WindowSpec, n: int = 12, least: int = 3) -> Column:
    return _enough(c, w, n, least, F.avg(c).over(_past(w, n)))


def roll_var(c: str, w: WindowSpec, n: int = 12, least: int = 3) -> Column:
    return _enough(c, w, n, least, F.var_samp(c).over(_past(w, n)))


def roll_zeros(c: str, w: WindowSpec, n: int = 12, least: int = 3) -> Column:
    return _enough(c, w, n, least, F.sum(F.when(F.abs(F.col(c)) < 1e-9, 1).otherwise(0)).over(_past(w, n)))


def roll_slope(c: str, position: str, w: WindowSpec, n: int = 12, least: int = 3) -> Column:
    """Least-squares slope of ``c`` on the row's position in its series."""
    return _enough(c, w, n, least, F.regr_slope(F.col(c), F.col(position)).over(_past(w, n)))


def ffill(c: str, w: WindowSpec) -> Column:
    return F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def rolling_quarter(c: str, w: WindowSpec) -> Column:
    """Sum of this row and the two before; null until three rows are there."""
    past = w.rowsBetween(-2, 0)
    return F.when(F.count(c).over(past) == 3, F.sum(c).over(past))


def change_vs_prior(c: str, w: WindowSpec) -> dict[str, Column]:
    before = F.lag(c).over(w)
    return {f"{c}_change": F.col(c) - before, f"{c}_change_pct": F.try_divide(F.col(c) - before, F.nullif(before, F.lit(0)))}


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def top_n(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of each group with their rank; the order has to be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def group_stat(df: DataFrame, keys: list[str], c: str, fn, name: str) -> DataFrame:
    """A group's statistic on each of its rows: aggregated first and joined back, so that few large groups do not meet in one task."""
    return df.join(df.groupBy(*keys).agg(fn(c).alias(name)), keys, "left")
