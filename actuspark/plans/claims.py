"""Monthly claims close: completion, dashboard, restatement across closes, chain ladder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import MONEY, cap_lag, lag_months, ratio, reportable_month, segment_label
from ..functions.windows import top_n

SEGMENT = ["plan_type", "claim_type"]


def chain_ladder(claims: DataFrame) -> DataFrame:
    """Volume-weighted link ratios from each lag to the next over adjacent closes, and the factor from there to ultimate."""
    rows = claims.withColumn("lag", lag_months(F.col("close"), F.col("incurred")))
    w = Window.partitionBy("incurred", *SEGMENT).orderBy("close")
    pairs = rows.withColumns({"before": F.lag("paid").over(w), "from_lag": F.lag("lag").over(w)}).where("lag = from_lag + 1")
    links = pairs.groupBy(*SEGMENT, "from_lag").agg(F.sum("before").alias("paid_before"), F.sum("paid").alias("paid_after"))
    links = links.withColumn("link", F.round(ratio(F.col("paid_after"), F.col("paid_before")), 6))
    tail = Window.partitionBy(*SEGMENT).orderBy(F.desc("from_lag")).rowsBetween(Window.unboundedPreceding, 0)
    return links.withColumn("to_ultimate", F.round(F.product("link").over(tail), 4))


def completion_factors(ladder: DataFrame, most: int = 23) -> DataFrame:
    """plan_type, claim_type, lag (0 to ``most``) and the completed share; lags without a ratio are complete."""
    lags = ladder.select(*SEGMENT).distinct().withColumn("lag", F.explode(F.sequence(F.lit(0), F.lit(most))))
    known = ladder.select(*SEGMENT, F.col("from_lag").alias("lag"), "to_ultimate")
    return lags.join(known, [*SEGMENT, "lag"], "left").select(*SEGMENT, "lag", F.round(F.coalesce(1 / F.col("to_ultimate"), F.lit(1.0)), 6).alias("factor"))


def complete_claims(claims: DataFrame, factors: DataFrame, close: str, most: int = 23) -> DataFrame:
    """Ultimate = paid / factor of the row's plan, claim type and capped lag; a missing factor is flagged."""
    rows = claims.where(F.col("close") == F.lit(close).cast("date")).withColumn("lag", cap_lag(lag_months(F.col("close"), F.col("incurred")), most))
    out = rows.join(F.broadcast(factors), [*SEGMENT, "lag"], "left")
    return out.select("incurred", *SEGMENT, "lag", "paid", "factor", F.round(ratio(F.col("paid"), F.col("factor")), 2).alias("ultimate"), F.col("factor").isNull().alias("factor_missing"))


def pmpm_dashboard(completed: DataFrame, members: DataFrame, close: str) -> DataFrame:
    """By month: ultimate, members, PMPM, its change on a month and a year before; by year a simple average of reportable months."""
    edge = reportable_month(F.lit(close).cast("date"))
    cost = completed.groupBy("incurred").agg(F.sum(F.col("ultimate").cast(MONEY)).alias("ultimate"))
    mm = members.where(F.col("close") == F.lit(close).cast("date")).groupBy("incurred").agg(F.sum("member_months").alias("member_months"))
    rows = cost.join(mm, "incurred").where(F.col("incurred") <= edge).withColumn("pmpm", F.round(ratio(F.col("ultimate"), F.col("member_months")), 4))
    w = Window.orderBy("incurred")
    year = Window.partitionBy(F.year("incurred"))
    # A row for each month of history: one small partition.
    return rows.select(
        "incurred",
        F.quarter("incurred").alias("quarter"),
        "member_months",
        "pmpm",
        F.round(F.col("pmpm") - F.lag("pmpm").over(w), 4).alias("month_change"),
        F.round(F.try_divide(F.col("pmpm"), F.lag("pmpm", 12).over(w)) - 1, 6).alias("year_trend"),
        F.round(F.avg(F.col("pmpm").cast("decimal(18,4)")).over(year).cast("double"), 4).alias("year_average"),
    )


def restatement_grid(claims: DataFrame, members: DataFrame, min_lag: int = 2) -> DataFrame:
    """PMPM of each incurred month at each close with lag at least ``min_lag``, its change on the close before, and a 5 % flag."""
    cost = claims.groupBy("close", "incurred").agg(F.sum("paid").alias("paid"))
    mm = members.groupBy("close", "incurred").agg(F.sum("member_months").alias("member_months"))
    rows = cost.join(mm, ["close", "incurred"]).withColumn("lag", lag_months(F.col("close"), F.col("incurred"))).where(F.col("lag") >= min_lag)
    return _changes(rows.withColumn("pmpm", F.round(ratio(F.col("paid"), F.col("member_months")), 4)), ["incurred"], "pmpm")


def restatement_by_segment(claims: DataFrame, min_lag: int = 2) -> DataFrame:
    rows = claims.withColumn("lag", lag_months(F.col("close"), F.col("incurred"))).where(F.col("lag") >= min_lag)
    rows = rows.withColumns({"segment": segment_label(F.col("plan_type"), F.col("claim_type")), "paid": F.col("paid").cast("double")})
    return _changes(rows.select("close", "incurred", "segment", "lag", "paid"), ["incurred", "segment"], "paid")


def _changes(rows: DataFrame, keys: list[str], c: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("close")
    before = F.lag(c).over(w)
    out = rows.withColumns({"change": F.round(F.col(c) - before, 4), "change_pct": F.round(F.try_divide(F.col(c) - before, F.nullif(before, F.lit(0.0))), 6)})
    first = F.min("lag").over(Window.partitionBy(*keys))
    return out.withColumns({"first_report_lag": first, "flagged": F.coalesce(F.abs("change_pct") > 0.05, F.lit(False))})


def pivot_reports(grid: DataFrame, keys: list[str], closes: tuple[str, ...], c: str) -> DataFrame:
    return grid.withColumn("report", F.date_format("close", "yyyyMM")).groupBy(*keys).pivot("report", [d[:4] + d[5:7] for d in closes]).agg(F.first(c))


def top_movers(grid: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The largest changes in per cent of each close."""
    return top_n(grid.where("change_pct is not null"), ["close"], n, F.desc(F.abs("change_pct")), *[F.asc(k) for k in keys])


def segment_change(by_segment: DataFrame) -> DataFrame:
    """Change of each segment between closes, over rows that both closes hold."""
    rows = by_segment.where("change is not null")
    return rows.groupBy("close", "segment").agg(F.count(F.lit(1)).alias("n_months"), F.round(F.sum(F.col("change").cast(MONEY)).cast("double"), 2).alias("change"))


def year_month_cube(claims: DataFrame, close: str) -> DataFrame:
    rows = claims.where(F.col("close") == F.lit(close).cast("date")).select(F.year("incurred").alias("year"), F.month("incurred").alias("month"), "paid")
    return rows.cube("year", "month").agg(F.sum("paid").cast("double").alias("paid"))


def pivot_year_month(df: DataFrame, measure: str, month: str = "incurred") -> DataFrame:
    """A row for each year with the columns 1 to 12, 0 where there is nothing."""
    rows = df.select(F.year(month).alias("year"), F.month(month).alias("_month"), measure)
    return rows.groupBy("year").pivot("_month", list(range(1, 13))).agg(F.sum(measure)).fillna(0)


def period_averages(dashboard: DataFrame, close: str) -> DataFrame:
    """year, period (Q1 to Q4, YTD, FY), n_months and the simple average of the monthly PMPM.

    Quarters and the year to date take the months up to the reportable month's in every year, so years compare;
    the full year needs its twelve months.
    """
    edge = reportable_month(F.lit(close).cast("date"))
    within = F.month("incurred") <= F.month(edge)
    periods = F.array_compact(F.array(F.when(within, F.concat(F.lit("Q"), F.quarter("incurred"))), F.when(within, "YTD"), F.lit("FY")))
    rows = dashboard.select(F.year("incurred").alias("year"), F.explode(periods).alias("period"), F.col("pmpm").cast("decimal(18,4)").alias("pmpm"))
    out = rows.groupBy("year", "period").agg(F.count(F.lit(1)).alias("n_months"), F.round((F.sum("pmpm").cast("double") / F.count("pmpm")), 4).alias("average"))
    return out.where("period <> 'FY' or n_months = 12")


def verdicts(changes: DataFrame) -> DataFrame:
    """For each close and dimension (claim_type: IP or Non-IP; plan_type: HMO or PPO): both movements and which is the bigger mover.

    ``changes``: close, segment (plan / claim) and change. The first side wins only if it is larger in size.
    """
    plan, claim = F.split("segment", " / ")[0], F.split("segment", " / ")[1]
    total = lambda cond: F.round(F.sum(F.when(cond, F.col("change").cast(MONEY)).otherwise(0)).cast("double"), 2)
    sums = changes.groupBy("close").agg(total(claim == "IP").alias("a1"), total(claim == "Non-IP").alias("b1"), total(plan == "HMO").alias("a2"), total(plan == "PPO").alias("b2"))
    rows = F.array(*[F.struct(F.lit(d).alias("dimension"), F.lit(x).alias("first"), F.lit(y).alias("second"), F.col(f"a{k}").alias("first_change"), F.col(f"b{k}").alias("second_change")) for k, d, x, y in ((1, "claim_type", "IP", "Non-IP"), (2, "plan_type", "HMO", "PPO"))])
    return sums.select("close", F.inline(rows)).withColumn("bigger", F.when(F.abs("first_change") > F.abs("second_change"), F.col("first")).otherwise(F.col("second")))
