"""The monthly cost table: extraction, densifying, features, training and projection, final output."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import windows as W
from ..functions.derive import MONEY, collapse_category, first_positive, floor_zero, is_dual, pmpm, quarter_label, rate_per_k, ratio, snap_zero, unit_cost, yyyymm_to_date
from ..operators import checks, frames
from ..sources import scratch
from ..sources.versions import VersionedTable, state_of

ENROL = ["MARKET", "IS_DUAL", "SEGMENT"]
SPLIT = [*ENROL, "SERVICE_CATEGORY", "HCC"]
MONTH = "DATE_REPORT_MONTH"


def derive_val_date(raw: DataFrame) -> DataFrame:
    """One row: the latest claim month, enrolment rows aside."""
    return raw.where("MAJ_SRV_CAT <> 'MBR'").agg(F.max(yyyymm_to_date(F.col("YR_MO"))).alias("VAL_DATE"))


def extract_snapshot(raw: DataFrame) -> DataFrame:
    """The source stamped with its valuation date."""
    return raw.join(F.broadcast(derive_val_date(raw)))


def coverage(snapshot: DataFrame) -> DataFrame:
    keys = ["VAL_DATE", "ENTY", "MAJ_SRV_CAT"]
    return snapshot.groupBy(*keys).agg(F.min("YR_MO").alias("first_month"), F.max("YR_MO").alias("last_month"), F.count_distinct("YR_MO").alias("n_months"), F.count(F.lit(1)).alias("n_rows"))


def _vocabulary(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("ENTY", "MARKET").withColumns({"IS_DUAL": is_dual(F.col("PLAN_TYPE")), MONTH: yyyymm_to_date(F.col("YR_MO"))})


def exposure(raw: DataFrame) -> DataFrame:
    return _vocabulary(raw.where("MAJ_SRV_CAT = 'MBR'")).groupBy(*ENROL, MONTH).agg(F.sum("MBR_COUNT").alias("MM")).where("MM > 0")


def claims(raw: DataFrame, units: tuple[str, ...]) -> DataFrame:
    rows = _vocabulary(raw.where("MAJ_SRV_CAT <> 'MBR'")).withColumn("SERVICE_CATEGORY", collapse_category(F.col("MAJ_SRV_CAT"))).withColumnRenamed("HCE_SRVC_CAT", "HCC")
    return rows.groupBy(*SPLIT, MONTH).agg(F.sum("NET_AMT_COMP").cast(MONEY).alias("PD"), F.sum(F.coalesce(first_positive(*[F.col(u) for u in units]), F.lit(0).cast(MONEY))).cast(MONEY).alias("UTIL"))


def completed_combined(raw: DataFrame, units: tuple[str, ...]) -> DataFrame:
    """Dense monthly rows of each observed split with exposure: MM, UTIL, PD, UTIL_K, PMPM."""
    return completed(claims(raw, units), exposure(raw))


def completed(facts: DataFrame, exposed: DataFrame) -> DataFrame:
    """``completed_combined`` of monthly claims and exposure. The claims are read three times, so they should be stored ones."""
    dense = frames.densify(facts, exposed, SPLIT, ENROL, MONTH, ["PD", "UTIL"])
    return dense.withColumns({"UTIL_K": rate_per_k(F.col("UTIL"), F.col("MM")), "PMPM": pmpm(F.col("PD"), F.col("MM")), "DATE_REPORT_QTR": quarter_label(F.col(MONTH))})


def control_totals(raw: DataFrame, dense: DataFrame, units: tuple[str, ...]) -> DataFrame:
    """Source, orphan and output totals; output and orphans make up the source.

    Member months of the months that have claims must tie (hard); paid and units are reported (soft).
    """
    facts, exp = claims(raw, units), exposure(raw)
    gone = frames.orphans(facts, exp, [*ENROL, MONTH])
    total = lambda df, n: df.agg(F.coalesce(F.sum("PD"), F.lit(0)).alias(f"pd_{n}"), F.coalesce(F.sum("UTIL"), F.lit(0)).alias(f"util_{n}"))
    one = total(facts, "source").join(total(gone, "orphan")).join(total(dense, "output"))
    one = one.withColumns({"pd_kept": F.col("pd_source") - F.col("pd_orphan"), "util_kept": F.col("util_source") - F.col("util_orphan")})
    bounds = facts.agg(F.min(MONTH).alias("_first"), F.max(MONTH).alias("_last"))
    seen = frames.reachable(exp.join(F.broadcast(bounds)).where(F.col(MONTH).between(F.col("_first"), F.col("_last"))), dense.select(*ENROL).distinct(), ENROL).agg(F.sum("MM").alias("mm_source"))
    once = frames.dedup_sum(dense, [*ENROL, MONTH], [], "MM").withColumnRenamed("MM", "mm_output")
    one = one.join(seen).join(once)
    return checks.control_table(one, [("paid", "pd_kept", "pd_output", False), ("units", "util_kept", "util_output", False), ("paid with orphans", "pd_source", "pd_output", False), ("member months", "mm_source", "mm_output", True)])


def signals(dense: DataFrame, metric: str = "PMPM") -> DataFrame:
    """Leakage-safe features of each series: lags, past mean, variance, zeros and slope, and a target encoding of its market and category."""
    w = W.series(SPLIT, MONTH)
    rows = dense.select(*SPLIT, MONTH, "MM", snap_zero(F.col(metric)).alias("target"))
    by = ["MARKET", "SERVICE_CATEGORY", MONTH]
    rows = W.group_stat(rows, by, "target", F.avg, "_section").withColumn("position", F.row_number().over(w))
    out = rows.select(
        *SPLIT,
        MONTH,
        "target",
        "position",
        *[c.alias(n) for n, c in W.lags("target", w).items()],
        W.roll_mean("target", w).alias("mean_12"),
        W.roll_var("target", w).alias("var_12"),
        W.roll_zeros("target", w).alias("zeros_12"),
        W.roll_slope("target", "position", w).alias("slope_12"),
        W.roll_mean("_section", w).alias("encoding_12"),
    )
    return out


def holdout(df: DataFrame, train_end: str, months: int) -> tuple[DataFrame, DataFrame]:
    edge = F.add_months(F.lit(train_end).cast("date"), -months)
    return df.where(F.col(MONTH) <= edge), df.where((F.col(MONTH) > edge) & (F.col(MONTH) <= F.lit(train_end).cast("date")))


#: Targets are fitted in ten thousands, where the weights of the fit neither vanish nor overflow.
SCALE = 1e-4
FEATURES = ("target_lag1", "target_lag12", "mean_12", "slope_12")


def fit(train: DataFrame, features: tuple[str, ...] = FEATURES, power: float = 1.5):
    """A Tweedie regression with a log link; a negative target counts as 0; rows without a full history are left out of the fit."""
    rows = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip").transform(train.withColumn("target", floor_zero(F.col("target"))).where("target is not null").fillna(0.0, ["slope_12"]))
    glm = GeneralizedLinearRegression(family="tweedie", variancePower=power, linkPower=0.0, maxIter=15, regParam=0.01, featuresCol="features", labelCol="target", predictionCol="prediction")
    return glm.fit(rows.withColumn("target", F.col("target") * SCALE))


def predict(model, df: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """``df`` (features as ``signals`` makes them) with its prediction; a history that is too short counts as 0."""
    rows = VectorAssembler(inputCols=list(features), outputCol="features").transform(scaled(df, features).fillna(0.0, list(features)))
    return model.transform(rows).withColumn("prediction", F.col("prediction") / SCALE)


def scaled(df: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Features as logs of one plus the value where they are amounts, so that the log link fits them."""
    return df.withColumns({c: F.log1p(F.greatest(F.col(c), F.lit(0.0))) for c in features if c != "slope_12"} | {"slope_12": F.try_divide(F.col("slope_12"), F.col("mean_12") + 1)})


def project(history: DataFrame, predict: Callable[[DataFrame], DataFrame], months: int, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Append month after month: features from the trailing 13 rows, the prediction becomes the next row's history."""
    w = Window.partitionBy(*SPLIT).orderBy(F.desc(MONTH))
    state = cut(history.select(*SPLIT, MONTH, "MM", "PMPM").withColumn("_r", F.row_number().over(w)).where("_r <= 13").drop("_r"))
    out = None
    for _ in range(months):
        last = state.withColumn("_r", F.row_number().over(w)).where("_r = 1")
        nxt = last.select(*SPLIT, F.add_months(MONTH, 1).alias(MONTH), "MM", F.lit(None).cast("double").alias("PMPM"))
        made = signals(state.unionByName(nxt)).join(nxt.select(*SPLIT, MONTH, "MM"), [*SPLIT, MONTH])
        new = cut(predict(made).select(*SPLIT, MONTH, "MM", F.col("prediction").alias("PMPM")))
        out = new if out is None else out.unionByName(new)
        state = cut(state.unionByName(new).withColumn("_r", F.row_number().over(w)).where("_r <= 13").drop("_r"))
    return out


def attribute(df: DataFrame, coefficients: list[float], means: list[float], features: str = "features") -> DataFrame:
    """Exact linear contributions in log space, each coefficient times the feature's distance from its mean."""
    arr = vector_to_array(F.col(features))
    parts = F.zip_with(F.zip_with(arr, F.array(*[F.lit(m) for m in means]), lambda x, m: x - m), F.array(*[F.lit(c) for c in coefficients]), lambda d, c: d * c)
    return df.withColumn("contributions", parts)


def rescale_attribution(df: DataFrame, cols: list[str], pred: str, base: str) -> DataFrame:
    """Contributions in units of the target: shares of their sum times (prediction - exp(base)); null where the sum is about 0."""
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    gain = F.col(pred) - F.exp(base)
    return df.withColumns({f"{c}_units": F.when(F.abs(total) >= 1e-10, F.col(c) / total * gain) for c in cols})


def final_output(forecast: DataFrame, dense: DataFrame) -> DataFrame:
    """Forecast rows with actuals where there are any, and the last known exposure carried forward."""
    actual = dense.select(*SPLIT, MONTH, "MM", "PD", "UTIL", F.col("PMPM").alias("ACTUAL_PMPM"))
    last = W.latest(dense.select(*SPLIT, MONTH, "MM"), SPLIT, F.desc(MONTH)).select(*SPLIT, F.col("MM").alias("LAST_MM"))
    out = forecast.select(*SPLIT, MONTH, "PREDICTED_PMPM").join(actual, [*SPLIT, MONTH], "left").join(last, SPLIT, "left")
    return out.withColumns(
        {
            "CARRIED": F.col("MM").isNull(),
            "MM": F.coalesce("MM", "LAST_MM"),
            "UNIT_COST": unit_cost(F.col("PD"), F.col("UTIL")),
            "ERROR": F.col("PREDICTED_PMPM") - F.col("ACTUAL_PMPM"),
        }
    ).drop("LAST_MM")


def holdout_metrics(scored: DataFrame, keys: list[str], pred: str, actual: str) -> DataFrame:
    e = F.col(pred) - F.col(actual)
    return scored.where(e.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"))


def intervals(scored: DataFrame, keys: list[str], pred: str, actual: str, lo: float = 0.1, hi: float = 0.9) -> DataFrame:
    """Empirical residual percentiles."""
    e = F.col(actual) - F.col(pred)
    return scored.where(e.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.percentile(e, F.lit(lo)).alias("low"), F.percentile(e, F.lit(hi)).alias("high"))


def reconcile_paths(df: DataFrame, a: str, b: str) -> DataFrame:
    d = F.abs(ratio(F.col(a) - F.col(b), F.col(a)))
    return df.agg(F.count(d).alias("n"), F.round(F.avg(d), 6).alias("mean_abs_pct"))


def stored(spark: SparkSession, name: str, sources: list[str], build: Callable[[], DataFrame], by: str = "VAL_DATE") -> DataFrame:
    """The table ``name``, which later steps read instead of building it anew; its slices are the values of ``by``.

    The table is kept in the shared folder under the state of its ``sources`` (paths) and of this code: changed
    ones make another table.
    """
    state = hashlib.sha256(repr((scratch.code_state(), state_of(spark, sources))).encode()).hexdigest()[:32]
    table = VersionedTable(spark, f"{scratch.folder(spark)}/{name}-{state}", by)
    if not table.slices():
        table.replace(build())
    return table.read() if table.slices() else build()


def latest_slice(df: DataFrame) -> DataFrame:
    """The rows of the last valuation date: its one-row aggregate prunes the other slices as the plan runs."""
    last = df.agg(F.max("VAL_DATE").alias("_last"))
    return df.join(F.broadcast(last), F.col("VAL_DATE") == F.col("_last")).drop("VAL_DATE", "_last")


def stamped_monthly(facts: DataFrame, exposed: DataFrame) -> DataFrame:
    """The monthly table of monthly claims and exposure with its valuation date, the latest claim month."""
    return completed(facts, exposed).join(F.broadcast(facts.agg(F.max(MONTH).alias("VAL_DATE"))))


def source_advanced(new: DataFrame, stored: DataFrame, c: str = "VAL_DATE") -> DataFrame:
    return new.agg(F.max(c).alias("new_max")).join(stored.agg(F.max(c).alias("stored_max"))).withColumn("advanced", F.coalesce(F.col("new_max") > F.col("stored_max"), F.col("new_max").isNotNull()))


def require_advanced(new: DataFrame, stored: DataFrame, c: str = "VAL_DATE") -> DataFrame:
    """``new`` itself; raises unless it is newer than what is stored."""
    seen = source_advanced(new, stored, c).first()
    if not seen["advanced"]:
        raise checks.CheckFailed(f"the source is at {seen['new_max']}, and {seen['stored_max']} is stored already")
    return new
