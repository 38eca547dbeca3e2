"""The projection in one shuffle against the loop of one job a month; trees against the regression where the truth is not log-linear."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from actuspark.plans import boosting, forecast, projection, scenarios
from actuspark.plans.forecast import MONTH, SPLIT

KIND = "MARKET string, IS_DUAL int, SEGMENT string, SERVICE_CATEGORY string, HCC string, DATE_REPORT_MONTH date, MM bigint, PD double, UTIL double, PMPM double, UTIL_K double"


def month(k):
    return dt.date(1998 + k // 12, k % 12 + 1, 1)


def dense(spark, value, n_months=40, markets=("E", "W")):
    """Series of four populations; some end early, one has a gap, one is short."""
    rows, rnd = [], random.Random(2)
    for market in markets:
        for dual in (0, 1):
            for seg in ("OHC", "OC"):
                for hcc in ("F", "O"):
                    last = n_months - (2 if (dual, seg, hcc) == (0, "OC", "F") else 0)
                    first = n_months - 8 if (dual, seg, hcc, market) == (1, "OC", "O", "W") else 0
                    for k in range(first, last):
                        if k == n_months - 5 and (dual, hcc) == (1, "F"):
                            continue
                        v = value(market, dual, k, rnd)
                        rows.append((market, dual, seg, "IP", hcc, month(k), 10 + k % 3, v * 10, v, v, v * 3))
    return spark.createDataFrame(rows, KIND)


@pytest.fixture(scope="module")
def model():
    trees = [
        boosting.Tree([0, 8, 9], [1, 1, 1], [60.0, 55.0, 11.0], [-0.2, 0.1, 0.05, 0.3], [100, 60, 40, 30, 30, 10, 30]),
        boosting.Tree([10, 4, 3], [1, 1, 1], [6.0, 58.0, 61.0], [-0.1, 0.02, 0.1, 0.2], [100, 50, 50, 20, 30, 25, 25]),
        boosting.Tree([7, 6, 5], [1, 1, 1], [0.0, 0.5, 90.0], [0.05, -0.05, 0.02, -0.02], [100, 50, 50, 20, 30, 25, 25]),
    ]
    names = [("PMPM", p) for p in ("OHC_DUAL", "OHC_NON_DUAL", "OC_NON_DUAL")]
    return boosting.Boosted(["METRIC", "POPULATION"], projection.FEATURES, dict.fromkeys(names, 4.0), dict.fromkeys(names, trees))


def test_equals_the_monthly_loop(spark, model):
    history = dense(spark, lambda market, dual, k, rnd: 50 + 10 * math.sin(k) + rnd.random() * 20).where("not (IS_DUAL = 1 and SEGMENT = 'OC')")
    long = history.select(*SPLIT, MONTH, "MM", F.col("PMPM").alias("target"), F.lit("PMPM").alias("METRIC"))
    got = projection.project(long, model, 3)
    both = projection.project(long.unionByName(long.withColumn("METRIC", F.lit("UTIL_K"))), model, 21)
    assert both._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    with_model = lambda df: boosting.predict(model, scenarios.populations(df).withColumns({"month": F.month(MONTH), "METRIC": F.lit("PMPM")}))
    want = forecast.project(history, with_model, 3, lambda df: df.persist())
    key = lambda df, c: {tuple(r[k] for k in (*SPLIT, MONTH)): r[c] for r in df.collect()}
    mine, theirs = key(got, "PREDICTED"), key(want, "PMPM")
    assert mine.keys() == theirs.keys() and len(mine) == 2 * 6 * 3
    assert max(abs(mine[k] - theirs[k]) for k in mine) < 1e-6


def test_attribution_adds_up_and_unknown_models_give_null(spark, model):
    history = dense(spark, lambda market, dual, k, rnd: 50 + 30 * rnd.random(), markets=("E",))
    long = history.select(*SPLIT, MONTH, "MM", F.col("PMPM").alias("target"), F.lit("PMPM").alias("METRIC"))
    rows = projection.project(long, model, 21, attribute=True).collect()
    assert len(rows) == 8 * 21 and {r["HORIZON"] for r in rows} == set(range(1, 22))
    for r in rows:
        if (r["SEGMENT"], r["IS_DUAL"]) == ("OC", 1):
            assert r["PREDICTED"] is None or math.isnan(r["PREDICTED"])
        else:
            assert abs(math.exp(r["BASE"] + sum(r["contributions"])) - r["PREDICTED"]) < 1e-9


def test_trees_beat_the_regression_where_levels_jump(spark):
    """The rate depends on the calendar month, which the regression's lags see only late."""
    history = dense(spark, lambda market, dual, k, rnd: (90.0 if k % 12 in (0, 1, 5) else 30.0) * (1 + dual) + rnd.random() * 4, n_months=60, markets=("E", "W", "N"))
    origins = [str(month(k)) for k in (52, 53)]
    scored = projection.backtest(history, origins, 6, params=boosting.Params(rounds=20, depth=3, rate=0.3, least=5, chunk=5))
    error = {r["METHOD"]: r["rmse"] for r in forecast.holdout_metrics(scored, ["METHOD"], "PREDICTED", "ACTUAL").collect()}
    assert error["trees"] < 0.8 * error["regression"]
    assert scored.where("HORIZON > 6 or DATE_REPORT_MONTH <= ORIGIN").isEmpty()


def test_train_and_project_has_all_metrics_and_units(spark):
    history = dense(spark, lambda market, dual, k, rnd: 40 + 20 * (k % 12 > 5) + rnd.random(), n_months=40, markets=("E",))
    out = projection.train_and_project(history, str(month(39)), 4, params=boosting.Params(rounds=4, depth=2, chunk=2, least=5)).collect()
    assert len(out) == 2 * 8 * 4 and {r["METRIC"] for r in out} == {"PMPM", "UTIL_K"}
    for r in out:
        units = [r[f"{f}_units"] for f in projection.FEATURES]
        assert all(u is None for u in units) or abs(sum(units) - (r["PREDICTED"] - math.exp(r["BASE"]))) < 1e-6
    assert np.isfinite([r["PREDICTED"] for r in out]).all()
