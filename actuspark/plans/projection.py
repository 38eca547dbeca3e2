"""Fitted forecasts: training rows by metric and population, projection of many months in one shuffle, attribution.

A projected month feeds the features of the next one, and the target encoding ties the series of a market and
category together. So all series of a section (market and category; a few hundred at most, by the grain of
the table) meet in one task with their last 13 rows, and are advanced month by month as arrays:
lags, rolling figures and the section's mean of each month are brought forward, the model predicts, the
prediction becomes a row. Nothing goes through the driver, and the number of months adds no job.
"""

from __future__ import annotations

from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import derive
from ..sources import scratch
from . import boosting, forecast, scenarios
from .forecast import ENROL, MONTH, SPLIT

#: What a row is predicted from; the month and the exposure are known ahead.
FEATURES = ["target_lag1", "target_lag2", "target_lag3", "target_lag12", "mean_12", "var_12", "zeros_12", "slope_12", "encoding_12", "MM", "month"]
SECTION = ["MARKET", "SERVICE_CATEGORY"]
#: The columns of the monthly table that are forecast.
METRICS = ("PMPM", "UTIL_K")
#: Rows of history that the features of the next row look at.
STATE = 13


class Model(Protocol):
    keys: list[str]

    def predict(self, name: tuple, x: np.ndarray) -> np.ndarray: ...


def features(dense: DataFrame, metric: str) -> DataFrame:
    """The signals of one metric with exposure, month and population."""
    rows = forecast.signals(dense, metric).join(dense.select(*SPLIT, MONTH, "MM"), [*SPLIT, MONTH])
    return scenarios.populations(rows).withColumns({"month": F.month(MONTH), "METRIC": F.lit(metric)})


def training_rows(dense: DataFrame, metric: str, burn_in: int = 12) -> DataFrame:
    """The features of months from the training start of each enrolment group on."""
    start = scenarios.train_start(dense, ENROL, burn_in)
    return features(dense, metric).join(start, ENROL).where(F.col(MONTH) >= F.col("TRAIN_START")).drop("TRAIN_START")


def project(history: DataFrame, model: Model, months: int, over: tuple[str, ...] = ("METRIC",), attribute: bool = False) -> DataFrame:
    """``over``, SPLIT, month, HORIZON, MM (the last known) and PREDICTED for the ``months`` after each series' last row.

    ``history`` has ``over``, SPLIT, the month, MM and target. With ``attribute`` (boosted trees only) BASE and
    contributions (an array in the order of FEATURES) of the log score are added.
    """
    scratch.ship(history.sparkSession)
    by = [*over, *SECTION]
    rows = scenarios.populations(history.select(*dict.fromkeys([*over, *SPLIT]), MONTH, "MM", derive.snap_zero(F.col("target")).cast("double").alias("target")))
    w = Window.partitionBy(*over, *SPLIT).orderBy(F.desc(MONTH))
    rows = rows.repartition(*by).withColumn("back", F.row_number().over(w)).where(F.col("back") <= STATE)
    named = [rows.schema[c] for c in dict.fromkeys([*over, *SPLIT, "POPULATION"])]
    out = StructType([*named, rows.schema[MONTH], *StructType.fromDDL("HORIZON int, MM double, PREDICTED double").fields, *(StructType.fromDDL("BASE double, contributions array<double>").fields if attribute else [])])
    names = [f.name for f in named]

    def run(own: pd.DataFrame) -> pd.DataFrame:
        return _advance(own, names, model, months, attribute)

    return rows.groupBy(*by).applyInPandas(run, out)


def _advance(own: pd.DataFrame, names: list[str], model: Model, months: int, attribute: bool) -> pd.DataFrame:
    """The rows ahead of all series of one section."""
    series = own[names].drop_duplicates().reset_index(drop=True)
    which = pd.MultiIndex.from_frame(series).get_indexer(pd.MultiIndex.from_frame(own[names]))
    n, place = len(series), STATE - own["back"].to_numpy()
    when = pd.to_datetime(own[MONTH])
    values, at = np.full((n, STATE), np.nan), np.full((n, STATE), -1)
    values[which, place] = own["target"].to_numpy(float, na_value=np.nan)
    at[which, place] = when.dt.year.to_numpy() * 12 + when.dt.month.to_numpy() - 1
    exposure = np.zeros(n)
    exposure[which[place == STATE - 1]] = own["MM"].to_numpy(float)[place == STATE - 1]
    models = {}
    for k, name in enumerate(series[model.keys].itertuples(index=False, name=None)):
        models.setdefault(name, []).append(k)
    done, seen = [], []
    for step in range(months):
        month = at[:, -1] + 1
        x = _features(values, at, exposure, month)
        new, frame = np.full(n, np.nan), series.copy()
        for name, rows in models.items():
            new[rows] = model.predict(name, x[rows])
        frame[MONTH] = [pd.Timestamp(m // 12, m % 12 + 1, 1).date() for m in month.tolist()]
        frame["HORIZON"], frame["MM"], frame["PREDICTED"] = step + 1, exposure, new
        done.append(frame)
        seen.append(x)
        new = np.where(np.abs(new) < 1e-9, 0.0, new)
        values, at = np.column_stack((values[:, 1:], new)), np.column_stack((at[:, 1:], month))
    out = pd.concat(done, ignore_index=True)
    if attribute:
        x, bases, parts = np.concatenate(seen), np.full(len(out), np.nan), np.full((len(out), len(FEATURES)), np.nan)
        for name, rows in models.items():
            if name in model.start:
                every = (np.arange(months)[:, None] * n + np.array(rows)).ravel()
                bases[every], parts[every] = model.base(name), model.contributions(name, x[every])
        out["BASE"], out["contributions"] = bases, list(parts)
    return out


def _features(values: np.ndarray, at: np.ndarray, exposure: np.ndarray, month: np.ndarray) -> np.ndarray:
    """FEATURES of the row after the last one; each rolling figure needs three values."""
    seen = ~np.isnan(values)
    months, of = np.unique(at[seen], return_inverse=True)
    means = np.bincount(of, values[seen], len(months)) / np.maximum(np.bincount(of, minlength=len(months)), 1)
    spot = np.minimum(np.searchsorted(months, at), max(len(months) - 1, 0))
    section = np.where((at >= 0) & (months[spot] == at), means[spot], np.nan) if len(months) else np.full(at.shape, np.nan)
    past, there = values[:, 1:], seen[:, 1:]
    count, enough = there.sum(axis=1), there.sum(axis=1) >= 3
    filled, x = np.where(there, past, 0.0), np.arange(STATE - 1.0)
    size = np.maximum(count, 1)
    mean, middle = filled.sum(axis=1) / size, (there * x).sum(axis=1) / size
    gap = np.where(there, past - mean[:, None], 0.0)
    way = np.where(there, x - middle[:, None], 0.0)
    spread = (way * way).sum(axis=1)
    slope = (way * gap).sum(axis=1) / np.where(spread > 0, spread, np.nan)
    encoded = ~np.isnan(section[:, 1:])
    encoding = np.where(encoded.sum(axis=1) >= 3, np.where(encoded, section[:, 1:], 0.0).sum(axis=1) / np.maximum(encoded.sum(axis=1), 1), np.nan)
    rolled = [mean, (gap * gap).sum(axis=1) / np.maximum(count - 1, 1), ((np.abs(past) < 1e-9) & there).sum(axis=1).astype(float), slope]
    return np.column_stack([values[:, -1], values[:, -2], values[:, -3], values[:, 1], *[np.where(enough, r, np.nan) for r in rolled], encoding, exposure, month % 12 + 1.0])


class Regression:
    """A Tweedie regression of ``forecast.fit`` for each origin, as numbers."""

    def __init__(self, keys: list[str], fitted: dict[tuple, tuple[float, list[float]]]):
        self.keys, self.fitted = keys, fitted

    def predict(self, name: tuple, x: np.ndarray) -> np.ndarray:
        start, weights = self.fitted[name]
        raw = {f: x[:, FEATURES.index(f)] for f in forecast.FEATURES}
        scaled = [raw[f] / (raw["mean_12"] + 1) if f == "slope_12" else np.log1p(np.maximum(raw[f], 0.0)) for f in forecast.FEATURES]
        return np.exp(start + np.nan_to_num(np.column_stack(scaled)) @ np.array(weights)) / forecast.SCALE


def train_and_project(dense: DataFrame, train_end: str, months: int = 21, holdout_months: int = 3, params: boosting.Params = boosting.Params(), metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """For each metric: a model of each population with a holdout by date, and ``months`` rows ahead of each series with their attribution.

    SPLIT, month, METRIC, HORIZON, MM, PREDICTED, BASE (of the log score), and a column ``..._units`` for each
    feature: its share of the difference between the prediction and the exponential of the base.
    """
    end = F.lit(train_end).cast("date")
    history = dense.where(F.col(MONTH) <= end)
    rows = None
    for m in metrics:
        own = training_rows(history, m)
        rows = own if rows is None else rows.unionByName(own)
    model = boosting.fit(rows, ["METRIC", "POPULATION"], FEATURES, "target", F.col(MONTH) > F.add_months(end, -holdout_months), params)
    long = None
    for m in metrics:
        own = history.select(*SPLIT, MONTH, "MM", F.col(m).alias("target"), F.lit(m).alias("METRIC"))
        long = own if long is None else long.unionByName(own)
    made = project(long, model, months, attribute=True)
    parts = made.select("*", *[F.col("contributions")[k].alias(f"_{f}") for k, f in enumerate(FEATURES)])
    parts = forecast.rescale_attribution(parts, [f"_{f}" for f in FEATURES], "PREDICTED", "BASE")
    return parts.select(*SPLIT, MONTH, "METRIC", "HORIZON", "MM", "PREDICTED", "BASE", *[F.col(f"_{f}_units").alias(f"{f}_units") for f in FEATURES])


def backtest(dense: DataFrame, origins: list[str], horizon: int, metric: str = "PMPM", holdout_months: int = 3, params: boosting.Params = boosting.Params()) -> DataFrame:
    """METHOD (trees or regression), ORIGIN, SPLIT, month, HORIZON, PREDICTED and ACTUAL: both models fitted anew at each origin on the months up to it only.

    One fit grows the trees of all origins and populations; features look back only, so they are made once.
    """
    origin = F.explode(F.array(*[F.lit(o).cast("date") for o in origins])).alias("ORIGIN")
    history = dense.select(*SPLIT, MONTH, "MM", F.col(metric).alias("target"), origin).where(F.col(MONTH) <= F.col("ORIGIN"))
    fitted = {}
    with scratch.space(dense.sparkSession) as keep:
        rows = keep(training_rows(dense, metric).select("*", origin).where(F.col(MONTH) <= F.col("ORIGIN")))
        trees = boosting.fit(rows, ["ORIGIN", "POPULATION"], FEATURES, "target", F.col(MONTH) > F.add_months("ORIGIN", -holdout_months), params)
        for (o,) in rows.select("ORIGIN").distinct().orderBy("ORIGIN").collect():
            glm = forecast.fit(forecast.scaled(rows.where(F.col("ORIGIN") == F.lit(o)).drop("month", "METRIC", "POPULATION")))
            fitted[(o,)] = (glm.intercept, list(glm.coefficients))
    out = None
    for method, model in (("trees", trees), ("regression", Regression(["ORIGIN"], fitted))):
        made = project(history, model, horizon, over=("ORIGIN",)).withColumn("METHOD", F.lit(method))
        out = made if out is None else out.unionByName(made)
    return out.join(dense.select(*SPLIT, MONTH, F.col(metric).alias("ACTUAL")), [*SPLIT, MONTH]).select("METHOD", "ORIGIN", *SPLIT, MONTH, "HORIZON", "PREDICTED", "ACTUAL")


def first_level(dense: DataFrame, metric: str, bins: int = 8) -> DataFrame:
    """POPULATION, feature, bin, g, h, n: the sums of the first level of the first tree, on bins of equal width of exposure and two lags."""
    own = ["target_lag1", "target_lag12", "MM"]
    rows = features(dense, metric).where("target_lag12 is not null")
    rows = rows.select("POPULATION", F.greatest("target", F.lit(0.0)).alias("y"), *[F.col(c).cast("double").alias(c) for c in own])
    edges = rows.groupBy("POPULATION").agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(f"_{c}") for c in own], F.log(F.avg("y")).alias("score"))
    edge = lambda c: F.transform(F.sequence(F.lit(1), F.lit(bins - 1)), lambda k: F.col(f"_{c}.lo") + (F.col(f"_{c}.hi") - F.col(f"_{c}.lo")) * k / bins)
    g, h = boosting.gradients(F.col("y"), F.col("score"))
    ready = rows.join(edges, "POPULATION").select(F.col("POPULATION").alias("model"), F.lit(0).alias("node"), g.alias("g"), h.alias("h"), F.array(*[boosting.bin_numbers(F.col(c), edge(c)) for c in own]).alias("bins"))
    name = F.element_at(F.array(*[F.lit(c) for c in own]), F.col("feature") + 1)
    return boosting.histogram(ready).select(F.col("model").alias("POPULATION"), name.alias("feature"), "bin", "g", "h", "n")
