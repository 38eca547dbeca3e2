"""Gradient-boosted trees with a Tweedie loss and log link, grown from histograms by Spark.

One job a level grows all models (one for each value of the key columns) together: rows, as bin numbers of
their features, are walked down the tree so far, their gradients and hessians are summed by model, node,
feature and bin in one aggregation with partial sums, and windows over these sums give the best split
of each node. Only splits come to the driver: models x nodes of a level, whatever the rows. Bin edges are
approximate quantiles of each model's own rows. Rows that are held out by date never shape a tree; after
every ``chunk`` rounds one job measures the error after each of them, a model ends at its best
round, and growth stops for it after ``patience`` chunks without a better one. The rows' scores are
written anew at each chunk, which cuts the lineage.

A null feature is a bin of its own below all others. Trees are complete: a node that isn't split sends all
rows left. ``Boosted`` holds the trees as numbers only: it predicts and attributes by numpy in tasks.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from ..sources import scratch

#: Models that one fit may grow: their splits are held by the driver.
MOST_MODELS = 10_000


@dataclass(frozen=True)
class Params:
    rounds: int = 20
    depth: int = 3
    rate: float = 0.25
    bins: int = 32
    power: float = 1.5
    least: int = 20
    l2: float = 1.0
    chunk: int = 5
    patience: int = 2


@dataclass
class Tree:
    """A complete binary tree: rows go left where the feature is null or at most the threshold; ``n`` are the training rows of every node."""

    feature: list[int]
    cut: list[int]
    threshold: list[float]
    value: list[float]
    n: list[int]

    @property
    def depth(self) -> int:
        return len(self.value).bit_length() - 1

    def leaf(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[np.arange(len(x)), feature[at]] > threshold[at])
        return at - len(self.feature)

    def paths(self) -> Iterator[tuple[float, dict[int, tuple[list[tuple[float, bool]], float]]]]:
        """Of each leaf with rows: its value, and for each feature on its path the conditions (threshold, whether above it) and the share of rows that meet them."""
        for k, value in enumerate(self.value):
            at, path = k + len(self.feature), {}
            if not self.n[at]:
                continue
            while at:
                up, right = (at - 1) // 2, at % 2 == 0
                if self.n[at] < self.n[up]:
                    conditions, share = path.get(self.feature[up], ([], 1.0))
                    path[self.feature[up]] = ([*conditions, (self.threshold[up], right)], share * self.n[at] / self.n[up])
                at = up
            yield value, path


@dataclass
class Boosted:
    """Trees by model; a model's name is the tuple of its key columns' values."""

    keys: list[str]
    features: list[str]
    start: dict[tuple, float]
    trees: dict[tuple, list[Tree]]
    error: dict[tuple, float | None] = field(default_factory=dict)

    def log_score(self, name: tuple, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start[name])
        for t in self.trees[name]:
            out += np.array(t.value)[t.leaf(x)]
        return out

    def predict(self, name: tuple, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of features (null: nan); nan where there is no such model."""
        return np.exp(self.log_score(name, x)) if name in self.start else np.full(len(x), np.nan)

    def base(self, name: tuple) -> float:
        """The mean of the log scores over the training rows, tree by tree."""
        return self.start[name] + sum(value * math.prod(share for _, share in path.values()) for t in self.trees[name] for value, path in t.paths())

    def contributions(self, name: tuple, x: np.ndarray) -> np.ndarray:
        """Path-dependent Shapley values of the log score, a column for each feature; with the base they add up to the score.

        A coalition's value follows the row where it holds a node's feature and averages both
        sides by their training rows elsewhere. The game is a sum over leaves, and a leaf's part
        depends on the few features of its path only, so their subsets are listed.
        """
        out = np.zeros((len(x), len(self.features)))
        for t in self.trees.get(name, []):
            for value, path in t.paths():
                # A null is below every threshold.
                meets = {f: np.all([(x[:, f] > c) == right for c, right in conditions], axis=0) for f, (conditions, _) in path.items()}
                for f, (_, share) in path.items():
                    others = [o for o in path if o != f]
                    weight = np.zeros(len(x))
                    for size in range(len(others) + 1):
                        ways = math.factorial(size) * math.factorial(len(others) - size) / math.factorial(len(path))
                        for held in combinations(others, size):
                            gone = math.prod(path[o][1] for o in others if o not in held)
                            weight += ways * gone * np.all([meets[o] for o in held] or [np.ones(len(x), bool)], axis=0)
                    out[:, f] += value * (meets[f] - share) * weight
        return out


def predict(model: Boosted, df: DataFrame, out: str = "prediction") -> DataFrame:
    """``df`` with each row's prediction by the model that its key columns name; null where there is none."""
    scratch.ship(df.sparkSession)
    names = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows[out] = np.nan
            for name, own in rows.groupby(model.keys, dropna=False):
                rows.loc[own.index, out] = model.predict(name, own[model.features].to_numpy(float, na_value=np.nan))
            yield rows[[*names, out]]

    done = df.mapInPandas(run, StructType([*df.schema.fields, StructField(out, DoubleType())]))
    return done.withColumn(out, F.nanvl(out, F.lit(None)))


def gradients(y: Column, score: Column, power: float = 1.5) -> tuple[Column, Column]:
    """Gradient and hessian of the Tweedie deviance by the log score."""
    low, high = F.exp((1 - power) * score), F.exp((2 - power) * score)
    return high - y * low, (2 - power) * high - (1 - power) * y * low


def bin_numbers(x: Column, edges: Column) -> Column:
    """0 for a null, else 1 and the number of edges below the value."""
    return F.when(x.isNull(), 0).otherwise(1 + F.size(F.filter(edges, lambda e: e < x)))


def histogram(rows: DataFrame) -> DataFrame:
    """model, node, feature, bin, g, h, n from rows with model, node, g, h and bins (an array of bin numbers by feature)."""
    each = rows.select("model", "node", "g", "h", F.posexplode("bins").alias("feature", "bin"))
    return each.groupBy("model", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))


def best_splits(hist: DataFrame, params: Params) -> DataFrame:
    """The best split of each node (split is null where none is allowed or gains): its feature and bin, the sums left of it, and the node's own."""
    node = Window.partitionBy("model", "node", "feature")
    left = node.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = hist.repartition("model", "node").select("model", "node", "feature", "bin", *[F.sum(c).over(w).alias(f"{c}{k}") for c in ("g", "h", "n") for k, w in (("l", left), ("t", node))])
    value = lambda g, h: g * g / (h + params.l2)
    gl, gt, hl, ht, nl, nt = (F.col(c) for c in ("gl", "gt", "hl", "ht", "nl", "nt"))
    gain = F.round(value(gl, hl) + value(gt - gl, ht - hl) - value(gt, ht), 9)
    allowed = (nl >= params.least) & (nt - nl >= params.least) & (gain > 0)
    split = F.struct("feature", "bin", "gl", "hl", "nl")
    order = F.when(allowed, F.struct(gain, -F.col("feature"), -F.col("bin")))
    return sums.groupBy("model", "node").agg(F.max_by(F.when(allowed, split), order).alias("split"), *[F.min_by(c, F.struct("feature", "bin")).alias(c) for c in ("gt", "ht", "nt")])


def fit(rows: DataFrame, keys: list[str], features: list[str], target: str, held: Column, params: Params = Params()) -> Boosted:
    """A model for each value of ``keys``; a negative target counts as 0, rows without a target are left out."""
    with scratch.space(rows.sparkSession) as keep:
        return _fit(rows, keys, features, target, held, params, keep)


def _fit(rows: DataFrame, keys: list[str], features: list[str], target: str, held: Column, params: Params, keep: Callable[[DataFrame], DataFrame]) -> Boosted:
    spark = rows.sparkSession
    names = sorted(tuple(r) for r in rows.select(*keys).distinct().limit(MOST_MODELS + 1).collect())
    if len(names) > MOST_MODELS:
        raise ValueError(f"more than {MOST_MODELS} models")
    numbered = spark.createDataFrame([(*name, k) for k, name in enumerate(names)], StructType([*[rows.schema[k] for k in keys], *StructType.fromDDL("model int").fields])) if names else rows.select(*keys, F.lit(0).alias("model")).limit(0)
    clean = [F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in features]
    data = rows.join(F.broadcast(numbered), keys).where(F.col(target).isNotNull()).select("model", F.greatest(F.col(target).cast("double"), F.lit(0.0)).alias("y"), F.coalesce(held, F.lit(False)).alias("held"), F.array(*clean).alias("x"))
    data = keep(data)
    marks = [k / params.bins for k in range(1, params.bins)]
    edges = data.where("not held").groupBy("model").agg(F.array(*[F.array_distinct(F.coalesce(F.percentile_approx(F.col("x")[k], marks), F.array().cast("array<double>"))) for k in range(len(features))]).alias("edges"), F.log(F.avg("y")).alias("start"))
    edges = keep(edges.where("start is not null"))
    known = {r["model"]: r for r in edges.collect()}
    bins = F.array(*[bin_numbers(F.col("x")[k], F.col("edges")[k]) for k in range(len(features))])
    state = keep(data.join(F.broadcast(edges), "model").select("model", "y", "held", bins.alias("bins"), F.col("start").alias("score")))

    trees: dict[int, list[Tree]] = {m: [] for m in known}
    best: dict[int, tuple[float, int]] = {}
    active, done = sorted(known), 0
    while active and done < params.rounds:
        own = state.where(F.col("model").isin(active))
        grown: list[dict[int, Tree]] = []
        for _ in range(min(params.chunk, params.rounds - done)):
            grown.append(_grow(own, grown, known, len(names), params))
        done += len(grown)
        for m in active:
            trees[m] += [g[m] for g in grown]
        errors = _errors(own, grown, len(names), params)
        for m in active:
            for k, e in enumerate(errors.get(m, [])):
                if e is not None and (m not in best or e < best[m][0]):
                    best[m] = (e, done - len(grown) + k)
        active = [m for m in active if m not in best or best[m][1] > done - params.chunk * params.patience]
        if active and done < params.rounds:
            state = keep(own.withColumn("score", F.expr(_score(grown, len(names), params))))
    named = {names[m]: m for m in known}
    return Boosted(keys, features, {n: known[m]["start"] for n, m in named.items()}, {n: trees[m][: best[m][1]] if m in best else trees[m] for n, m in named.items()}, {n: best[m][0] if m in best else None for n, m in named.items()})


def _sql(rows: list[list], kind: str = "int") -> str:
    """Numbers by model and place as one literal: the optimiser folds it, where an array of literals would be as many nodes."""
    return f"from_json('{json.dumps(rows)}', 'array<array<{kind}>>')"


def _walk(trees: dict[int, Tree], n_models: int, levels: int, params: Params) -> str:
    """SQL of a row's node after ``levels`` levels."""
    if not levels:
        return "0"
    none = [0] * (2**params.depth - 1)
    feature = _sql([trees[m].feature if m in trees else none for m in range(n_models)])
    cut = _sql([trees[m].cut if m in trees else none for m in range(n_models)])
    return f"aggregate(sequence(1, {levels}), 0, (at, step) -> 2 * at + 1 + if(bins[{feature}[model][at]] > {cut}[model][at], 1, 0))"


def _score(grown: list[dict[int, Tree]], n_models: int, params: Params) -> str:
    none, inner = [0.0] * 2**params.depth, 2**params.depth - 1
    parts = [f"{_sql([g[m].value if m in g else none for m in range(n_models)], 'double')}[model][{_walk(g, n_models, params.depth, params)} - {inner}]" for g in grown]
    return " + ".join(["score", *parts])


def _grow(state: DataFrame, grown: list[dict[int, Tree]], known: dict, n_models: int, params: Params) -> dict[int, Tree]:
    """One more tree for each model: a job a level."""
    inner, never = 2**params.depth - 1, params.bins + 1
    trees = {m: Tree([0] * inner, [never] * inner, [math.inf] * inner, [0.0] * (inner + 1), [0] * (2 * inner + 1)) for m in known}
    sums: dict[tuple[int, int], tuple[float, float, int]] = {}
    train = state.where("not held").select("model", "y", "bins", F.expr(_score(grown, n_models, params)).alias("score"))
    g, h = gradients(F.col("y"), F.col("score"), params.power)
    for level in range(params.depth):
        rows = train.select("model", F.expr(_walk(trees, n_models, level, params)).alias("node"), g.alias("g"), h.alias("h"), "bins")
        for r in best_splits(histogram(rows), params).collect():
            m, at, split = r["model"], r["node"], r["split"]
            t, whole = trees[m], (r["gt"], r["ht"], r["nt"])
            t.n[at] = r["nt"]
            left = whole
            if split is not None:
                left = (split["gl"], split["hl"], split["nl"])
                edges = known[m]["edges"][split["feature"]]
                t.feature[at], t.cut[at] = split["feature"], split["bin"]
                t.threshold[at] = edges[split["bin"] - 1] if split["bin"] else -math.inf
            sums[m, 2 * at + 1], sums[m, 2 * at + 2] = left, tuple(a - b for a, b in zip(whole, left, strict=True))
    for m, t in trees.items():
        for k in range(inner + 1):
            if (m, inner + k) in sums:
                gs, hs, n = sums[m, inner + k]
                t.n[inner + k] = n
                t.value[k] = -params.rate * gs / (hs + params.l2) if n else 0.0
    return trees


def _errors(state: DataFrame, grown: list[dict[int, Tree]], n_models: int, params: Params) -> dict[int, list[float | None]]:
    """Root mean squared error on the held-out rows of each model, before the new trees and after each of them."""
    held = state.where("held")
    scored = [F.exp(F.expr(_score(grown[:k], n_models, params))) - F.col("y") for k in range(len(grown) + 1)]
    out = held.groupBy("model").agg(*[F.sqrt(F.avg(e * e)).alias(f"e{k}") for k, e in enumerate(scored)])
    return {r["model"]: list(r)[1:] for r in out.collect()}
