"""Distributed boosting against the same algorithm on arrays, attribution against all coalitions, projection against the monthly loop."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from actuspark.plans import boosting

PARAMS = boosting.Params(rounds=4, depth=2, rate=0.3, bins=64, least=5, chunk=2, patience=1)


def table(n=400, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = float(rnd.randint(0, 9)), rnd.choice([None, 1.0, 2.0, 3.0])
        c = float(i % 7)
        y = max(0.0, (20 if a > 4 else 5) * (2 if b == 2.0 else 1) + rnd.gauss(0, 1)) if rnd.random() > 0.1 else 0.0
        rows.append(("ab"[i % 2], i % 5 == 0, a, b, c, y))
    return rows + [("a", False, 1.0, 1.0, 1.0, None), ("empty", True, 1.0, 1.0, 1.0, 1.0)]


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.createDataFrame(table(), "kind string, held boolean, a double, b double, c double, y double").repartition(3)
    return df, boosting.fit(df, ["kind"], ["a", "b", "c"], "y", F.col("held"), PARAMS)


def brute(rows, params, model):
    """Each split is the best of all cuts at values (the features take few values, so each has its bin), and sums and leaves are those of loops."""
    train = [r for r in rows if not r[1] and r[5] is not None]
    x = [[math.nan if v is None else v for v in r[2:5]] for r in train]
    y = [r[5] for r in train]
    score = [math.log(sum(y) / len(y))] * len(y)
    for t in model:
        g = [math.exp(0.5 * s) - v * math.exp(-0.5 * s) for s, v in zip(score, y, strict=True)]
        h = [0.5 * math.exp(0.5 * s) + 0.5 * v * math.exp(-0.5 * s) for s, v in zip(score, y, strict=True)]
        groups = {0: list(range(len(y)))}
        for at in range(2**params.depth - 1):
            own = groups[at]
            value = lambda rows: (sum(g[i] for i in rows) ** 2) / (sum(h[i] for i in rows) + params.l2)
            gain = lambda f, c: value([i for i in own if not x[i][f] > c]) + value([i for i in own if x[i][f] > c]) - value(own)
            ok = lambda f, c: min(sum(not x[i][f] > c for i in own), sum(x[i][f] > c for i in own)) >= params.least
            cuts = [(f, c) for f in range(3) for c in {-math.inf, *(r[f] for r in x if not math.isnan(r[f]))}]
            best = max((gain(f, c) for f, c in cuts if ok(f, c)), default=0.0)
            f, c = t.feature[at], t.threshold[at]
            if c == math.inf:
                assert best <= 1e-6 or len(own) < 2 * params.least
            else:
                assert ok(f, c) and abs(gain(f, c) - best) < 1e-6
            assert t.n[at] == len(own)
            groups[2 * at + 1], groups[2 * at + 2] = [i for i in own if not x[i][f] > c], [i for i in own if x[i][f] > c]
        for k in range(2**params.depth):
            own = groups[2**params.depth - 1 + k]
            want = -params.rate * sum(g[i] for i in own) / (sum(h[i] for i in own) + params.l2) if own else 0.0
            assert abs(t.value[k] - want) < 1e-9
            for i in own:
                score[i] += t.value[k]


def test_trees_equal_brute_force(fitted):
    df, model = fitted
    assert set(model.trees) == {("a",), ("b",)} and all(model.trees.values())
    for name, trees in model.trees.items():
        brute([r for r in table() if r[0] == name[0]], PARAMS, trees)


def test_histogram_and_splits_are_exact_on_few_values(spark):
    """Where every value has its bin, the best split is the best of all splits."""
    rnd = random.Random(4)
    rows = [(k % 2, 0, rnd.uniform(-3, 3), rnd.uniform(0.1, 1), [rnd.randint(0, 4), rnd.randint(0, 4)]) for k in range(300)]
    hist = boosting.histogram(spark.createDataFrame(rows, "model int, node int, g double, h double, bins array<int>"))
    got = {r["model"]: r for r in boosting.best_splits(hist, PARAMS).collect()}
    for m in (0, 1):
        own = [r for r in rows if r[0] == m]
        value = lambda rs: sum(r[2] for r in rs) ** 2 / (sum(r[3] for r in rs) + 1.0)
        best = max((round(value([r for r in own if r[4][f] <= b]) + value([r for r in own if r[4][f] > b]) - value(own), 9), -f, -b) for f in (0, 1) for b in range(4))
        assert (got[m]["split"]["feature"], got[m]["split"]["bin"]) == (-best[1], -best[2]) and got[m]["nt"] == len(own)


def test_the_holdout_ends_growth(spark):
    """On noise, later rounds don't help the held-out rows, and the model ends at its best round."""
    rnd = random.Random(9)
    rows = [("x", i % 3 == 0, rnd.random(), rnd.random(), rnd.random(), rnd.expovariate(1)) for i in range(300)]
    df = spark.createDataFrame(rows, "kind string, held boolean, a double, b double, c double, y double")
    model = boosting.fit(df, ["kind"], ["a", "b", "c"], "y", F.col("held"), boosting.Params(rounds=12, depth=2, rate=0.9, bins=8, least=5, chunk=2, patience=1))
    assert len(model.trees["x",]) < 12
    held = np.array([[r[2], r[3], r[4], r[5]] for r in rows if r[1]])
    assert abs(math.sqrt(np.mean((model.predict(("x",), held[:, :3]) - held[:, 3]) ** 2)) - model.error["x",]) < 1e-9


def test_attribution_equals_all_coalitions(fitted):
    _, model = fitted
    x = np.array([[math.nan if v is None else v for v in r[2:5]] for r in table()[:40]])
    name = ("a",)

    def value(tree, row, held, at=0):
        if at >= len(tree.feature):
            return tree.value[at - len(tree.feature)]
        f, n, left, right = tree.feature[at], tree.n[at], 2 * at + 1, 2 * at + 2
        if f in held:
            return value(tree, row, held, right if row[f] > tree.threshold[at] else left)
        return sum(tree.n[c] / n * value(tree, row, held, c) for c in (left, right) if tree.n[c])

    total = lambda row, held: model.start[name] + sum(value(t, row, held) for t in model.trees[name])
    got = model.contributions(name, x)
    for row, have in zip(x, got, strict=True):
        for f in range(3):
            others, want = [o for o in range(3) if o != f], 0.0
            for size in range(3):
                for held in itertools.combinations(others, size):
                    want += math.factorial(size) * math.factorial(2 - size) / 6 * (total(row, {*held, f}) - total(row, set(held)))
            assert abs(have[f] - want) < 1e-9
        assert abs(total(row, set()) - model.base(name)) < 1e-9
    assert np.allclose(model.base(name) + got.sum(axis=1), model.log_score(name, x))


def test_predictions_in_spark(fitted):
    df, model = fitted
    rows = boosting.predict(model, df).collect()
    for r in rows:
        want = model.predict((r["kind"],), np.array([[math.nan if r[c] is None else r[c] for c in "abc"]]))[0]
        assert (r["prediction"] is None) if r["kind"] == "empty" else abs(r["prediction"] - want) < 1e-9
