"""Silhouettes, inertia and cluster factors of month shapes against loops."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from actuspark.plans import seasonality

MONTHS = seasonality.MONTHS


@pytest.fixture(scope="module")
def shapes(spark):
    rnd = random.Random(1)
    rows = [(f"g{n}", *[1.0 + (n % 3) * 0.2 * math.sin(m) + rnd.gauss(0, 0.05) for m in range(12)]) for n in range(200)]
    return spark.createDataFrame(rows, "g string, " + ", ".join(f"`{m}` double" for m in MONTHS)), rows


def test_silhouette_and_inertia_equal_loops(spark, shapes):
    df, rows = shapes
    label = {r[0]: k % 4 if k < 199 else 9 for k, r in enumerate(rows)}
    made = df.join(spark.createDataFrame(list(label.items()), "g string, cluster int"), "g")
    by = {c: [r[1:] for r in rows if label[r[0]] == c] for c in set(label.values())}
    total = 0.0
    for r in rows:
        own = by[label[r[0]]]
        if len(own) > 1:
            a = sum(math.dist(r[1:], o) for o in own) / (len(own) - 1)
            b = min(sum(math.dist(r[1:], o) for o in x) / len(x) for c, x in by.items() if c != label[r[0]])
            total += (b - a) / max(a, b)
    for block in (50, 2000):
        assert abs(seasonality.silhouette(made, block) - total / 200) < 1e-9
    want = sum(math.dist(s, [statistics.mean(v) for v in zip(*x, strict=True)]) ** 2 for x in by.values() for s in x)
    assert abs(seasonality.inertia(made).first()["inertia"] - want) < 1e-5
    assert seasonality.silhouette(made.withColumn("cluster", F.lit(0))) is None


def test_flat_groups_stand_apart(spark, shapes):
    df, _ = shapes
    flat = spark.createDataFrame([(f"flat{n}", *[1.0] * 12) for n in range(3)], df.schema)
    made = seasonality.flat_apart(df.unionByName(flat), 3)
    assert {r["g"] for r in made.where("cluster is null").collect()} == {"flat0", "flat1", "flat2"} and made.where("cluster is not null").count() == 200
    labels = df.unionByName(flat).select("g", F.lit(1).alias("cluster"))
    factors = seasonality.cluster_factors(df.unionByName(flat), labels, ["g"])
    by = {(r["g"], r["month"]): r["factor"] for r in factors.collect()}
    middle = statistics.median(r["1"] for r in df.collect())
    assert abs(by["g7", 1] - middle) < 1e-12 and by["flat1", 1] == 1.0 and len(by) == 203 * 12
    swept = seasonality.sweep_k(df, [2, 3])
    assert [k for k, *_ in swept] == [2, 3] and swept[1][1] < swept[0][1] and all(0 < s < 1 for *_, s in swept)
