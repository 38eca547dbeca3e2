"""Seasonality factors: month rates over year rates, clusters of their shapes, and neutral scaffolds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.derive import chi_square_tail, clip, month_name, ratio
from ..operators.frames import complete_groups
from ..sources import scratch

MONTHS = [str(m) for m in range(1, 13)]


def norm_factors(df: DataFrame, keys: list[str], month: str, amount: str, exposure: str, n_months: int = 12) -> DataFrame:
    """Month rate over year rate of each group and year that has all months; null where the year has no cost."""
    rows = complete_groups(df.withColumn("year", F.year(month)), [*keys, "year"], month, n_months)
    year = rows.groupBy(*keys, "year").agg(F.sum(amount).alias("ya"), F.sum(exposure).alias("ye"))
    by_month = rows.groupBy(*keys, "year", F.month(month).alias("month")).agg(F.sum(amount).alias("ma"), F.sum(exposure).alias("me"))
    factor = ratio(ratio(F.col("ma"), F.col("me")), ratio(F.col("ya"), F.col("ye")))
    return by_month.join(year, [*keys, "year"]).select(*keys, "year", "month", F.bround(factor, 4).alias("factor"))


def average_years(factors: DataFrame, keys: list[str]) -> DataFrame:
    return factors.groupBy(*keys, "month").agg(F.round(F.avg(F.col("factor").cast("decimal(18,4)")).cast("double"), 4).alias("factor"))


def month_vectors(factors: DataFrame, keys: list[str]) -> DataFrame:
    """One row a group with the columns 1 to 12; missing months are 1."""
    return factors.groupBy(*keys).pivot("month", list(range(1, 13))).agg(F.first("factor")).fillna(1.0, MONTHS)


def cluster_shapes(vectors: DataFrame, k: int, seed: int = 7) -> DataFrame:
    """A cluster for each group; k is at most one less than the groups, and one cluster is all there is below two."""
    n = vectors.count()
    k = min(k, n - 1)
    if k < 2:
        return vectors.withColumn("cluster", F.lit(0))
    rows = VectorAssembler(inputCols=MONTHS, outputCol="shape").transform(vectors)
    return KMeans(k=k, seed=seed, featuresCol="shape", predictionCol="cluster").fit(rows).transform(rows).drop("shape")


def repair_small(clustered: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Groups of clusters below ``least`` go to the nearest centre of the others (centres: one row a cluster)."""
    centres = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.array(*[F.avg(m) for m in MONTHS]).alias("centre"))
    valid = centres.where(F.col("size") >= least).select(F.struct(F.col("cluster").alias("c"), "centre").alias("x")).agg(F.collect_list("x").alias("valid"))
    shape = F.array(*[F.col(m) for m in MONTHS])
    far = lambda c: F.aggregate(F.zip_with(shape, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    best = F.array_min(F.transform("valid", lambda x: F.struct(far(x["centre"]).alias("d"), x["c"].alias("c"))))["c"]
    rows = clustered.join(F.broadcast(centres.select("cluster", "size")), "cluster").join(F.broadcast(valid))
    return rows.withColumn("cluster", F.when((F.col("size") < least) & (F.size("valid") > 0), best).otherwise(F.col("cluster"))).drop("size", "valid")


def inertia(clustered: DataFrame) -> DataFrame:
    """One row: n and the sum of squared distances of the shapes to the centres of their clusters."""
    centres = clustered.groupBy("cluster").agg(*[F.avg(m).alias(f"c{m}") for m in MONTHS])
    square = sum(((F.col(m) - F.col(f"c{m}")) * (F.col(m) - F.col(f"c{m}")) for m in MONTHS), F.lit(0.0))
    return clustered.join(centres, "cluster").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(square), 6).alias("inertia"))


def silhouette(clustered: DataFrame, block: int = 2000) -> float | None:
    """The mean silhouette of shapes in their clusters by Euclidean distances; null below two clusters.

    All distances count, so points are dealt into blocks of about ``block`` and a task compares two blocks as arrays: it gives
    each point's sum of distances to each cluster there, and Spark adds the sums up. A point alone in its cluster has 0.
    """
    scratch.ship(clustered.sparkSession)
    parts = 1 + clustered.count() // block
    shape = F.array(*[F.col(m) for m in MONTHS])
    rows = clustered.select(F.xxhash64(F.monotonically_increasing_id()).alias("_h"), F.monotonically_increasing_id().alias("id"), "cluster", shape.alias("shape"))
    rows = rows.select("id", "cluster", "shape", F.pmod("_h", F.lit(parts)).cast("int").alias("own"))
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = rows.select(F.col("own").alias("i"), every.alias("j"), F.lit(0).alias("role"), "id", "cluster", "shape")
    right = rows.select(every.alias("i"), F.col("own").alias("j"), F.lit(1).alias("role"), "id", "cluster", "shape")

    def run(pair: pd.DataFrame) -> pd.DataFrame:
        points, others = pair[pair["role"] == 0], pair[pair["role"] == 1]
        out = []
        if len(points) and len(others):
            x = np.stack(points["shape"].to_numpy())
            for cluster, own in others.groupby("cluster"):
                far = np.sqrt(((x[:, None, :] - np.stack(own["shape"].to_numpy())[None, :, :]) ** 2).sum(axis=2))
                out.append(pd.DataFrame({"id": points["id"], "cluster": points["cluster"], "other": cluster, "far": far.sum(axis=1), "n": len(own)}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "cluster": [], "other": [], "far": [], "n": []})

    sums = left.unionByName(right).groupBy("i", "j").applyInPandas(run, "id bigint, cluster int, other int, far double, n bigint")
    sums = sums.groupBy("id", "cluster", "other").agg(F.sum("far").alias("far"), F.sum("n").alias("n"))
    same = F.col("cluster") == F.col("other")
    point = sums.groupBy("id").agg(F.max(F.when(same, F.col("n"))).alias("n"), F.max(F.when(same, F.try_divide(F.col("far"), F.col("n") - 1))).alias("a"), F.min(F.when(~same, F.col("far") / F.col("n"))).alias("b"))
    value = F.when(F.col("n") == 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return point.where("b is not null").agg(F.avg(value)).first()[0]


def sweep_k(vectors: DataFrame, ks: list[int], seed: int = 7) -> list[tuple[int, float, float | None]]:
    """(k, inertia, mean Euclidean silhouette) for each k."""
    out = []
    with scratch.space(vectors.sparkSession) as keep:
        shapes = keep(vectors)
        for k in ks:
            made = keep(cluster_shapes(shapes, k, seed))
            out.append((k, inertia(made).first()["inertia"], silhouette(made)))
    return out


def cluster_factors(vectors: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """keys, month and factor from given clusters: the median of each cluster and month over its groups, clipped.

    Flat groups (all twelve factors are 1) stand apart: they stay 1 and are no members of a cluster.
    """
    flat = F.forall(F.array(*[F.col(m) for m in MONTHS]), lambda v: v == 1.0)
    months = vectors.withColumn("flat", flat).select(*keys, "flat", F.posexplode(F.array(*[F.col(m) for m in MONTHS])).alias("at", "own")).withColumn("month", F.col("at") + 1)
    rows = months.join(labels.select(*keys, "cluster"), keys, "left")
    medians = rows.where("not flat and cluster is not null").groupBy("cluster", "month").agg(F.median("own").alias("median"))
    out = rows.join(medians, ["cluster", "month"], "left")
    return out.select(*keys, "month", clip(F.when(F.col("flat"), 1.0).otherwise(F.col("median"))).alias("factor"))


def flat_apart(vectors: DataFrame, k: int, seed: int = 7) -> DataFrame:
    """``vectors`` with clusters of those that vary; flat ones get none."""
    flat = F.forall(F.array(*[F.col(m) for m in MONTHS]), lambda v: v == 1.0)
    varied = cluster_shapes(vectors.where(~flat), k, seed)
    return varied.unionByName(vectors.where(flat).withColumn("cluster", F.lit(None).cast("int")))


def cluster_median(factors: DataFrame, clusters: DataFrame, keys: list[str]) -> DataFrame:
    return factors.join(clusters.select(*keys, "cluster"), keys).groupBy("cluster", "month").agg(F.median("factor").alias("factor"))


def scaffold(keys_df: DataFrame, factors: DataFrame, keys: list[str]) -> DataFrame:
    """All keys and months with a clipped factor, 1 where there is none."""
    full = keys_df.select(*keys).distinct().withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    out = full.join(factors, [*keys, "month"], "left").withColumn("factor", clip(F.col("factor")))
    return out.withColumn("month_name", month_name(F.make_date(F.lit(2000), F.col("month"), F.lit(1))))


def friedman(df: DataFrame, group: str, block: str, treatment: str, value: str) -> DataFrame:
    """Friedman's statistic by group with mean ranks for ties and the tie correction, and its p-value with k - 1 degrees of freedom."""
    cell = Window.partitionBy(group, block)
    rank = F.rank().over(cell.orderBy(value))
    ties = F.count(F.lit(1)).over(Window.partitionBy(group, block, value))
    rows = df.where(F.col(value).isNotNull()).withColumns({"_r": rank, "_t": ties, "_k": F.count(F.lit(1)).over(cell)}).withColumn("_r", F.col("_r") + (F.col("_t") - 1) / 2)
    tie = rows.groupBy(group).agg(F.sum(F.col("_t") * F.col("_t") - 1).alias("ties"), F.count_distinct(block).alias("n"), F.max("_k").alias("k"))
    sums = rows.groupBy(group, treatment).agg(F.sum("_r").alias("s")).groupBy(group).agg(F.sum(F.col("s") * F.col("s")).alias("ss"))
    n, k = F.col("n"), F.col("k")
    raw = 12 * F.col("ss") / (n * k * (k + 1)) - 3 * n * (k + 1)
    fix = 1 - F.col("ties") / (n * (k * k * k - k))
    return tie.join(sums, group).where("k >= 3 and n >= 2").select(group, "n", "k", F.round(F.try_divide(raw, fix), 4).alias("statistic"), F.round(chi_square_tail(F.try_divide(raw, fix), k - 1), 6).alias("p_value"))


def residual_trend(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.round(F.regr_slope(F.col(y), F.col(x)), 4).alias("slope"), F.round(F.regr_r2(F.col(y), F.col(x)), 4).alias("r2"))


def flat_series(factors: DataFrame, keys: list[str]) -> DataFrame:
    """keys and flat: whether all of a group's factors are 1."""
    return factors.groupBy(*keys).agg(F.every(F.coalesce(F.col("factor"), F.lit(1.0)) == 1.0).alias("flat"))
