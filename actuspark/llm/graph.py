"""Connected components of large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import save


def components(edges: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """(node, component) for each node of ``edges``; the component is its least node.

    Alternates large-star and small-star steps: each replaces the edges of a node by edges to the
    least node next to it, so that every component becomes a star. Nodes may be of any type that
    Spark orders. Each step groups by node with partial aggregation and joins the minima back; no
    group is collected. ``rows``: a bound of the edges, if known. Edges with a null end and loops are ignored; an empty table has no nodes.
    """
    up = F.col(a) > F.col(b)
    ends = edges.select(F.when(up, F.col(a)).otherwise(F.col(b)).alias("hi"), F.when(up, F.col(b)).otherwise(F.col(a)).alias("lo"))
    now = save(ends.where("hi is not null and lo is not null and hi <> lo").distinct(), rows)
    size = now.count()
    # Stars whose centres are no one's satellites are whole components already.
    while size and not now.join(now.select(F.col("hi").alias("lo")).distinct(), "lo", "left_semi").unionByName(_shared_satellites(now)).isEmpty():
        # Large star: the greater neighbours of each node go to the least of its neighbourhood.
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.when(F.col("m") < F.col("u"), F.col("m")).otherwise(F.col("u")))
        big = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        # Small star: the smaller neighbours of each node, and the node itself, go to the least of them.
        low = big.groupBy("hi").agg(F.min("lo").alias("m"))
        small = big.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = save(small.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct(), size)
    least = now.select(F.col("lo").alias("node")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(least.select("node", F.col("node").alias("component")))


def _shared_satellites(edges: DataFrame) -> DataFrame:
    """Edges of nodes that have several smaller neighbours."""
    return edges.groupBy("hi").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo")).where("n > 1").select("hi", "lo")
