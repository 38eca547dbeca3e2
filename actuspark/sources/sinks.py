"""Idempotent sinks on partitioned parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_slice(df: DataFrame, path: str, keys: tuple[str, ...] = ("VAL_DATE",)) -> None:
    """Replace the slices that ``df`` holds, and no other."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_scenario(df: DataFrame, path: str, keys: tuple[str, ...] = ("VAL_DATE", "TRAIN_END", "HCC")) -> None:
    """Replace the scenarios that ``df`` holds; a table from before the keys were partitions is replaced whole, as its rows name no scenario."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    legacy = fs.exists(at) and not set(keys) <= set(spark.read.parquet(path).columns)
    if legacy:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*keys).parquet(path)
    else:
        write_slice(df, path, keys)


def conform_types(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; missing ones are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def create_like(df: DataFrame, path: str) -> None:
    df.limit(0).write.mode("ignore").parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def all_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def export_csv(frames: dict[str, DataFrame], path: str) -> None:
    """All products' rows in one CSV folder, by product."""
    out = None
    for name, df in frames.items():
        own = df.withColumn("product", F.lit(name))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    out.write.mode("overwrite").partitionBy("product").option("header", True).csv(path)


def write_report_json(header: DataFrame, ranked: DataFrame, key: str, order: list[str], path: str) -> None:
    """One JSON object for each header row, with its ranked rows (bounded by their report) as an array."""
    rows = ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in ranked.columns if c not in (key, *order)]))).alias("rows"))
    header.join(rows, key, "left").write.mode("overwrite").json(path)
