"""Nested weekly surveillance payloads, flattened with VARIANT functions.

The payload nests positional arrays: week -> laboratory type -> region type -> region -> viruses and
metrics; arrays that are cut short give nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS = tuple(f"m{k}" for k in range(2, 11))


def _walk(df: DataFrame, arr: str, keep: list[str], out: str) -> DataFrame:
    """A row ``out`` (variant) for each element of the array in column ``arr``."""
    return df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(arr).outer())).select(*keep, F.col("value").alias(out))


def _at(c: str, i: int, kind: str) -> Column:
    return F.try_variant_get(F.col(c), f"$[{i}]", kind)


def flatten_regions(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """week, lab_type, region_type, region, n_viruses, m2 ... m10 and the viruses as a variant."""
    rows = payloads.select(F.try_variant_get(F.parse_json(payload), "$.data", "variant").alias("weeks"))
    rows = _walk(rows, "weeks", [], "w").select(_at("w", 0, "int").alias("week"), _at("w", 1, "variant").alias("labs"))
    rows = _walk(rows, "labs", ["week"], "x").select("week", _at("x", 0, "int").alias("lab_type"), _at("x", 1, "variant").alias("types"))
    rows = _walk(rows, "types", ["week", "lab_type"], "x").select("week", "lab_type", _at("x", 0, "int").alias("region_type"), _at("x", 1, "variant").alias("regions"))
    rows = _walk(rows, "regions", ["week", "lab_type", "region_type"], "x")
    return rows.select("week", "lab_type", "region_type", _at("x", 0, "int").alias("region"), _at("x", 1, "variant").alias("viruses"), *[_at("x", k, "double").alias(f"m{k}") for k in range(2, 11)])


def flatten_viruses(regions: DataFrame) -> DataFrame:
    keep = ["week", "lab_type", "region_type", "region"]
    rows = _walk(regions, "viruses", keep, "x")
    return rows.select(*keep, _at("x", 0, "int").alias("virus"), _at("x", 1, "int").alias("cumulative"), _at("x", 2, "int").alias("week3"), _at("x", 3, "int").alias("n"))


def read_surveillance(spark: SparkSession, path: str) -> DataFrame:
    """Landed payloads, one JSON text a file."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"))


def by_lab_type(df: DataFrame, lab_type: int) -> DataFrame:
    return df.where(F.col("lab_type") == lab_type)
