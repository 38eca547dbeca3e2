"""Sources: parquet and catalog tables, remote queries, monthly closes, feeds, captions and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLAIMS = "incurred_year_month date, plan_type string, claim_type string, plan_paid decimal(18,2)"
MEMBERS = "year_month date, plan_type string, member_months bigint"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_query(spark: SparkSession, options: dict[str, str], sql: str, kind: str = "jdbc") -> DataFrame:
    """A query that the remote warehouse runs."""
    return spark.read.format(kind).options(**options).option("query", sql).load()


def read_close(spark: SparkSession, path: str, close: str, schema: str = CLAIMS) -> DataFrame:
    """One close's CSV files (``MM/dd/yyyy`` dates), stamped with the close."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", "MM/dd/yyyy").csv(path).withColumn("close", F.last_day(F.to_date(F.lit(close), "yyyyMM")))


def read_closes(spark: SparkSession, root: str, closes: list[str], prefix: str = "clms", schema: str = CLAIMS) -> DataFrame:
    frames = [read_close(spark, f"{root}/{c}/{prefix}_{c}.csv", c, schema) for c in closes]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """One row for each item of a feed, with its time of publication."""
    raw = spark.read.format("xml").option("rowTag", "item").load(path)
    when = F.regexp_replace("pubDate", r"^\w+,\s*", "")
    return raw.withColumn("published", F.try_to_timestamp(when, F.lit("d MMM yyyy HH:mm:ss Z")))


def captions_to_text(payload: Column) -> Column:
    """The words of a caption payload: the segments of JSON events, or the text nodes of XML."""
    parsed = F.from_json(payload, "events array<struct<segs:array<struct<utf8:string>>>>")
    events = F.flatten(F.transform(parsed["events"], lambda e: F.transform(F.coalesce(e["segs"], F.array().cast("array<struct<utf8:string>>")), lambda s: s["utf8"])))
    is_xml = F.ltrim(payload).startswith("<")
    nodes = F.from_xml(F.when(is_xml, payload), "text array<struct<_VALUE string, _start string>>", {"valueTag": "_VALUE"})
    lines = F.transform(nodes["text"], lambda t: F.coalesce(t["_VALUE"], F.lit("")))
    return F.trim(F.regexp_replace(F.array_join(F.when(is_xml, lines).otherwise(events), " "), r"\s+", " "))


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
