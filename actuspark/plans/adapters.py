"""Shapes of the health-cost plans, derived from the star-schema tables of the test data.

A line item is a claim line, an order's customer and date are its enrolment. Each function reads
whole tables and keeps only the columns that the plans need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import MONEY
from ..sources.readers import read_table

#: The tables that the monthly fact is made of.
SOURCES = ("customer", "lineitem", "nation", "orders", "part", "region")
UNITS = ("IP_UNITS", "OP_UNITS", "PH_UNITS", "RX_UNITS")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: read_table(spark, sf_dir, n)
    place = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return t("orders").join(place, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        "o_custkey",
        F.col("r_name").alias("ENTY"),
        F.when(F.col("o_orderpriority").startswith("1-"), "MA DSNP").otherwise("MA").alias("PLAN_TYPE"),
        F.when(F.col("c_nationkey") % 2 == 0, "OHC").otherwise("OC").alias("SEGMENT"),
        F.trunc("o_orderdate", "month").alias("O_MONTH"),
    )


def claim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENTY, PLAN_TYPE, SEGMENT, MAJ_SRV_CAT, HCE_SRVC_CAT, MONTH, NET_AMT_COMP, UNITS and the line's keys."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    lines = read_table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    flag = F.col("l_returnflag")
    return lines.join(_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "ENTY",
        "PLAN_TYPE",
        "SEGMENT",
        F.when(F.col("p_type") == "PROMO", "RX").when(flag == "A", "IP").when(flag == "N", "OP").otherwise("PH").alias("MAJ_SRV_CAT"),
        F.col("l_linestatus").alias("HCE_SRVC_CAT"),
        F.trunc("l_shipdate", "month").alias("MONTH"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(MONEY).alias("NET_AMT_COMP"),
        F.col("l_quantity").cast(MONEY).alias("UNITS"),
        F.col("l_linenumber").alias("LINE"),
        "o_custkey",
    )


def raw_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed-grain fact: enrolment rows (``MBR``) with MBR_COUNT, claim rows with amounts and one unit column each."""
    keys = ["ENTY", "PLAN_TYPE", "SEGMENT"]
    claims = claim_lines(spark, sf_dir).select(
        *keys,
        "MAJ_SRV_CAT",
        "HCE_SRVC_CAT",
        F.date_format("MONTH", "yyyyMM").alias("YR_MO"),
        "NET_AMT_COMP",
        *[F.when(F.col("MAJ_SRV_CAT") == u[:2], F.col("UNITS")).otherwise(F.lit(0).cast(MONEY)).alias(u) for u in UNITS],
    )
    members = _orders(spark, sf_dir).groupBy(*keys, "O_MONTH").agg(F.count_distinct("o_custkey").alias("MBR_COUNT"))
    members = members.select(*keys, F.lit("MBR").alias("MAJ_SRV_CAT"), F.date_format("O_MONTH", "yyyyMM").alias("YR_MO"), "MBR_COUNT")
    return claims.unionByName(members, allowMissingColumns=True)


def member_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each member, place and month of enrolment: age group, sex and risk follow from the member's key."""
    k = F.col("o_custkey")
    rows = _orders(spark, sf_dir).select(F.col("ENTY").alias("MARKET"), "SEGMENT", F.col("O_MONTH").alias("DATE_REPORT_MONTH"), "o_custkey").distinct()
    age = F.element_at(F.array(F.lit("Pediatric"), F.lit("Adult"), F.lit("Senior")), (k % 3 + 1).cast("int"))
    return rows.select("MARKET", "SEGMENT", "DATE_REPORT_MONTH", age.alias("AGE_GROUP"), (k % 2).cast("int").alias("FEMALE"), (8 + k % 5).cast("decimal(4,0)").alias("RISK"), F.lit(1).cast("bigint").alias("MED_MM"))


def closes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Claims (close, month, plan, claim type, paid) and members (close, month, plan, months) at three closes.

    A line is paid LINE months after it was incurred; a close holds what was paid by its month.
    """
    lines = claim_lines(spark, sf_dir).select(
        F.last_day("MONTH").alias("incurred"),
        F.when(F.col("ENTY").isin("AFRICA", "AMERICA"), "HMO").otherwise("PPO").alias("plan_type"),
        F.when(F.col("MAJ_SRV_CAT") == "IP", "IP").otherwise("Non-IP").alias("claim_type"),
        F.last_day(F.add_months("MONTH", F.col("LINE"))).alias("paid_month"),
        F.col("NET_AMT_COMP").alias("paid"),
    )
    close = F.explode(F.array(*[F.lit(d).cast("date") for d in CLOSES])).alias("close")
    claims = lines.groupBy("incurred", "plan_type", "claim_type", "paid_month").agg(F.sum("paid").alias("paid")).select("*", close)
    claims = claims.where("paid_month <= close and incurred >= date'1999-01-31'").groupBy("close", "incurred", "plan_type", "claim_type").agg(F.sum("paid").cast(MONEY).alias("paid"))
    members = _orders(spark, sf_dir).select(F.last_day("O_MONTH").alias("incurred"), F.when(F.col("ENTY").isin("AFRICA", "AMERICA"), "HMO").otherwise("PPO").alias("plan_type"), "o_custkey")
    members = members.groupBy("incurred", "plan_type").agg(F.count_distinct("o_custkey").alias("member_months")).where("incurred >= date'1999-01-31'")
    members = members.select("*", close).where("incurred <= close")
    return claims, members


CLOSES = ("2000-10-31", "2000-11-30", "2000-12-31")
