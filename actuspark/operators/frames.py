"""Joins, reshapes and set operations of the health-cost plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def calendar(spark: SparkSession, start: str, end: str, step: str = "day") -> DataFrame:
    """One row ``day`` for each step from start to end."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"interval 1 {step}"))).alias("day"))


def restrict_to_exposure(keys: DataFrame, exposure: DataFrame, on: list[str]) -> DataFrame:
    """Observed keys for each month with exposure; the exposure brings the months, so no product is made."""
    return keys.distinct().join(exposure, on)


def attach_facts(spine: DataFrame, facts: DataFrame, on: list[str], measures: list[str]) -> DataFrame:
    out = spine.join(facts, on, "left")
    return out.withColumns({m: F.coalesce(m, F.lit(0).cast(facts.schema[m].dataType)) for m in measures})


def densify(facts: DataFrame, exposure: DataFrame, split: list[str], enrol: list[str], month: str, measures: list[str]) -> DataFrame:
    """A row for each observed split and month with exposure within the facts' months, zero where there are no facts."""
    bounds = facts.agg(F.min(month).alias("_first"), F.max(month).alias("_last"))
    spine = restrict_to_exposure(facts.select(*split), exposure, enrol)
    spine = spine.join(F.broadcast(bounds), F.col(month).between(F.col("_first"), F.col("_last"))).drop("_first", "_last")
    return attach_facts(spine, facts, [*split, month], measures)


def orphans(facts: DataFrame, exposure: DataFrame, on: list[str]) -> DataFrame:
    return facts.join(exposure, on, "left_anti")


def reachable(exposure: DataFrame, splits: DataFrame, on: list[str]) -> DataFrame:
    return exposure.join(splits, on, "left_semi")


def assert_unique_right(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` itself; raises if a key repeats, so that a join on it cannot multiply rows."""
    if not df.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"rows repeat on {keys}")
    return df


def enrich(df: DataFrame, dims: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    for dim, keys in dims:
        df = df.join(assert_unique_right(dim, keys), keys, "left")
    return df


def complete_groups(df: DataFrame, keys: list[str], month: str, n: int) -> DataFrame:
    """The rows of groups with ``n`` different months."""
    full = df.groupBy(*keys).agg(F.count_distinct(month).alias("_n")).where(F.col("_n") == n)
    return df.join(full.select(*keys), keys, "left_semi")


def decode(df: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    """A label for each id, the id itself where the dictionary has none."""
    return df.join(dim.select(key, label), key, "left").withColumn(label, F.coalesce(label, F.col(key).cast("string")))


def nearest_by_date(left: DataFrame, right: DataFrame, left_date: str, right_date: str, keys: list[str], on: list[str], days: int = 3) -> DataFrame:
    """Each left row with the nearest right row within ``days``; earlier dates, then all right columns, break ties.

    Right rows are copied to each day of their window, so the join is on equal keys and days.
    """
    spread = right.withColumn("_day", F.explode(F.sequence(F.date_sub(right_date, days), F.date_add(right_date, days))))
    met = left.withColumn("_day", F.col(left_date)).join(spread, [*on, "_day"]).drop("_day")
    w = Window.partitionBy(*keys).orderBy(F.abs(F.datediff(left_date, right_date)), right_date, *[c for c in right.columns if c not in on])
    return met.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def search_titles(df: DataFrame, title: str, query: str) -> DataFrame:
    """Titles that hold the query; where there are none, titles that hold all of its words."""
    low, q = F.lower(title), query.lower()
    tier = F.when(low.contains(q), 1).when(F.forall(F.split(F.lit(q), " "), lambda w: F.contains(low, w)), 2)
    hits = df.withColumn("tier", tier).where("tier is not null")
    return hits.join(F.broadcast(hits.agg(F.min("tier").alias("tier"))), "tier")


def append(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def dedup(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def dedup_sum(df: DataFrame, keys: list[str], out: list[str], measure: str) -> DataFrame:
    """Sum of a measure that repeats within ``keys``, by ``out``."""
    return df.select(*keys, measure).dropDuplicates(keys).groupBy(*out).agg(F.sum(measure).alias(measure))


def sum_numeric(df: DataFrame, keys: list[str]) -> DataFrame:
    kinds = ("int", "bigint", "double", "float", "smallint", "tinyint")
    cols = [c for c, k in df.dtypes if c not in keys and (k in kinds or k.startswith("decimal"))]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols])


def bucket_sums(df: DataFrame, keys: list[str], measure: str, rules: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(F.when(rule, F.col(measure)).otherwise(0)).alias(n) for n, rule in rules.items()])


def shares(df: DataFrame, buckets: list[str], total: str) -> DataFrame:
    return df.withColumns({f"{b}_share": F.try_divide(F.col(b).cast("double"), F.col(total).cast("double")) for b in buckets})


def constant_in_group(df: DataFrame, keys: list[str], c: str) -> DataFrame:
    """The one value of each group; raises where a group has several."""
    out = df.groupBy(*keys).agg(F.max(c).alias(c), F.min(c).alias("_low"))
    if not out.where(F.col(c) != F.col("_low")).isEmpty():
        raise ValueError(f"{c} differs within {keys}")
    return out.drop("_low")


def unpivot_months(df: DataFrame, keys: list[str], months: list[str], name: str = "month", value: str = "factor") -> DataFrame:
    return df.unpivot(keys, months, name, value)


def gap_diagnostics(df: DataFrame, keys: list[str], month: str) -> DataFrame:
    """First and last month, months seen, and months missing in between."""
    index = lambda c: F.year(c) * 12 + F.month(c)
    out = df.groupBy(*keys).agg(F.min(month).alias("first_month"), F.max(month).alias("last_month"), F.count_distinct(month).alias("n_months"))
    return out.withColumn("n_gaps", (index(F.col("last_month")) - index(F.col("first_month")) + 1 - F.col("n_months")).cast("bigint"))
