"""URL filters by hashed host-suffix and path-prefix expressions.

Each URL is expanded into the expressions that a rule could be: a suffix of the host's labels
followed by a prefix of the path. Only label counts and path lengths that occur in the rules are
made, so the expansion is complete for every rule and small. Expressions meet rules by an equi-join
on the first characters of their digest; the full digest confirms, and the longest rule wins (then
the longer host, then the rule that sorts first).

Defined cases: a null URL, or one without ``://``, has an empty host and path and meets no rule, so
it gets the method's default verdict; repeated rows stay repeated; rules with a null host or path
never fit; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import lower_ascii

#: Rules up to this number are broadcast; more are joined by a shuffle.
BROADCAST_RULES = 100_000
PREFIX = 8


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path as the filters read them."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return lower_ascii(raw), F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)


def classify(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """key, host, path, rule, verdict for each row of ``pages``; ``rules`` has host, path, verdict."""
    host, path = url_parts(F.col("u"))
    rules = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        lower_ascii(F.col("host")).alias("rule_host"), F.concat(lower_ascii(F.col("host")), F.col("path")).alias("rule"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")
    )
    shapes = rules.agg(
        F.collect_set(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.collect_set(F.length("rule_path")).alias("lengths"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    labels = F.array(*[F.lit(x) for x in sorted(shapes["labels"])]).cast("array<int>")
    lengths = F.array(*[F.lit(x) for x in sorted(shapes["lengths"])]).cast("array<int>")
    digest = lambda c: F.sha2(c, 256)
    book = rules.select("rule", "rule_host", "rule_verdict", digest(F.col("rule")).alias("rule_digest")).withColumn("short", F.substring("rule_digest", 1, PREFIX))
    if shapes["n"] <= BROADCAST_RULES:
        book = F.broadcast(book)
    # Equal rows are counted first, so a hot URL is one row before it is expanded.
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u")).groupBy("k", "u").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumns({"host": host, "path": path})
    suffixes = F.transform(F.filter(labels, lambda n: n <= F.size(F.split("host", r"\."))), _suffix)
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substr(F.col("path"), F.lit(1), n))
    made = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    spread = rows.withColumn("expression", F.explode_outer(made)).withColumn("digest", digest(F.col("expression"))).withColumn("short", F.substring("digest", 1, PREFIX))
    met = spread.join(book, "short", "left").withColumn("fits", F.coalesce(F.col("digest") == F.col("rule_digest"), F.lit(False)))
    rank = F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("h"), F.col("rule"), F.col("rule_verdict"))
    best = met.groupBy("k", "u", "host", "path", "copies").agg(F.max(F.when(F.col("fits"), rank)).alias("best"))
    return best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.col("k").alias(key), "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.rule_verdict"), F.lit(default)).alias("verdict")
    )


def _suffix(n: Column) -> Column:
    parts = F.split("host", r"\.")
    return F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")
