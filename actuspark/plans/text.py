"""Text analytics: cleaning, sentences, keywords, extractive summaries and mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.entities import unescape


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))


def html_to_text(c: Column) -> Column:
    """Text of a page: scripts and styles go, block tags break the line, the five basic entities are decoded."""
    out = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    out = F.regexp_replace(out, r"(?i)</?(p|div|br|li|h[1-6]|tr|article|section)[^>]*>", "\n")
    out = F.regexp_replace(out, r"<[^>]+>", " ")
    for entity, text in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(text))
    return squeeze(out)


def readable(c: Column) -> Column:
    """Text of a piece of HTML with its paragraphs: block ends break the line, every reference is decoded, two line ends at most."""
    out = F.regexp_replace(c, r"(?is)<(script|style).*?</\1>", " ")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</(p|div|li|h[1-6]|section|article)>", "\n")
    out = unescape(F.regexp_replace(out, r"<[^>]+>", " "))
    out = F.regexp_replace(F.regexp_replace(out, r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n")
    return F.regexp_replace(F.regexp_replace(out, r"[ \t]{2,}", " "), r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def article_text(c: Column) -> Column:
    """Title, an empty line, then the page's first main or article part, or all of a page without one; null for null."""
    title = readable(F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1))
    part = F.regexp_extract(c, r"(?is)<(main|article)[^>]*>(.*?)</\1>", 2)
    body = readable(F.when(F.regexp_like(c, F.lit(r"(?is)<(main|article)[^>]*>.*?</\1>")), part).otherwise(c))
    return F.when(F.regexp_like(c, F.lit(r"(?is)<title[^>]*>.*?</title>")), F.concat(title, F.lit("\n\n"), body)).otherwise(body)


def sentences(docs: DataFrame, key: str, text: str, least: int = 7) -> DataFrame:
    """key, pos, sentence: sentences of at least ``least`` words, in order."""
    parts = F.split(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"([.!?])\s+", "$1\n"), "\n")
    rows = docs.select(key, F.posexplode(parts).alias("pos", "raw")).select(key, "pos", squeeze(F.col("raw")).alias("sentence"))
    return rows.where(F.size(F.split("sentence", " ")) >= least)


def word_count(c: Column) -> Column:
    return F.when(squeeze(c) == "", 0).otherwise(F.size(F.split(squeeze(c), " ")))


def keyword_freq(docs: DataFrame, key: str, text: str, stop: list[str], least: int = 4) -> DataFrame:
    """key, word, n for lower-case words of at least ``least`` ASCII letters that are no stop words."""
    word = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(rf"[a-z]{{{least},}}"), F.lit(0)))
    return docs.select(key, word.alias("word")).where(~F.col("word").isin(*stop)).groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))


def top_words(freq: DataFrame, key: str, n: int = 30) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc("n"), "word")
    return freq.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def dictionary_mentions(docs: DataFrame, aliases: DataFrame, key: str, text: str) -> DataFrame:
    """Mentions of each name: words of the text that are one of its aliases (name, alias in lower case)."""
    word = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z]+"), F.lit(0)))
    return docs.select(key, word.alias("alias")).join(F.broadcast(aliases), "alias").groupBy(key, "name").agg(F.count(F.lit(1)).alias("n"))


def pattern_mentions(docs: DataFrame, key: str, text: str, pattern: str, stop: list[str], least: int) -> DataFrame:
    """Matches of a pattern that occur at least ``least`` times in a document."""
    hit = F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    return docs.select(key, hit.alias("name")).where(~F.col("name").isin(*stop)).groupBy(key, "name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def merge_mentions(key: str, *sources: tuple[str, DataFrame]) -> DataFrame:
    """One row for each document and name; earlier sources win."""
    out = None
    for k, (kind, df) in enumerate(sources):
        own = df.select(key, "name", "n", F.lit(kind).alias("kind"), F.lit(k).alias("_k"))
        out = own if out is None else out.unionByName(own)
    w = Window.partitionBy(key, F.lower("name")).orderBy("_k", F.desc("n"), "name")
    return out.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_k")


def top_mentions(mentions: DataFrame, key: str, n: int) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc("n"), "name")
    return mentions.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
