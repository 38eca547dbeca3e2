"""Fuzzy joins of titles: candidates by shared words, scores by matching blocks.

Two titles are candidates when the Dice coefficient of their sets of words reaches ``overlap`` per cent. They are found
by equal keys: words stand in the order of their document frequency, and titles of n and m words that share c of them
must meet within their first n - c + 1 and m - c + 1 words. c follows from both sizes, so the key holds a word
and the size classes of both titles; a word that most titles hold is last in that order and joins only titles so short that it alone
makes them candidates. Of titles that must share two words, frequent words are keys in pairs only (the second within the first n - c + 2).
A key of titles of less than 32 words carries the words, so the join itself drops what shares too few, and keeps a pair where the key is
the first that both share: what is shuffled follows the number of titles, not that of the pairs that meet. Longer titles
have keys of one word without the words; their pairs are made distinct and checked after.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes below this are classes of their own; above, a class is all sizes with the same number of binary digits.
EXACT_SIZES = 4
#: Titles up to which a word is a key by itself wherever it stands.
ALONE = 64
#: The last size class (16 to 31 words) whose keys carry words and hold two: both grow with the square of a title's words.
SHORT = EXACT_SIZES - 3 + 5


def normal_title(c: Column) -> Column:
    """Lower case, runs of anything but ASCII letters and digits as one blank; null without such characters."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")), F.lit(""))


def blocks_ratio(a: Column, b: Column) -> Column:
    """2 M / (characters of both), M: characters in the longest matching blocks, found again and again left and right of each."""

    def ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        from difflib import SequenceMatcher

        for left, right in pairs:
            yield pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(left, right, strict=True)], dtype="float64")

    # Else the optimizer runs it twice, for a filter and for the column.
    return F.pandas_udf(ratio, "double").asNondeterministic()(a, b)


def _size_class(n: Column) -> Column:
    return F.when(n < EXACT_SIZES, n.cast("int")).otherwise(EXACT_SIZES - 3 + F.length(F.bin(n.cast("bigint")))).cast("int")


def _class_floor(c: Column) -> Column:
    return F.when(c < EXACT_SIZES, c.cast("double")).otherwise(F.pow(F.lit(2.0), c - EXACT_SIZES + 2))


def _keys(titles: DataFrame, overlap: int, own: str, other: str, rare: str = "size(words)") -> DataFrame:
    """word (or two), own class, class of the partner, and the title's columns: a row for each key in the prefix that a partner of that class needs; the first ``rare`` words are keys alone."""
    n = F.size("words")
    least = F.ceil(n * overlap / (200 - overlap))
    most = F.floor(n * (200 - overlap) / overlap)
    spread = titles.withColumns({"_rare": F.expr(rare), own: _size_class(n), "_least": least}).select("*", F.explode(F.sequence(_size_class(least), _size_class(most))).alias(other))
    shared = F.ceil(overlap * (n + F.greatest(_class_floor(F.col(other)), F.col("_least").cast("double"))) / 200)
    # A class that holds no size as small as needed has a floor above the title's own size at most; then the prefix is one word.
    prefix = F.greatest(n - shared + 1, F.lit(1)).cast("int")
    # Both sides see from the classes alone whether all partners share two words and are short.
    two = (overlap * (_class_floor(F.col(own)) + _class_floor(F.col(other))) > 200) & (F.greatest(own, other) <= SHORT)
    single = F.when(two, F.least("_rare", "_prefix")).otherwise(F.col("_prefix"))
    after = lambda i: F.slice("words", i + 1, F.least(n, F.col("_prefix") + 1) - i)
    twos = F.flatten(F.transform(F.filter(F.sequence(F.lit(1), "_prefix"), lambda i: i > F.col("_single")), lambda i: F.transform(after(i), lambda w: F.concat_ws(" ", F.element_at("words", i), w))))
    keyed = spread.withColumn("_prefix", prefix).withColumn("_single", single)
    return keyed.select(*titles.columns, own, other, F.explode(F.concat(F.slice("words", F.lit(1), F.col("_single")), twos)).alias("word"))


def title_pairs(left: DataFrame, right: DataFrame, overlap: int = 50, alone: int = ALONE) -> DataFrame:
    """l, r, l_title, r_title: the candidates of two frames of different titles (id, title); no pair comes twice."""
    if not 0 < overlap <= 100:
        raise ValueError("overlap is a percentage above 0")
    word = F.explode(F.array_distinct(F.split("title", " "))).alias("word")
    words = left.select(F.lit("l").alias("side"), "id", word).unionByName(right.select(F.lit("r").alias("side"), "id", word))
    # A title on both sides counts twice, which changes the order alone.
    held = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    order = F.sort_array(F.collect_list(F.struct("n", "word"))).alias("order")
    ranked = words.join(held, "word").groupBy("side", "id").agg(order)
    ranked = ranked.select("side", "id", F.col("order.word").alias("words"), F.size(F.filter("order", lambda x: x["n"] <= alone)).alias("rare"))
    sides = {s: _keys(ranked.where(F.col("side") == s).drop("side"), overlap, f"{s}_class", f"{o}_class", "rare").drop("rare").withColumnsRenamed({"id": s, "words": f"{s}_words"}) for s, o in ("lr", "rl")}
    a, b = sides["l"].alias("a"), sides["r"].alias("b")
    common = F.array_intersect("l_words", "r_words")
    enough = 200 * F.size(common) >= overlap * (F.size("l_words") + F.size("r_words"))
    first = F.col("a.word").isin(F.get(common, F.lit(0)), F.concat_ws(" ", F.slice(common, 1, 2)))
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("word", "l_class", "r_class")]
    short = F.greatest("l_class", "r_class") <= SHORT
    met = a.where(short).join(b.where(short), same[0] & same[1] & same[2] & enough & first).select("l", "r")
    long = [df.where(~short).drop(f"{s}_words") for s, df in (("l", a), ("r", b))]
    met = met.unionByName(long[0].join(long[1], ["word", "l_class", "r_class"]).select("l", "r").distinct())
    for s, df in (("l", left), ("r", right)):
        met = met.join(df.select(F.col("id").alias(s), F.col("title").alias(f"{s}_title"), F.array_distinct(F.split("title", " ")).alias(f"{s}_words")), s)
    return met.where(enough).select("l", "r", "l_title", "r_title")


def fuzzy_match(left: DataFrame, right: DataFrame, left_title: str, right_title: str, threshold: float = 0.38, overlap: int = 50) -> DataFrame:
    """Each left row with the right row of the best title and their ``score``, if a candidate reaches the threshold.

    Equal normalised titles are compared once. The best score wins, then the normalised title that sorts first, then the right
    row that sorts first by title and then its other columns, which therefore need an order. Left rows without
    a match, without letters and digits or with a null title have no row; repeated left rows stay. Very long titles are
    compared whole. Both sides' columns must differ in name.
    """
    if clash := {c.lower() for c in left.columns} & {c.lower() for c in right.columns}:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    key = lambda df, c: df.withColumn("_title", normal_title(F.col(c))).where("_title is not null").withColumn("_id", F.unhex(F.sha2("_title", 256)))
    rows, others = key(left, left_title), key(right, right_title)
    names = [right_title, *[c for c in right.columns if c != right_title]]
    first = others.groupBy("_id").agg(F.first("_title").alias("_title"), F.min(F.struct(*[F.col(f"`{c}`") for c in names])).alias("_row"))
    titles = lambda df: df.select(F.col("_id").alias("id"), F.col("_title").alias("title"))
    pairs = title_pairs(titles(rows.dropDuplicates(["_id"])), titles(first), overlap)
    a, b = F.length("l_title"), F.length("r_title")
    scored = pairs.where(2 * F.least(a, b) >= threshold * (a + b)).withColumn("score", blocks_ratio(F.col("l_title"), F.col("r_title")))
    best = scored.where(F.col("score") >= threshold).groupBy("l").agg(F.min(F.struct((-F.col("score")).alias("s"), "r_title", "r")).alias("_best"))
    out = rows.join(best.withColumnRenamed("l", "_id"), "_id").select(*[F.col(f"`{c}`") for c in left.columns], "_best")
    out = out.join(first.select(F.col("_id").alias("_other"), "_row"), F.col("_best.r") == F.col("_other"))
    return out.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"_row.`{c}`") for c in right.columns], (-F.col("_best.s")).alias("score"))
