"""Transcript reports: sentences, extractive summaries, and mentions of companies with their contexts.

Texts are split once into pieces (words and what stands between them). A phrase of the dictionary is found by an
equi-join of words with the first words of aliases and one comparison of the pieces that follow, so aliases may
have several words and the dictionary any size; a dictionary of at most ``MOST_SENT`` rows goes to the texts, so that no word
that isn't met is shuffled. Of matches within a longer one only the longer counts. Words are
letters, digits and underscores of any script; tickers are bounded by ASCII letters and digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import squeeze

#: Words without topic, words that mark a conclusion, capitals that are no ticker, endings of company names, and words that no name begins with (fixed values).
STOPWORDS = """about after again against also because before being between could doing first going have into just like look make market more much people really right
said should some something than that their there these thing think this those through very want what when where which with would years""".split()
SIGNAL_WORDS = """acquisition ai capital company competition consumer cost crypto data earnings economy enterprise growth inflation ipo jobs market margin model policy
private public rate regulation revenue risk startup stock technology valuation""".split()
STOP_TICKERS = "AI API CEO CFO CPI CRM CTO DC DOJ EU EV FTC GDP GPU IPO LLM NASA SEC SPAC TV UK US USA VC".split()
COMPANY_SUFFIXES = "AI Bank Capital Cloud Corp Energy Financial Holdings Labs Media Networks Partners Robotics Semiconductor Software Technologies Ventures".split()
NO_FIRST_WORDS = "and but for from that the this with".split()

#: Rows up to which a dictionary is broadcast; a larger one is joined by shuffles.
MOST_SENT = 200_000

WORD = r"[\p{L}\p{N}_]+"
PIECE = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"
STAMP = r" (\(?[0-9]{1,2}:[0-9]{2})"
SENTENCE_END = r"([.!?]) ([A-Z0-9\"'(\[])"
TICKER_LIKE = r"(^|[^\p{L}\p{N}_])[A-Z]{2,5}(\.[A-Z])?([^\p{L}\p{N}_]|$)"
TICKER_TOKEN = r"[A-Za-z0-9]+(?:\.[A-Z]\b)?"
CAPITALISED = r"\b[A-Z][A-Za-z0-9&.-]+(?: [A-Z][A-Za-z0-9&.-]+){0,3}\b"


def every(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def _beside(dictionary: DataFrame) -> DataFrame:
    return F.broadcast(dictionary) if dictionary.limit(MOST_SENT + 1).count() <= MOST_SENT else dictionary


def sentences(docs: DataFrame, key: str, text: str, least: int = 7) -> DataFrame:
    """key, pos, sentence: a time stamp begins a sentence, and so does a capital, digit, quote or bracket after a full stop; shorter ones than ``least`` words go."""
    marked = F.regexp_replace(squeeze(F.coalesce(F.col(text), F.lit(""))), STAMP, r". $1")
    parts = F.split(F.regexp_replace(marked, SENTENCE_END, "$1\n$2"), "\n")
    return docs.select(key, F.posexplode(parts).alias("pos", "sentence")).where(F.size(F.split("sentence", " ")) >= least)


def shorten(c: Column, width: int) -> Column:
    """``c``, cut before the last word that fits with three dots."""
    return F.when(F.length(c) <= width, c).otherwise(F.concat(F.regexp_extract(F.substring(c, 1, width - 2), r"(?s)^(.*) ", 1), F.lit("...")))


def compress(c: Column, speakers: list[str], width: int = 280) -> Column:
    """A sentence without its speaker's name, shortened."""
    names = "|".join([*speakers, "Speaker [0-9]+"])
    return shorten(F.regexp_replace(c, rf"(?i)^({names})[: \-]+", ""), width)


def top_words(docs: DataFrame, key: str, text: str, stop: list[str], n: int = 30) -> DataFrame:
    """key and top: the ``n`` most frequent words of four or more ASCII letters with their counts; of equal counts the ones that come first."""
    word = F.posexplode(every(F.lower(squeeze(F.coalesce(F.col(text), F.lit("")))), WORD)).alias("at", "word")
    counted = docs.select(key, word).where(F.col("word").rlike("^[a-z]{4,}$") & ~F.col("word").isin(*stop)).groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("at"))
    w = Window.partitionBy(key).orderBy(F.desc("n"), "at")
    return counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).groupBy(key).agg(F.collect_list(F.struct("word", F.least("n", F.lit(7)).alias("points"))).alias("top"))


def summaries(docs: DataFrame, key: str, text: str, stop: list[str] = STOPWORDS, signals: list[str] = SIGNAL_WORDS, speakers: list[str] = [], most: int = 6) -> DataFrame:
    """key, pos, rank, score, sentence: the best sentences, min(most, max(3, sentences / 35)) of each document; of equal scores the later.

    A sentence scores the counts (7 at most) of the top words that it contains, 5 for each signal word and 4 for capitals like a ticker,
    less in proportion beyond 180 characters.
    """
    sents = sentences(docs, key, text).join(top_words(docs, key, text, stop), key, "left")
    low = F.lower("sentence")
    top = F.coalesce("top", F.array().cast("array<struct<word:string,points:bigint>>"))
    # An outer function of one element, so that a sentence is lowered once and not for each word.
    held = F.get(F.transform(F.array(low), lambda c: F.aggregate(top, F.lit(0).cast("bigint"), lambda s, t: s + F.when(F.contains(c, t["word"]), t["points"]).otherwise(0))), F.lit(0))
    marked = 5 * F.size(F.array_intersect(every(low, WORD), F.array(*[F.lit(s) for s in signals])))
    capitals = F.when(F.col("sentence").rlike(TICKER_LIKE), 4).otherwise(0)
    score = F.round((held + marked + capitals) / F.greatest(F.lit(1.0), F.length("sentence") / 180.0), 6)
    w = Window.partitionBy(key)
    k = F.least(F.lit(most), F.greatest(F.lit(3), F.bround(F.count(F.lit(1)).over(w) / 35).cast("int")))
    ranked = sents.select(key, "pos", "sentence", score.alias("score"), k.alias("k")).withColumn("rank", F.row_number().over(w.orderBy(F.desc("score"), F.desc("pos"))))
    return ranked.where(F.col("rank") <= F.col("k")).select(key, "pos", "rank", "score", compress(F.col("sentence"), speakers).alias("sentence"))


def phrase_hits(units: DataFrame, keys: list[str], text: str, aliases: DataFrame) -> DataFrame:
    """keys, at, name: matches of aliases (name, alias), whatever their case, between word boundaries; none within a longer one.

    An alias of several names counts for the first of them.
    """
    split = aliases.withColumn("phrase", F.lower("alias")).groupBy("phrase").agg(F.min("name").alias("name")).withColumn("words", every(F.col("phrase"), WORD)).where(F.size("words") > 0)
    split = split.select("name", "phrase", F.element_at("words", 1).alias("word"), F.size("words").alias("n"), (2 * F.size("words") - 1).alias("span"))
    most = split.agg(F.coalesce(F.max("span"), F.lit(1)).alias("m")).first()["m"]
    pieces = every(F.lower(F.coalesce(F.col(text), F.lit(""))), PIECE)
    starts = F.filter(F.sequence(F.lit(1), F.size("pieces")), lambda i: F.element_at("pieces", i).rlike(f"^{WORD}"))
    tails = F.transform(starts, lambda i, k: F.struct(k.alias("at"), F.element_at("pieces", i).alias("word"), F.slice("pieces", i, F.lit(most)).alias("tail")))
    words = units.select(*keys, pieces.alias("pieces")).where(F.size("pieces") > 0).select(*keys, F.explode(tails).alias("t")).select(*keys, "t.*")
    met = words.join(_beside(split), "word").where(F.array_join(F.slice("tail", F.lit(1), F.col("span")), "") == F.col("phrase"))
    before = Window.partitionBy(*keys).orderBy("at", F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    longer = F.coalesce(F.max(F.col("at") + F.col("n")).over(before) >= F.col("at") + F.col("n"), F.lit(False))
    return met.withColumn("longer", longer).where("not longer").select(*keys, "at", "name")


def hits(units: DataFrame, keys: list[str], text: str, companies: DataFrame, stop_tickers: list[str], people: list[str]) -> DataFrame:
    """keys, kind (0 dictionary, 1 ticker, 2 phrase), at, name, ticker: every mention, before counts and precedence.

    ``companies``: name, ticker (or null), aliases (an array).
    """
    known = companies.where("ticker is not null").groupBy("ticker").agg(F.min("name").alias("company"))
    own_ticker = _beside(companies.select("name", "ticker").dropDuplicates(["name"]))
    phrases = phrase_hits(units, keys, text, companies.select("name", F.explode("aliases").alias("alias"))).join(own_ticker, "name")
    tokens = units.select(*keys, F.posexplode(every(F.coalesce(F.col(text), F.lit("")), TICKER_TOKEN)).alias("at", "ticker")).where(F.col("ticker").rlike(r"^[A-Z]{2,5}(\.[A-Z])?$"))
    tickers = tokens.join(_beside(known), "ticker", "left").where(F.col("company").isNotNull() | ~F.col("ticker").isin(*stop_tickers))
    caps = units.select(*keys, F.posexplode(every(F.coalesce(F.col(text), F.lit("")), CAPITALISED)).alias("at", "raw")).withColumn("name", F.regexp_replace("raw", r"^[ .,:;!?()\[\]]+|[ .,:;!?()\[\]]+$", ""))
    parts = F.split("name", " ")
    likely = (F.size(parts) >= 2) | F.element_at(parts, -1).isin(*COMPANY_SUFFIXES)
    own = (F.length("name") >= 4) & (F.col("name") != F.upper("name")) & likely & ~F.lower(F.element_at(parts, 1)).isin(*NO_FIRST_WORDS) & ~F.lower("name").isin(*people)
    none = F.lit(None).cast("string").alias("ticker")
    row = lambda df, kind, *c: df.select(*keys, kind.alias("kind"), "at", *c)
    return (
        row(phrases, F.lit(0), "name", "ticker")
        .unionByName(row(tickers, F.when(F.col("company").isNull(), 1).otherwise(0), F.coalesce("company", "ticker").alias("name"), "ticker"))
        .unionByName(row(caps.where(own), F.lit(2), "name", none))
    )


def mentions(docs: DataFrame, key: str, text: str, companies: DataFrame, stop_tickers: list[str] = STOP_TICKERS, people: list[str] = ["all in"], most: int = 25, contexts: int = 2) -> DataFrame:
    """key, rank, name, ticker, n, confidence, source, contexts: the most frequent mentions of each document with the first sentences that hold them, cut at 220 characters.

    The dictionary comes before tickers, tickers before phrases; a phrase needs two occurrences.
    """
    clean = docs.select(key, squeeze(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    found = hits(clean, [key], "text", companies, stop_tickers, people).groupBy(key, "kind", F.lower("name").alias("low"))
    counted = found.agg(F.count(F.lit(1)).alias("n"), F.max_by("name", "at").alias("name"), F.max("ticker").alias("ticker")).where("kind < 2 or n >= 2")
    first = F.row_number().over(Window.partitionBy(key, "low").orderBy("kind"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "low"))
    top = counted.withColumn("_first", first).where("_first = 1").withColumn("rank", rank).where(F.col("rank") <= most).drop("_first")
    # A hit carries its shortened sentence, and only the first ones of a mention are shuffled, so the sentences themselves are not.
    sents = sentences(docs, key, text).withColumn("short", shorten(F.col("sentence"), 220))
    seen = hits(sents, [key, "pos", "short"], "sentence", companies, stop_tickers, people).select(key, "pos", "short", "kind", F.lower("name").alias("low"))
    seen = seen.withColumn("k", F.dense_rank().over(Window.partitionBy(key, "kind", "low").orderBy("pos"))).where(F.col("k") <= contexts)
    shown = seen.groupBy(key, "kind", "low").agg(F.array_sort(F.collect_set(F.struct("pos", F.col("short").alias("sentence")))).alias("contexts"))
    confidence = F.when(F.col("kind") == 0, "high").when((F.col("kind") == 1) & (F.col("n") > 1), "medium").otherwise("low")
    source = F.element_at(F.array(F.lit("known aliases"), F.lit("ticker pattern"), F.lit("capitalized phrase heuristic")), F.col("kind") + 1)
    sentence = F.transform(F.coalesce("contexts", F.array().cast("array<struct<pos:int,sentence:string>>")), lambda c: c["sentence"])
    return top.join(shown, [key, "kind", "low"], "left").select(key, "rank", "name", "ticker", "n", confidence.alias("confidence"), source.alias("source"), sentence.alias("contexts"))


def report(docs: DataFrame, key: str, text: str, companies: DataFrame, least_words: int = 200, **options) -> DataFrame:
    """key, n_words, enough (whether the text has ``least_words`` words), summary (sentences in reading order) and mentions (ranked), nested: a row for each document, to be written as JSON."""
    words = F.size(every(F.coalesce(F.col(text), F.lit("")), r"[\p{L}\p{N}_'-]+")).alias("n_words")
    told = summaries(docs, key, text, **options).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "score", "sentence"))).alias("summary"))
    named = mentions(docs, key, text, companies).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "name", "ticker", "n", "confidence", "source", "contexts"))).alias("mentions"))
    return docs.select(key, words).withColumn("enough", F.col("n_words") >= least_words).join(told, key, "left").join(named, key, "left")
