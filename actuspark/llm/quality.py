"""Quality rules as a short-circuit cascade, with DataFrame functions only.

Each rule reads figures of a text, and each figure is an expression that costs nothing until it is
asked for. ``order_rules`` times every rule with its own figures on a bounded sample and counts what it
rejects there; ``cascade`` evaluates the rules in the order of rejections per cost: a ``CASE`` that
stops at the first rule that rejects, so that the figures of later rules are not measured for that row.
The order changes the time taken, never the verdict.

Defined cases: a null or blank text has no words and every figure is 0 (so the base rule on the
number of words rejects it); repeated rows are judged one by one; an empty table gives an empty
result; all added columns live in one struct whose name the caller chooses, and the names of working
columns are made to differ from those of the input, so none of its columns is lost. Texts of any length are read whole.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BLANKS, fresh_name, save

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: The sample on which costs and selectivities are estimated: its rows, the share of rows read for it, and the characters of its longest text.
SAMPLE_ROWS, SAMPLE_SHARE, SAMPLE_CHARS = 1000, 0.1, 50_000
#: Figures that are part of the result.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` makes a condition from a function that gives a measured figure by name."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


#: Rules that decide the base verdict.
BASE_RULES = (
    Rule("too_few_words", lambda f: f("n_words") < 50),
    Rule("repeated_windows", lambda f: 100 * f("n_repeat_words") > 50 * f("n_words")),
)
#: Further rules of the method. All are ratios of whole numbers, so that any engine agrees.
METHOD_RULES = (
    Rule("short_words", lambda f: f("word_chars") < 2 * f("n_words")),
    Rule("long_words", lambda f: f("word_chars") > 15 * f("n_words")),
    Rule("symbols", lambda f: 10 * f("n_symbols") > 3 * f("n_words")),
    Rule("repeated_lines", lambda f: 10 * f("n_dup_lines") > 3 * f("n_lines")),
    Rule("few_letters", lambda f: 10 * f("n_alpha_words") < 6 * f("n_words")),
)
RULES = BASE_RULES + METHOD_RULES


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, and only where the result is asked for."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(word: Column) -> Column:
    """Words that lie in a 3-word window found at least twice."""
    last = F.size(word) - 3
    # A window's hash with its place; equal windows meet when sorted.
    windows = F.array_sort(F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.xxhash64(word[i], word[i + 1], word[i + 2]).alias("h"), i.alias("p"))))

    def covered(s: Column) -> Column:
        met = lambda x, i: ((i > 0) & (s[F.greatest(i - 1, F.lit(0))]["h"] == x["h"])) | ((i < F.size(s) - 1) & (s[F.least(i + 1, F.size(s) - 1)]["h"] == x["h"]))
        return F.aggregate(
            F.array_sort(F.transform(F.filter(s, met), lambda x: x["p"])),
            F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
            lambda acc, p: F.struct((acc["n"] + (p + 3 - F.greatest(acc["end"], p))).alias("n"), (p + 3).alias("end")),
            lambda acc: acc["n"],
        )

    return F.when(last >= 0, _let(windows, covered)).otherwise(0)


def figures(text: Column, words: Column) -> dict[str, Column]:
    """The figures of a text and its words by name, each measured where it is used."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    out = {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(t, BLANKS, "")),
        "n_symbols": F.length(t) - F.length(F.translate(t, SYMBOLS, "")),
        # A line with a word, from its first word on.
        "n_lines": F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D][^\n]*")),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": _repeat_words(words),
        "n_alpha_words": F.regexp_count(t, F.lit(r"\p{L}[^\x20\x09-\x0D]*")),
    }
    return {k: c.cast("bigint") for k, c in out.items()}


def order_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by falling rejections per second, both estimated on at most ``sample_rows`` texts.

    A rule's cost is the time of its own figures; the words, which all rules need, are ready. The sample
    is a share of the rows that ``take`` reads, so only as many partitions are read as it needs, and
    leaves out texts of more than ``SAMPLE_CHARS`` characters, so its size is bounded. It only fixes the order of
    evaluation. Rules that tie keep their given order.
    """
    spark = df.sparkSession
    taken = df.select(F.col(text).alias("t")).sample(SAMPLE_SHARE, seed=9).where(F.length("t") <= SAMPLE_CHARS).take(sample_rows)
    if not taken:
        return list(rules)
    sample = spark.range(1).select(F.explode(F.array(*[F.lit(r["t"]) for r in taken])).alias("t")).withColumn("w", words_of(F.col("t")))
    # As a table, so that the plans of the rules do not hold the texts.
    sample = save(sample).persist()
    try:
        sample.count()
        fig = figures(F.col("t"), F.col("w")).__getitem__
        ranked = []
        for k, r in enumerate(rules):
            began = time.perf_counter()
            hits = sample.agg(F.count_if(r.rejects(fig)).alias("n")).first()["n"]
            ranked.append((-hits / max(time.perf_counter() - began, 1e-6), k, r))
    finally:
        sample.unpersist()
    return [r for _, _, r in sorted(ranked, key=lambda x: x[:2])]


def cascade(rules: list[Rule], figure: Callable[[str], Column]) -> Column:
    """False as soon as one rule rejects, else true; a rule's figures are asked for when its turn comes."""
    case = F.lit(True)
    for r in reversed(rules):
        case = F.when(r.rejects(figure), F.lit(False)).otherwise(case)
    return case


def quality(df: DataFrame, text: str = "text", into: str = "quality", verdict: str = "kept", rules: list[Rule] | None = None) -> DataFrame:
    """``df`` with the struct ``into`` of the ``BASE`` figures and the boolean ``verdict``; every row of the input is in the result.

    The base figures are measured for each row, as they are part of the result; those that only the
    verdict reads are measured where no earlier rule rejects. ``rules`` in a given order need no sample.
    """
    rules = order_rules(df, text) if rules is None else rules
    w, *ready = (fresh_name(df, f"{into}__{k}") for k in ("words", *BASE))
    own = figures(F.col(text), F.col(w))
    out = df.withColumn(w, words_of(F.col(text))).withColumns({c: own[k] for c, k in zip(ready, BASE, strict=True)})
    known = own | {k: F.col(c) for c, k in zip(ready, BASE, strict=True)}
    out = out.withColumns({into: F.struct(*[F.col(c).alias(k) for c, k in zip(ready, BASE, strict=True)]), verdict: cascade(rules, known.__getitem__)})
    return out.drop(w, *ready)


def keep(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that the rules keep, with its columns. No figure is measured that the verdict does not need.

    The row number beside the verdict (any number would do) keeps the optimizer from pushing the
    verdict's condition below the words, where each mention of them would split the text anew.
    """
    w, kept, row = (fresh_name(df, k) for k in ("__words", "__kept", "__row"))
    verdict = cascade(order_rules(df, text), figures(F.col(text), F.col(w)).__getitem__)
    judged = df.withColumn(w, words_of(F.col(text))).withColumns({kept: verdict, row: F.monotonically_increasing_id()})
    return judged.where(F.col(kept) & (F.col(row) >= 0)).select(*df.columns)
