"""Source divergence audit: how far each source of a language departs from the others, and by which terms.

Terms are runs of letters, A-Z lower-cased; a language keeps the terms of at least ``min_docs`` of its
documents. A group is a source within a language. Its smoothed share of a kept term, in units of 1e-9, is
p = 1 + floor(1e9 (count + 2) / (N + 2 V)), and two shares p and q diverge by floor((p - q)^2 / (p + q)).

``pairs`` sums the divergence over all kept terms for each two sources of a language. A term is a row
with the shares of the sources that have it; numpy fills in the share of an absent term and adds up
blocks of sources against all, so a task holds one block's sums. Sums of tasks are added by Spark.

``terms`` ranks the k terms by which a group exceeds its language most. The divergence grows with the
group's count and falls with the language's count, and equal values go by UTF-8 order, so a term that k
others dominate in all three (at least the count, at most the language's count, an earlier term) can't be among
the first k. Each partition keeps the terms that fewer than k of its own dominate (its k-skyband); the
skybands of a group are merged by the same pass and ranked exactly. The pass streams rows sorted by falling
count and rising language count: whatever dominates a term comes before it, and it needs only be compared
with the terms retained so far, since a term that is dropped has k retained dominators itself.

Shares are computed in decimals, as counts times 1e9 may exceed 64 bits.

Defined cases: null texts, languages and sources are empty strings; repeated rows count as often as they
occur; a language without kept terms has pairs of value 0 and no term rows; a source alone in its language
has no pairs; an empty table gives no rows; texts of any length are counted in pieces; other columns are
not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import LOWER_BYTES, byte_texts, save, ship, split_words

#: Lower-cases A-Z and turns every other ASCII byte that is no letter into a space.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in LOWER_BYTES)
#: Counts that a task holds before it emits them.
HELD = 300_000
#: Sources of a block that a task compares with all sources of their language.
BLOCK = 512
#: Shares in the dense table that is compared at once.
CELLS = 1 << 20


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10, k: int = 10) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank: all other sources of each group, and its first ``k`` terms."""
    groups, cells = shares(docs, lang, source, text, min_docs)
    parts = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, df in (("pair", pairs(groups, cells)), ("term", terms(cells, k)))]
    return parts[0].unionByName(parts[1])


def shares(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = 10) -> tuple[DataFrame, DataFrame]:
    """The groups (lang, source, no, n_sources, v, zero: the share of an absent term), and a row for each group and kept term that it has
    (lang, source, no, term, n, lang_n, p, q).
    """
    ship(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = save(rows.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = counted.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs")
    cells = save(counted.drop("docs").join(kept, ["lang", "term"]))
    langs = cells.dropDuplicates(["lang", "term"]).groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counted.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "v", "lang_total"])
    of_lang = Window.partitionBy("lang")
    groups = groups.withColumns({"no": F.row_number().over(of_lang.orderBy("source")) - 1, "n_sources": F.count(F.lit(1)).over(of_lang)})
    groups = save(groups.withColumn("zero", F.when(F.col("v") > 0, _share(F.lit(0), F.col("total"), F.col("v")))))
    cells = cells.join(groups, ["lang", "source"]).select("lang", "source", "no", "term", "n", "lang_n", _share(F.col("n"), F.col("total"), F.col("v")).alias("p"), _share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))
    return groups, save(cells)


def pairs(groups: DataFrame, cells: DataFrame, block: int = BLOCK) -> DataFrame:
    """lang, source, item (another source of the language), value and rank."""
    ship(groups.sparkSession)
    zeros = groups.where("v > 0").groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("no", "zero"))), lambda x: x["zero"]).alias("zeros"))
    rows = cells.groupBy("lang", "term").agg(F.collect_list(F.struct("no", "p")).alias("has")).join(zeros, "lang")
    rows = rows.withColumn("first", F.explode(F.expr(f"sequence(0, size(zeros) - 1, {block})"))).select("lang", "first", "zeros", F.col("has.no").alias("nos"), F.col("has.p").alias("ps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pair_sums(batches, block)

    sums = rows.sortWithinPartitions("lang", "first").mapInArrow(run, "lang string, a int, b int, value bigint").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"), "value").select("lang", "x.*", "value")
    name = lambda no, source: groups.select("lang", F.col("no").alias(no), F.col("source").alias(source))
    out = both.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"]).select("lang", "source", "item", "value")
    bare = groups.where("v = 0").select("lang", "source")
    bare = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("bigint"))
    return _ranked(out.unionByName(bare))


def terms(cells: DataFrame, k: int = 10) -> DataFrame:
    """lang, source, item (a term), value and rank of the first ``k`` terms by which each group exceeds its language."""
    ship(cells.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _skyband(batches, k)

    def skyband(df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions("lang", "source", F.desc("n"), "lang_n", "term").mapInArrow(run, df.schema)

    rows = skyband(cells.where("p > q").select("lang", "source", "term", "n", "lang_n", "p", "q"))
    rows = skyband(rows.repartition("lang", "source"))
    value = F.expr("((p - q) * (p - q)) div (p + q)")
    return _ranked(rows.select("lang", "source", F.col("term").alias("item"), value.alias("value"))).where(F.col("rank") <= k)


def _share(count: Column, total: Column, v: Column) -> Column:
    big = lambda c, digits: c.cast("bigint").cast(f"decimal({digits},0)")
    return F.call_function("div", big(F.lit(1_000_000_000), 10) * big(count + 2, 19), big(total + 2 * v, 19)) + 1


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group; a row without term for each group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), byte_texts(batch.column("text")), strict=True):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for words in split_words(text, LETTERS):
                n.update(words)
                seen.update(words)
            docs.update(seen)
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield _counts(held)
            held = {}
    if held:
        yield _counts(held)


def _counts(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
    langs, sources, names, ns, docs = [], [], [], [], []
    for (lang, source), (n, d) in held.items():
        size = len(n) + 1
        langs += [lang] * size
        sources += [source] * size
        names += [None, *n]
        ns += [0, *n.values()]
        docs += [0, *map(d.__getitem__, n)]
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(names, pa.binary()).cast(pa.string()), pa.array(ns, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])


def _pair_sums(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Divergences of the sources of a block against the sources after them, added up over the task's terms."""
    at, sums = None, np.zeros((0, 0), np.int64)

    def out() -> pa.RecordBatch:
        lang, first = at
        a, b = np.nonzero(np.arange(sums.shape[1])[None, :] > first + np.arange(len(sums))[:, None])
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array((a + first).astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(sums[a, b])], ["lang", "a", "b", "value"])

    for batch in batches:
        langs, firsts = batch.column("lang").to_pylist(), batch.column("first").to_pylist()
        i = 0
        while i < len(langs):
            here = (langs[i], firsts[i])
            zeros = np.array(batch.column("zeros")[i].as_py(), np.int64)
            j = i
            while j < len(langs) and (langs[j], firsts[j]) == here and j - i < max(1, CELLS // len(zeros)):
                j += 1
            if here != at:
                if at:
                    yield out()
                at, sums = here, np.zeros((min(block, len(zeros) - here[1]), len(zeros)), np.int64)
            nos, ps = batch.column("nos").slice(i, j - i), batch.column("ps").slice(i, j - i)
            table = np.tile(zeros, (j - i, 1))
            table[np.repeat(np.arange(j - i), nos.value_lengths().to_numpy()), nos.flatten().to_numpy()] = ps.flatten().to_numpy()
            for a in range(len(sums)):
                own, others = table[:, here[1] + a, None], table[:, here[1] + a + 1 :]
                gap = own - others
                sums[a, here[1] + a + 1 :] += (gap * gap // (own + others)).sum(axis=0)
            i = j
    if at:
        yield out()


def _skyband(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Of sorted rows, those that fewer than ``k`` rows of their group dominate."""
    at = None
    names: list[bytes] = []
    totals = np.zeros(64, np.int64)
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        rows = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("term").cast(pa.binary()).to_pylist(), batch.column("lang_n").to_pylist(), strict=True)
        for i, (lang, source, term, total) in enumerate(rows):
            if (lang, source) != at:
                at, names = (lang, source), []
            pos = bisect_left(names, term)
            if np.count_nonzero(totals[:pos] <= total) >= k:
                continue
            keep[i] = True
            if len(names) == len(totals):
                totals = np.concatenate((totals, np.zeros_like(totals)))
            totals[pos + 1 : len(names) + 1] = totals[pos : len(names)].copy()
            totals[pos] = total
            names.insert(pos, term)
        yield batch.filter(pa.array(keep))
