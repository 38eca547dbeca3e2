"""Ranked lexical search: the best documents for each item, by integer impacts, with pruning by norms.

A document's score for an item is the sum over the item's terms of weight times impact, all in 64-bit
integers. Weighted by the roots of the term weights, documents and items are vectors whose inner product is
that score, so a length bounds it. After the method of retrieving large entries of a product of matrices:

1. Each document becomes a sparse vector of impacts on the terms of the items, saved in the order of length,
   longest first. Parquet's statistics then let a later scan leave out what is too short.
2. The longest documents (``HEAD`` of all) are ranked first; an item's k-th best score there bounds its
   result from below.
3. The rest, as far as its length can reach some item's bound (Cauchy-Schwarz, a filter that the scan
   takes), is read in buckets of ``BUCKET`` vectors of similar length. A bucket that can't reach an item's
   bound by its longest vector is skipped; inside, the item's coordinates are added up by falling
   contribution until what is left, bounded by the bucket's largest impacts, is small, and a document whose sum
   and rest (the smaller one of that bound and the Cauchy-Schwarz bound of the rest) can't reach the
   bound is dropped. The others are scored exactly in integers, and a task's bound rises as it goes.
4. A task returns its k best of each item; Spark ranks these.

Items are handled in blocks of at most ``BLOCK_WORDS`` words (or one longer item): what is broadcast (the terms of
a block, their weights, bounds) does not grow with documents or items; each block scans the documents once.

Defined cases: a null text has no terms; documents without terms are not counted and never found; items
without terms have no rows; equal rows of items count once, and different texts of one id count as one
text; a null item id is an id of its own; repeated rows of documents are ranked each; equal scores go by the
smaller document id, and a null id comes last; empty tables give no rows; texts of any length are read in pieces;
other columns are not read. Document ids must be whole numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import LOWER_BYTES, byte_texts, save, ship, split_words, whole_key

#: Lower-cases A-Z and turns every other ASCII byte that is no letter or digit into a space.
NORMAL = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in LOWER_BYTES)
#: Words of the items of a block.
BLOCK_WORDS = 100_000
#: Documents of a bucket.
BUCKET = 4096
#: Share of the documents, the longest ones, that is ranked first.
HEAD = 0.02
#: Bounds are compared in doubles; this leaves room for their rounding.
SLACK = 1 + 1e-9


def rank(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    ship(spark)
    kind = items.schema[item_key].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for block in _blocks(items, item_key, item_text, block_words):
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], f"q int, item_id {kind}")
        best = _rank_block(docs.select(whole_key(docs, key).alias("k"), F.col(text).cast("string").alias("text")), [terms for _, terms in block], k)
        out = out.unionByName(best.join(F.broadcast(names), "q").select("item_id", "rank", F.col("k").alias("doc_id"), "score"))
    return out


def _blocks(items: DataFrame, key: str, text: str, limit: int) -> Iterator[list[tuple[object, Counter]]]:
    """Items with the counts of their terms, a block at a time."""
    rows = items.select(F.col(key).alias("i"), F.col(text).cast("string").alias("t")).distinct().orderBy("i", "t")
    block: list[tuple[object, Counter]] = []
    size = 0
    for r in rows.toLocalIterator():
        terms = Counter(w for words in split_words((r["t"] or "").encode(), NORMAL) for w in words)
        if block and block[-1][0] == r["i"]:
            block[-1][1].update(terms)
        else:
            if block and size + terms.total() > limit:
                yield block
                block, size = [], 0
            block.append((r["i"], terms))
        size += terms.total()
    if block:
        yield block


def _rank_block(docs: DataFrame, items: list[Counter], k: int) -> DataFrame:
    """q (the item's position), rank, k and score."""
    spark = docs.sparkSession
    codes = {w: i for i, w in enumerate(sorted({w for terms in items for w in terms}))}
    found = save(_vectors(docs, codes))
    total = found.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    df = np.zeros(len(codes), np.int64)
    for r in found.select(F.explode("ids").alias("id")).groupBy("id").count().toLocalIterator():
        df[r["id"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()], np.int64)
    queries = [(np.array([codes[w] for w in terms], np.int64), np.array(list(terms.values()), np.int64)) for terms in items]
    lengths = np.array([math.sqrt(float((weights[ids] * times * times).sum())) for ids, times in queries])

    placed = save(_impacts(found.where(F.size("ids") > 0), weights, total["n"], max(total["l"], 1)).repartitionByRange(F.desc("length"), "k").sortWithinPartitions(F.desc("length")))
    cut = placed.agg(F.percentile_approx("length", F.lit(1 - HEAD), F.lit(1000)).alias("cut")).first()["cut"] or 0.0
    first = save(_best(_scan(spark, placed.where(F.col("length") >= cut), weights, queries, np.ones(len(items), np.int64), k), k))
    bounds = np.ones(len(items), np.int64)
    for r in first.where(F.col("rank") == k).select("q", "score").toLocalIterator():
        bounds[r["q"]] = r["score"]
    reach = [b / n for b, n in zip(bounds.tolist(), lengths.tolist(), strict=True) if n]
    if not reach:
        return first
    rest = placed.where((F.col("length") < cut) & (F.col("length") * SLACK >= min(reach)))
    return _best(_scan(spark, rest, weights, queries, bounds, k).unionByName(first.drop("rank")), k)


def _best(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.desc("score"), F.col("k").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _vectors(docs: DataFrame, codes: dict[bytes, int]) -> DataFrame:
    """k, n (terms of the document), ids and tfs (its terms that items have)."""
    kept = docs.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = kept.value
        for batch in (b.slice(i, BUCKET) for b in batches for i in range(0, b.num_rows, BUCKET)):
            ns, ends, ids, tfs = [], [0], [], []
            for text in byte_texts(batch.column("text")):
                counts: Counter = Counter()
                for words in split_words(text, NORMAL):
                    counts.update(words)
                met = codes.keys() & counts.keys()
                ns.append(counts.total())
                ids += map(codes.__getitem__, met)
                tfs += map(counts.__getitem__, met)
                ends.append(len(ids))
            lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind))
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(ns, pa.int64()), lists(ids, pa.int32()), lists(tfs, pa.int64())], ["k", "n", "ids", "tfs"])

    return docs.mapInArrow(run, "k bigint, n bigint, ids array<int>, tfs array<bigint>")


def _impacts(found: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """k, length, ids and impacts: floor(1e9 tf / (1000 tf + 8 m)), where m grows with the document's size."""
    kept = found.sparkSession.sparkContext.broadcast(weights)
    rows = found.withColumn("m", F.expr(f"100 - 75 + ((75 * n * {n_docs}L) div {n_terms}L)"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("ids").value_lengths().to_numpy()
            ids, tf = batch.column("ids").flatten().to_numpy(), batch.column("tfs").flatten().to_numpy()
            impacts = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(batch.column("m").to_numpy(), sizes))
            squares = np.add.reduceat(kept.value[ids] * impacts.astype(np.float64) ** 2, np.cumsum(sizes) - sizes)
            ends = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(np.sqrt(squares)), pa.ListArray.from_arrays(ends, pa.array(ids)), pa.ListArray.from_arrays(ends, pa.array(impacts.astype(np.int32)))], ["k", "length", "ids", "impacts"])

    return rows.mapInArrow(run, "k bigint, length double, ids array<int>, impacts array<int>")


def _scan(spark: SparkSession, placed: DataFrame, weights: np.ndarray, queries: list, bounds: np.ndarray, k: int) -> DataFrame:
    """q, k and score of each task's ``k`` best documents of each item; documents below ``bounds`` don't matter."""
    kept = spark.sparkContext.broadcast((weights, queries, bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries, bounds = kept.value
        found = [Best(b, k) for b in bounds.tolist()]
        for batch in batches:
            for i in range(0, batch.num_rows, BUCKET):
                bucket = Bucket(batch.slice(i, BUCKET), weights)
                for (ids, times), best in zip(queries, found, strict=True):
                    bucket.search(ids, times, best)
        q = np.repeat(np.arange(len(found), dtype=np.int32), [len(b.ids) for b in found])
        ids = np.concatenate([np.zeros(0, np.int64), *[b.ids for b in found]])
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids, mask=np.concatenate([np.zeros(0, bool), *[b.missing for b in found]])), pa.array(np.concatenate([np.zeros(0, np.int64), *[b.scores for b in found]]))], ["q", "k", "score"])

    return placed.select("k", "length", "ids", "impacts").mapInArrow(run, "q int, k bigint, score bigint")


class Best:
    """The k best documents of an item so far, and the score that a further one must reach."""

    def __init__(self, bound: int, k: int):
        self.bound, self.k = bound, k
        self.scores, self.ids, self.missing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        keep = scores >= self.bound
        scores, ids, missing = (np.concatenate((a, b[keep])) for a, b in ((self.scores, scores), (self.ids, ids), (self.missing, missing)))
        order = np.lexsort((ids, missing, -scores))[: self.k]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]
        if len(order) == self.k:
            self.bound = max(self.bound, int(self.scores[-1]))


class Bucket:
    """Vectors of similar length, by document and by coordinate."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray):
        self.ids = batch.column("k").fill_null(0).to_numpy()
        self.missing = batch.column("k").is_null().to_numpy(zero_copy_only=False)
        self.lengths = batch.column("length").to_numpy()
        self.longest = float(self.lengths.max())
        sizes = batch.column("ids").value_lengths().to_numpy()
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        self.terms, self.impacts = batch.column("ids").flatten().to_numpy(), batch.column("impacts").flatten().to_numpy()
        self.weights = weights
        # By coordinate: the documents that have it, their impacts and the largest one.
        order = np.argsort(self.terms, kind="stable")
        self.of = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.by_term = self.impacts[order].astype(np.float64)
        self.starts = np.searchsorted(self.terms[order], np.arange(len(weights) + 1))
        self.largest = np.zeros(len(weights))
        has = np.flatnonzero(np.diff(self.starts))
        self.largest[has] = np.maximum.reduceat(self.by_term, self.starts[has])

    def search(self, ids: np.ndarray, times: np.ndarray, best: Best) -> None:
        factors = (self.weights[ids] * times).astype(np.float64)
        whole = math.sqrt(float((factors * times).sum()))
        if whole * self.longest * SLACK < best.bound:
            return
        most = factors * self.largest[ids]
        order = np.argsort(-most, kind="stable")
        left = np.append(np.cumsum(most[order][::-1])[::-1], 0.0)
        if left[0] * SLACK < best.bound:
            return
        # Coordinates by falling contribution, until the rest alone is far below the bound.
        n = int(np.searchsorted(-left, -best.bound / 4))
        sums, squares = np.zeros(len(self.lengths)), np.zeros(len(self.lengths))
        for i in order[:n].tolist():
            a, b = self.starts[ids[i]], self.starts[ids[i] + 1]
            sums[self.of[a:b]] += factors[i] * self.by_term[a:b]
            squares[self.of[a:b]] += float(self.weights[ids[i]]) * self.by_term[a:b] ** 2
        near = np.flatnonzero((sums + left[n]) * SLACK >= best.bound)
        rest = math.sqrt(float((factors * times)[order[n:]].sum()))
        shorter = np.sqrt(np.maximum(self.lengths[near] ** 2 * SLACK - squares[near], 0.0))
        near = near[(sums[near] + rest * shorter) * SLACK >= best.bound]
        if len(near):
            best.add(self.score(near, ids, times), self.ids[near], self.missing[near])

    def score(self, rows: np.ndarray, ids: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Exact scores of some documents."""
        factors = np.zeros(len(self.weights), np.int64)
        factors[ids] = self.weights[ids] * times
        sizes = self.ends[rows + 1] - self.ends[rows]
        at = np.repeat(self.ends[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return np.add.reduceat(factors[self.terms[at]] * self.impacts[at], np.cumsum(sizes) - sizes)
