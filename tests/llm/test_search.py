"""Ranked search against scoring every document in plain Python, and its defined cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from actuspark.llm import search

DOCS = "doc_id int, text string, k int, length double, ids string"
ITEMS = "item_id string, text string, q int"


def terms(text):
    return ["".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    merged = {}
    for i, t in sorted(set(items), key=str):
        merged.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, want in merged.items():
        found = []
        for i, c in counted:
            m = 100 - 75 + (75 * c.total() * n_docs) // max(total, 1)
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, times in want.items() if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if missing else i, -s) for r, (s, missing, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É1", "é1", "日本"]
    text = lambda size: " ".join(rnd.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=size))
    docs = [(i, text(rnd.choice([0, 3, 20, 60, 400]))) for i in range(n)]
    items = [(f"i{i}", rnd.choice([text(8), docs[rnd.randrange(n)][1][:80], text(1)])) for i in range(30)]
    return docs, items


def test_equals_scoring_everything(spark):
    docs, items = corpus(1, 500)
    docs += [(n, "A copy, of one text: w250 w251") for n in range(900, 960)] + [(None, "w250 w251"), (None, None), (3, ""), (960, "w7 " * 400_000)] + [(3, "w250 w9 w251")] * 2
    items += [("i1", "w250 w251"), ("i1", "w250 w251"), (None, "w250 copy"), ("none", None), ("unknown", "notaword"), ("blank", " .,; ")]
    d = spark.createDataFrame([(*r, 1, 1.0, "x") for r in docs], DOCS).repartition(5)
    i = spark.createDataFrame([(*r, 0) for r in items], ITEMS)
    for k, words in ((10, search.BLOCK_WORDS), (3, 40)):
        got = sorted((tuple(r) for r in search.rank(d, i, k=k, block_words=words).select("item_id", "rank", "doc_id", "score").collect()), key=str)
        assert got == brute(docs, items, k)


def test_empty_tables(spark):
    d, i = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([("a", "w1", 0)], ITEMS)
    some = spark.createDataFrame([(1, "w1", 1, 1.0, "x")], DOCS)
    assert search.rank(d, one).count() == search.rank(some, i).count() == search.rank(d, i).count() == 0
    assert search.rank(some, i).dtypes[0] == ("item_id", "string")


def test_buckets_lose_nothing_and_prune():
    rnd = np.random.default_rng(2)
    weights = rnd.integers(0, 6000, 200)
    sizes = rnd.integers(1, 60, 3000)
    ids = np.concatenate([rnd.choice(200, n, replace=False) for n in sizes]).astype(np.int32)
    impacts = rnd.integers(1, 1_000_000, len(ids)).astype(np.int32)
    starts = np.cumsum(sizes) - sizes
    lengths = np.sqrt(np.add.reduceat(weights[ids] * impacts.astype(float) ** 2, starts))
    order = np.argsort(-lengths)
    lists = lambda x: pa.array([x[starts[i] : starts[i] + sizes[i]] for i in order.tolist()])
    batch = pa.RecordBatch.from_arrays([pa.array(order), pa.array(lengths[order]), lists(ids), lists(impacts)], ["k", "length", "ids", "impacts"])
    scored = []
    for seed in range(20):
        q = np.random.default_rng(seed).choice(200, 12, replace=False)
        times = np.ones(12, np.int64)
        factors = np.zeros(200, np.int64)
        factors[q] = weights[q]
        exact = np.add.reduceat(factors[ids] * impacts, starts)
        want = sorted(zip((-exact).tolist(), range(3000), strict=True))[:10]
        best = search.Best(1, 10)
        for i in range(0, 3000, 250):
            bucket = search.Bucket(batch.slice(i, 250), weights)
            real, rows = bucket.score, []
            bucket.score = lambda r, *a, real=real, rows=rows: (rows.append(len(r)), real(r, *a))[1]
            bucket.search(q, times, best)
            scored.append(sum(rows) / 250)
        assert list(zip((-best.scores).tolist(), best.ids.tolist(), strict=True)) == [(s, i) for s, i in want if s < 0]
    assert np.mean(scored) < 0.5
