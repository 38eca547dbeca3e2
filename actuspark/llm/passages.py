"""Passages that repeat across documents, by the MinHash of each window of words and exact comparison.

A passage is a run of words of a document, all of them inside windows of ``least`` consecutive words that an
earlier document holds, too; it may begin and end within lines and go over several. Of each window the
least gram (``GRAM`` words) is its MinHash, so equal windows share it: recall is 1. Neighbouring windows
mostly have the same one, and they go together as one context (the words of all of them, ``MOST`` windows at most). Grams of one
document only drop out; equal contexts meet by their digests, and where one gram has several contexts their
windows are compared one by one, by digests as well.

Documents are in the order of id and text digest; equal rows are one document. Repeats within one document are none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .jaccard import blocks
from .shared import LOWER_BYTES, mix64, save

GRAM = 8
#: Windows of a context at most; texts that go in circles have the same least gram all along.
MOST = 1024
#: Bytes of text that a task hashes together.
BLOCK = 4_000_000
#: A context: its gram, its digest, the document, the first word's place, its number of windows, and the first word's line (high half) and place in the line.
CONTEXTS = "key bigint, ctx bigint, d bigint, x bigint, p int, n int, l bigint"
_NAMES = [c.split()[0] for c in CONTEXTS.split(", ")]
WINDOWS = "key bigint, ctx bigint, off int, w bigint, d bigint, x bigint, p int, l bigint"
_WINDOW_NAMES = [c.split()[0] for c in WINDOWS.split(", ")]
_BASE = 0x9E3779B97F4A7C15
_SALT = np.uint64(0xD6E8FEB86659FD93)


class Digests:
    """Digests of all runs of words in a sequence of word hashes."""

    def __init__(self, h: np.ndarray) -> None:
        def powers(base: int) -> np.ndarray:
            out = np.full(len(h) + 1, base, np.uint64)
            out[0] = 1
            return np.cumprod(out, dtype=np.uint64)

        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * powers(_BASE)[:-1], dtype=np.uint64)))
        self.back = powers(pow(_BASE, -1, 1 << 64))

    def __call__(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mix64((self.sums[start + size] - self.sums[start]) * self.back[start] + np.atleast_1d(size).astype(np.uint64) * _SALT)


def least_of(g: np.ndarray, width: int) -> np.ndarray:
    """The place of the least number, the first of equal ones, in each window of ``width`` numbers."""
    at, span = np.arange(len(g)), 1
    while span < width and len(at):
        step = min(span, width - span)
        left, right = at[: max(len(at) - step, 0)], at[step:]
        at = np.where(g[right] < g[left], right, left)
        span += step
    return at


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' hashes of all texts one after another, each word's line (high half) and place in it, and the number of words of each text."""
    lines = [[line.split() for line in t.translate(LOWER_BYTES).split(b"\n")] for t in texts]
    per_line = np.array([len(ws) for own in lines for ws in own])
    number = np.array([i for own in lines for i in range(len(own))])
    n = np.array([sum(map(len, own)) for own in lines])
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for own in lines for ws in own for w in ws), np.uint64, int(n.sum()))
    place = np.arange(len(h)) - np.repeat(np.cumsum(per_line) - per_line, per_line)
    return h, np.repeat(number << 32, per_line) | place, n


def _contexts(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for _, ids, texts in blocks(batches, BLOCK):
        h, place, n = _hashed(texts)
        if len(h) < least:
            continue
        g = Digests(h)(np.arange(len(h) - GRAM + 1), GRAM)
        best = least_of(g, least - GRAM + 1)
        ends = np.cumsum(n)
        doc = np.repeat(np.arange(len(n)), n)
        s = np.arange(len(best))
        s = s[s + least <= ends[doc[s]]]
        if not len(s):
            continue
        gram = g[best[s]]
        first = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (s[1:] != s[:-1] + 1))))
        long = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
        first = np.flatnonzero(long % MOST == 0)
        a, count = s[first], np.diff(np.append(first, len(s)))
        ctx = Digests(mix64(h ^ _SALT))(a, count + least - 1)
        x = np.array([xxhash.xxh64_intdigest(t, 42) for t in texts], np.uint64).view(np.int64)
        of = doc[a]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(gram[first].view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(np.array(ids, np.int64)[of]), pa.array(x[of]),
                pa.array((a - (ends - n)[of]).astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(place[a]),
            ],
            _NAMES,
        )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of contexts sorted by gram, those whose gram several documents hold. Only rows of one document wait."""
    last, sent, wait = None, False, []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([*wait, batch])
        key, d, x = (t.column(c).to_numpy() for c in ("key", "d", "x"))
        heads = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        of = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(key))))
        many = np.logical_or.reduceat((d != d[heads[of]]) | (x != x[heads[of]]), heads)
        many[0] |= sent and key[0] == last
        last, sent = key[-1], bool(many[-1])
        wait = [] if sent else t.slice(int(heads[-1])).to_batches()
        yield from t.filter(pa.array(many[of])).to_batches()


def contexts(rows: DataFrame, least: int) -> DataFrame:
    """The contexts of rows (d, t) whose gram several documents hold, with the first document ``f`` of equal ones, as a table."""
    found = rows.mapInArrow(lambda b: _contexts(b, least), CONTEXTS)
    shared = save(found.repartition("key").sortWithinPartitions("key").mapInArrow(_shared, CONTEXTS))
    first = shared.groupBy("key", "ctx").agg(F.min(F.struct("d", "x", "p", "l")).alias("f"))
    return save(shared.join(first, ["key", "ctx"]))


def _is_first() -> Column:
    return (F.col("d") == F.col("f.d")) & (F.col("x") == F.col("f.x"))


def wanted(found: DataFrame) -> DataFrame:
    """(d, x, ats): the contexts that a text is asked for, namely the first of equal ones where their gram has others."""
    several = found.groupBy("key").agg(F.min("ctx").alias("a"), F.max("ctx").alias("b")).where("a < b").select("key")
    return found.where(_is_first()).join(several, "key", "left_semi").groupBy("d", "x").agg(F.collect_list(F.struct("key", "ctx", "p", "n")).alias("ats"))


def windows_of(text: bytes, asked: list[dict], least: int) -> list[bytes]:
    """For each context asked for, the digests of its windows and then the lines and places of their first words, less the window's number, so that they compress."""
    h, place, _ = _hashed([text])
    n = np.array([c["n"] for c in asked])
    at = np.arange(int(n.sum())) + np.repeat(np.array([c["p"] for c in asked]) - (np.cumsum(n) - n), n)
    w, where = Digests(mix64(h ^ _SALT))(at, least), place[at] - np.arange(len(at)) + np.repeat(np.cumsum(n) - n, n)
    return [w[b - k : b].tobytes() + where[b - k : b].tobytes() for k, b in zip(n.tolist(), np.cumsum(n).tolist(), strict=True)]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, ctx, d, x, p, n, set) as a row for each window."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key, ctx, d, x, p, n = (batch.column(i).to_numpy() for i in range(6))
        both = [np.frombuffer(s, np.int64).reshape(2, -1) for s in batch.column(6).to_pylist()]
        w, where = (np.concatenate([b[i] for b in both]) for i in (0, 1))
        off = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
        each = lambda c: np.repeat(c, n)  # noqa: B023, E731
        columns = each(key), each(ctx), off.astype(np.int32), w, each(d), each(x), (each(p) + off).astype(np.int32), where + off
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _WINDOW_NAMES)


def passages(found: DataFrame, read: DataFrame, least: int) -> DataFrame:
    """(d, x, l, n_words, f) of each passage, where ``f`` is the first place (d, x, p, l) of its first window. ``read``: the windows of ``wanted`` (key, ctx, d, x, p, n, set)."""
    earlier = (F.col("f.d") < F.col("d")) | ((F.col("f.d") == F.col("d")) & (F.col("f.x") < F.col("x")))
    single = read.select("key", "ctx", "d", "x", "p", "n", "set").mapInArrow(_windows, WINDOWS)
    judged = save(single.withColumn("f", F.min(F.struct("d", "x", "p", "l")).over(Window.partitionBy("key", "w"))).where(earlier | (F.col("off") == 0)))
    heads = judged.where("off = 0").groupBy("key", "ctx").agg(F.min("f").alias("g"))
    # A later document's context is covered as a whole, a first one's where another context has the window earlier.
    later = found.where(~_is_first()).join(heads, ["key", "ctx"], "left").select("d", "x", F.col("p").alias("s"), (F.col("p") + F.col("n") + least - 1).alias("e"), "l", F.coalesce("g", "f").alias("f"))
    pieces = later.unionByName(judged.where(earlier).select("d", "x", F.col("p").alias("s"), (F.col("p") + least).alias("e"), "l", "f"))
    inside = Window.partitionBy("d", "x").orderBy("s")
    before = F.max("e").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    runs = pieces.withColumn("new", F.when(F.col("s") <= before, 0).otherwise(1)).withColumn("run", F.sum("new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    whole = runs.groupBy("d", "x", "run").agg(F.min(F.struct("s", "l", "f")).alias("a"), F.max("e").alias("e"))
    return whole.select("d", "x", F.col("a.l").alias("l"), (F.col("e") - F.col("a.s")).alias("n_words"), F.col("a.f").alias("f"))
