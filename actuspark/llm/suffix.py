"""Exact substring dedup by sparse, distributed prefix doubling.

A byte is removed when a string of ``length`` bytes that covers it also starts earlier (a smaller
document id, or the same document and an earlier place). Ranks of all positions of a large corpus
do not fit any disk, so only sampled suffixes go through Spark, chosen so that nothing is lost:

1. Names of the strings of 1, 2, 4, ... bytes at each position come from the pair of names at the
   position and at the growing offset (the doubling step, in numpy). Of every ``length``-byte
   string, the place whose 32-byte name is least is its anchor; equal strings have equal anchors.
   Strings of a document with one anchor are a run.
2. Spark sorts (anchor name, run name, position). Equal runs are ranked by position: all but the
   first are covered whole. Anchors with a single run are unique and drop out; for the other
   anchors the first of each distinct run goes on.
3. These runs are compared string by string (``length`` past the threshold): the task that holds an
   anchor's runs keeps the strings met so far; beyond ``GROUP`` runs, strings are named and sorted
   by Spark instead, so that no group has to fit in memory.
4. Covered pieces are gathered by document and cut out.

Names are 64-bit hashes; run and string names carry 64 bits for each of two parts, so that equal
names mean equal strings but for a chance below 1e-9 at 100 TB.

Defined cases: a null text is empty; a null id comes before all others; rows of one id are told
apart by their text, and equal rows are one document (neither is earlier than the other, so both
keep what only they have); an empty table gives an empty result; other columns are not read. Texts
are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import byte_texts, mix64, save, ship

LENGTH = 100
ANCHOR = 32
#: Runs of one anchor that a task compares in memory.
GROUP = 2000
#: Window starts of one document that are handled together.
CHUNK = 4_000_000
NULL_ID = -(2**63)
TAG_BITS, GEO_BITS = 19, 14

_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The name of two strings that follow each other, from their names."""
    x = left * _A
    x ^= x >> np.uint64(29)
    x += right
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def names(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the ANCHOR-byte and of the ``length``-byte strings at each position."""
    h, k, anchor = _TABLE[text], 1, None
    while 2 * k <= length:
        h = pair(h[:-k], h[k:])
        k *= 2
        if k == ANCHOR:
            anchor = h
    return anchor, h if k == length else pair(h[: len(h) - (length - k)], h[length - k :])


def runs(text: np.ndarray, length: int, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor name, run name, anchor, first and last start of each run of the text's strings."""
    parts = [_runs(text[a : a + chunk + length - 1], a, length) for a in range(0, max(1, len(text) - length + 1), chunk)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _runs(text: np.ndarray, at: int, length: int):
    short, full = names(text, length)
    w = length - ANCHOR + 1
    m = ((short >> np.uint64(24)) << np.uint64(24)) | np.arange(len(short), dtype=np.uint64)
    n, k = len(m), 1
    while 2 * k <= w:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    m = np.minimum(m[: n - w + 1], m[w - k : w - k + n - w + 1])
    anchor = (m & np.uint64(0xFFFFFF)).astype(np.int64)
    turn = np.flatnonzero(np.diff(anchor)) + 1
    lo, hi = np.concatenate(([0], turn)), np.concatenate((turn - 1, [len(anchor) - 1]))
    a = anchor[lo]
    name = pair(pair(full[lo], full[hi]), ((hi - lo) * 128 + (a - lo)).astype(np.uint64))
    return short[a], name, a + at, lo + at, hi + at


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _tag(text: bytes) -> int:
    """As ``tag_of`` has it."""
    return xxhash.xxh64_intdigest(text, 42) >> (64 - TAG_BITS)


def tag_of(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - TAG_BITS)


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, disjoint intervals with the same union."""
    if not len(starts):
        return starts, ends
    o = np.argsort(starts, kind="stable")
    s, e = starts[o], np.maximum.accumulate(ends[o])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    return s[new], e[np.concatenate((new[1:], [True]))]


ROWS = "h bigint, r bigint, d bigint, p bigint"
#: p holds the anchor's place, the run's shape and the text's tag; rows with h null are covered pieces: r is the start, p the end above the tag.


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """The runs of each batch; of runs that are equal within a batch only the first, the others as covered pieces."""
    for batch in batches:
        ids, found = batch.column(0).to_pylist(), []
        for d, t in zip(ids, byte_texts(batch.column(1)), strict=True):
            if len(t) >= length:
                h, r, a, lo, hi = runs(np.frombuffer(t, np.uint8), length, chunk)
                shape = ((hi - lo) << 7) | (a - lo)
                found.append((h, r, np.full(len(h), NULL_ID if d is None else d, np.int64), (((a << GEO_BITS) | shape) << TAG_BITS) | _tag(t)))
        if not found:
            continue
        h, r, d, p = (np.concatenate(x) for x in zip(*found, strict=True))
        o = np.lexsort((p, d, r, h))
        h, r, d, p = h[o], r[o], d[o], p[o]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])))
        yield _batch(_signed(h[new]), _signed(r[new]), d[new], p[new])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = ~new & ((d != d[head]) | (_place(p) != _place(p[head])))
        cd, cs, cp = _covered(d[later], p[later], length)
        if len(cd):
            yield _batch(None, cs, cd, cp)


def _place(p: np.ndarray) -> np.ndarray:
    return p >> (TAG_BITS + GEO_BITS)


def _span(p: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    shape = (p >> TAG_BITS) & ((1 << GEO_BITS) - 1)
    lo = _place(p) - (shape & 127)
    return lo, lo + (shape >> 7) + length


def _covered(d: np.ndarray, p: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered pieces of runs, merged by document: id, start, end with the tag."""
    if not len(d):
        return d, d, d
    lo, hi = _span(p, length)
    tag = p & ((1 << TAG_BITS) - 1)
    o = np.lexsort((lo, tag, d))
    d, lo, hi, tag = d[o], lo[o], hi[o], tag[o]
    doc = np.cumsum(np.concatenate(([0], ((d[1:] != d[:-1]) | (tag[1:] != tag[:-1])).astype(np.int64))))
    far = np.int64(1) << 40
    s, e = _merged(lo + doc * far, hi + doc * far)
    k = np.searchsorted(doc, s // far)
    return d[k], s % far, ((e % far) << TAG_BITS) | tag[k]


def _batch(h, r, d, p) -> pa.RecordBatch:
    n = len(d)
    first = pa.nulls(n, pa.int64()) if h is None else pa.array(h, pa.int64())
    return pa.RecordBatch.from_arrays([first, *[pa.array(x, pa.int64()) for x in (r, d, p)]], ["h", "r", "d", "p"])


def _rank(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (h, r, d, p): covered pieces (h null), and first runs of anchors with several runs (h kept)."""
    last = None  # the last first row: h, r, d, p and whether it went out already
    for batch in batches:
        cols = [batch.column(i) for i in range(4)]
        ready = cols[0].is_null()
        if (n_ready := ready.to_numpy(zero_copy_only=False).sum()) > 0:
            yield pa.RecordBatch.from_arrays([c.filter(ready) for c in cols], ["h", "r", "d", "p"])
            if n_ready == batch.num_rows:
                continue
            cols = [c.filter(cols[0].is_valid()) for c in cols]
        h, r, d, p = (c.to_numpy(zero_copy_only=False) for c in cols)
        sent = np.zeros(len(h), bool)
        if last is not None:
            h, r, d, p = (np.concatenate(([x], y)) for x, y in zip(last[:4], (h, r, d, p), strict=True))
            sent = np.concatenate(([last[4]], sent))
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])))
        heads = np.flatnonzero(new)
        head = heads[np.cumsum(new) - 1]
        later = ~new & ((d != d[head]) | (_place(p) != _place(p[head])))
        cd, cs, cp = _covered(d[later], p[later], length)
        if len(cd):
            yield _batch(None, cs, cd, cp)
        hh = h[heads]
        same = hh[1:] == hh[:-1]
        go = np.concatenate((same, [False])) | np.concatenate(([False], same))
        out = heads[go & ~sent[heads]]
        if len(out):
            yield _batch(h[out], r[out], d[out], p[out])
        z = heads[-1]
        last = (h[z], r[z], d[z], p[z], bool(go[-1] or sent[z]))


def _spell(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs that go on."""
    for batch in batches:
        hs, ds, ps, texts = [], [], [], []
        for d, t, todo in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            p = np.array([x["p"] for x in todo], np.int64)
            lo, hi = _span(p, length)
            hs += [x["h"] for x in todo]
            ds += [d] * len(todo)
            ps += p.tolist()
            texts += [t[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), pa.array(ds, pa.int64()), pa.array(ps, pa.int64()), pa.array(texts, pa.binary())], ["h", "d", "p", "t"])


STRINGS = "k bigint, c bigint, d bigint, s bigint, e bigint"


def _compare(batches: Iterator[pa.RecordBatch], length: int, limit: int) -> Iterator[pa.RecordBatch]:
    """From runs sorted by (h, d, p): covered pieces (k null); the strings of anchors with over GROUP runs, by their names."""
    group, met, held, wide = None, {}, [], False
    for batch in batches:
        out: list[tuple] = []
        for h, d, p, t in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if h != group:
                group, met, held, wide = h, {}, [], False
            tag, place = p & ((1 << TAG_BITS) - 1), p >> (TAG_BITS + GEO_BITS)
            lo = place - ((p >> TAG_BITS) & 127)
            if not wide:
                held.append((d, lo, tag, t))
                wide = len(held) > limit
                if wide:
                    met = {}
                    for x in held:
                        out += _strings(*x, length)
                    held = []
                    continue
                start = None
                for i in range(len(t) - length + 1):
                    key = (place - lo - i, t[i : i + length])
                    first = met.setdefault(key, (d, lo + i))
                    if first != (d, lo + i) and first < (d, lo + i):
                        start = i if start is None else start
                    elif start is not None:
                        out.append((None, None, d, lo + start, ((lo + i - 1 + length) << TAG_BITS) | tag))
                        start = None
                if start is not None:
                    out.append((None, None, d, lo + start, ((lo + len(t)) << TAG_BITS) | tag))
            else:
                out += _strings(d, lo, tag, t, length)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["k", "c", "d", "s", "e"])


def _strings(d: int, lo: int, tag: int, t: bytes, length: int) -> list[tuple]:
    text = np.frombuffer(t, np.uint8)
    k, c = _signed(names(text, length)[1]), _signed(names(text[::-1], length)[1][::-1])
    return [(int(k[i]), int(c[i]), d, lo + i, ((lo + i + length) << TAG_BITS) | tag) for i in range(len(t) - length + 1)]


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From strings sorted by (k, c, d, s): those that are not the first of their name."""
    last = None
    for batch in batches:
        out = []
        for k, c, d, s, e in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            if last is None or last[:2] != (k, c):
                last = (k, c, d, s)
            elif (d, s) != last[2:]:
                out.append((d, s, e))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["d", "s", "e"])


def covered(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """Covered pieces as (d, s, e): the id (NULL_ID for null), the start, and the end above the text's tag."""
    if not ANCHOR <= length <= ANCHOR + 95:
        raise ValueError(f"length must be from {ANCHOR} to {ANCHOR + 95}")
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("d"), F.col(text).alias("t"))
    ranked = (
        rows.mapInArrow(lambda b: _anchor_rows(b, length, chunk), ROWS)
        .withColumn("at", F.coalesce("h", F.xxhash64("d", "r")))
        .repartition("at")
        .drop("at")
        .sortWithinPartitions("h", "r", "d", "p")
        .mapInArrow(lambda b: _rank(b, length), ROWS)
    )
    ranked = save(ranked)
    todo = ranked.where("h is not null").groupBy("d", (F.col("p").bitwiseAND((1 << TAG_BITS) - 1)).alias("tag")).agg(F.collect_list(F.struct("h", "p")).alias("todo"))
    spelled = tagged(rows).join(todo, ["d", "tag"]).select("d", "t", "todo")
    strings = save(
        spelled.mapInArrow(lambda b: _spell(b, length), "h bigint, d bigint, p bigint, t binary")
        .repartition("h")
        .sortWithinPartitions("h", "d", "p")
        .mapInArrow(lambda b: _compare(b, length, group), STRINGS)
    )
    repeats = strings.where("k is not null").repartition("k").sortWithinPartitions("k", "c", "d", "s").mapInArrow(_repeats, "d bigint, s bigint, e bigint")
    return ranked.where("h is null").select("d", F.col("r").alias("s"), F.col("p").alias("e")).unionByName(strings.where("k is null").select("d", "s", "e")).unionByName(repeats)


def tagged(rows: DataFrame) -> DataFrame:
    """Rows with the columns d and t, with null ids replaced, and the tag of each text."""
    return rows.withColumns({"d": F.coalesce("d", F.lit(NULL_ID)), "tag": tag_of(F.col("t"))})


def _spans(pieces: list | None) -> list[tuple[int, int]]:
    if not pieces:
        return []
    s = np.array([x["s"] for x in pieces], np.int64)
    e = np.array([x["e"] >> TAG_BITS for x in pieces], np.int64)
    a, b = _merged(s, e)
    return list(zip(a.tolist(), b.tolist(), strict=True))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep_text: str = "bytes", carry: tuple[str, ...] = (), group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256, with ``keep_text`` "bytes" the remaining bytes as kept, with "text" what is left of whole characters as text, and a struct rest of the columns ``carry``: a row for each document."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[key].dataType.simpleString()
    kept = {"bytes": ["kept"], "text": ["text"]}.get(keep_text, [])
    rest = [F.struct(*[F.col(c) for c in carry]).alias("rest")] if carry else []
    pieces = covered(docs, key, text, length, group, chunk)
    pieces = pieces.groupBy("d", F.col("e").bitwiseAND((1 << TAG_BITS) - 1).alias("tag")).agg(F.collect_list(F.struct("s", "e")).alias("pieces"))
    rows = tagged(docs.select(F.col(key).cast("bigint").alias("d"), F.col(text).alias("t"), *rest)).join(pieces, ["d", "tag"], "left").select("d", "t", "pieces", *["rest"] * bool(carry))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for t, found in zip(byte_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                spans, at, left = _spans(found), 0, []
                for a, b in spans:
                    left.append(t[at:a])
                    at = b
                left.append(t[at:])
                whole = b"".join(left)
                out.append((len(t), len(t) - len(whole), len(spans), hashlib.sha256(whole).hexdigest(), whole))
            n, gone, k, sha, whole = zip(*out, strict=True)
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(k, pa.int64()), pa.array(sha, pa.string())]
            if keep_text == "bytes":
                cols.append(pa.array(whole, pa.binary()))
            elif keep_text == "text":
                cols.append(pa.array([x.decode(errors="ignore") for x in whole], pa.string()))
            cols += batch.columns[3:]
            yield pa.RecordBatch.from_arrays(cols, ["d", "n_bytes", "n_removed", "n_spans", "kept_sha256", *kept, *["rest"] * bool(carry)])

    schema = "d bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + {"bytes": ", kept binary", "text": ", text string"}.get(keep_text, "")
    if carry:
        schema += f", rest {rows.schema['rest'].dataType.simpleString()}"
    out = rows.mapInArrow(run, schema)
    return out.withColumn("d", F.nullif("d", F.lit(NULL_ID)).cast(kind)).withColumnRenamed("d", key)
