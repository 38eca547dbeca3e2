"""Paragraph dedup by MinHash banding, exact verification and components.

A paragraph is a line of at least ``min_words`` words (``MIN_WORDS`` unless told, 1 in the query); one of
fewer words than a shingle has is one shingle of all its words. Its shingle set gets a MinHash signature in
``bands`` bands of ``rows`` hashes, tuned so that a pair at the threshold shares a band with a
probability of at least ``RECALL``. Paragraphs that share a band are compared exactly: first with the
least of them, then, where components differ, with further pivots until no pair of a bucket is left
open (the recursion of the Jaccard join). Components of the links are the classes, and all
paragraphs of a class but the first are removed.

Equal sets of a block of documents are one paragraph before anything is shuffled, so a line that a
third of all documents hold costs a row for each block only; equal sets of different blocks meet by
their digests, and one of each goes into the bands. Shingles are made again, in one more scan, for
those paragraphs only that share a band with another set.

Given ``passage_words``, passages of that many words and more that an earlier document holds, too, are found besides
(``passages``), wherever they begin and end in their lines. Each is a further row, removed, with its first word's line and place
in it; classes of lines stay as they are. Their windows are read in the scan that makes the shingles again.

Defined cases: null texts and lines of fewer words have no paragraphs and are left alone; a null id
comes before all others; rows of one id are told apart by their text, equal rows are one document
with as many results; an empty table gives an empty result; other columns are not read. The id is a whole
number; ids of another type raise. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import passages
from .jaccard import ORD_BITS, PER_CENT, PIVOTS, WORDS, blocks, link
from .shared import LOWER_BYTES, byte_texts, mix64, save, ship, whole_key
from .suffix import NULL_ID, pair

MIN_WORDS = 5
#: Buckets of more members are compared in parts; paragraphs' sets are short, so this is less than for whole documents.
LARGE = 64
RECALL = 0.998
#: Bytes of text that a task hashes together.
BLOCK = 4_000_000


def tune(threshold: float, recall: float = RECALL, most: int = 6) -> tuple[int, int]:
    """(bands, rows): the most rows, within ``most`` and 16 bands, whose recall at the threshold is high enough."""
    best = None
    for rows in range(1, most + 1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))
        if best is None or bands <= 16:
            best = (bands, rows)
    return best


def _lines(text: bytes, min_words: int) -> list[tuple[int, list[bytes]]]:
    """Line number and words of each paragraph."""
    return [(line, ws) for line, t in enumerate(text.translate(LOWER_BYTES).split(b"\n")) if len(ws := t.split()) >= min_words]


def _batch_sets(paragraphs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all paragraphs one after another, sorted within each, and the number of each."""
    sizes = np.array([len(ws) for ws in paragraphs])
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for ws in paragraphs for w in ws), np.uint64, int(sizes.sum()))
    of = np.repeat(np.arange(len(sizes)), sizes)
    k = np.minimum(sizes, WORDS)
    ends = np.cumsum(sizes)
    x = np.zeros(len(h), np.uint64)
    for n in np.unique(k):  # paragraphs of fewer words are one shingle of all their words
        own = h
        for j in range(1, n):
            own = pair(own[: len(h) - j], h[j:])
        at = np.flatnonzero((k[of] == n) & (np.arange(len(h)) + n <= ends[of]))
        x[at] = own[at]
    at = np.flatnonzero(np.arange(len(h)) + k[of] <= ends[of])
    x, of = x[at], of[at]
    o = np.lexsort((x, of))
    x, of = x[o], of[o]
    new = np.concatenate(([True], (x[1:] != x[:-1]) | (of[1:] != of[:-1])))
    return x[new], np.bincount(of[new], minlength=len(sizes))


def bands_of(sets: np.ndarray, sizes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band keys (a row a set) of sets of shingle hashes that stand one after another."""
    salts = mix64(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    heads, mixed = np.cumsum(sizes) - sizes, mix64(sets)
    keys = np.empty((len(sizes), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(sizes), mix64(np.array([b], np.uint64))[0], np.uint64)
        for r in range(rows):
            y = mixed * salts[b * rows + r]
            y ^= y >> np.uint64(32)
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(y, heads))
        keys[:, b] = key
    return keys


#: A paragraph: its place, its number of words and of shingles and the first paragraph of its block with the same set; of those first ones, the set's digest and the bands.
PARAGRAPHS = "node bigint, d bigint, line int, x bigint, words int, n int, rep bigint, one bigint, two bigint, bands array<bigint>"
_NAMES = [c.split()[0] for c in PARAGRAPHS.split(", ")]


def _paragraphs(batches: Iterator[pa.RecordBatch], min_words: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for block, ids, texts in blocks(batches, BLOCK):
        d, at, x, ws = [], [], [], []
        for key, t in zip(ids, texts, strict=True):
            own = _lines(t, min_words)
            d += [key] * len(own)
            x += [xxhash.xxh64_intdigest(t, 42)] * len(own)
            at += [line for line, _ in own]
            ws += [w for _, w in own]
        if not ws:
            continue
        sets, n = _batch_sets(ws)
        heads = np.cumsum(n) - n
        one, two = np.add.reduceat(mix64(sets), heads), np.add.reduceat(mix64(sets * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(7)), heads)
        o = np.lexsort((two, one, n))
        new = np.concatenate(([True], (one[o][1:] != one[o][:-1]) | (two[o][1:] != two[o][:-1]) | (n[o][1:] != n[o][:-1])))
        rep = np.empty(len(o), np.int64)
        rep[o] = o[np.flatnonzero(new)[np.cumsum(new) - 1]]
        first = rep == np.arange(len(o))
        keys = bands_of(sets[np.repeat(first, n)], n[first], bands, rows).reshape(-1).view(np.int64)
        ends = np.concatenate(([0], np.cumsum(np.where(first, bands, 0)))).astype(np.int32)
        node = block << ORD_BITS
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(o)) + node), pa.array(d, pa.int64()), pa.array(at, pa.int32()), pa.array(np.array(x, np.uint64).view(np.int64)), pa.array(np.array([len(w) for w in ws], np.int32)),
                pa.array(n.astype(np.int32)), pa.array(rep + node),
                pa.array(one.view(np.int64), mask=~first), pa.array(two.view(np.int64), mask=~first), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys)),
            ],
            _NAMES,
        )


MEMBERS = "key bigint, node bigint, n int"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those whose key several rows have."""
    last = None
    for batch in batches:
        key, node, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        sent = np.zeros(len(key), bool)
        if last is not None:
            key, node, n = (np.concatenate(([x], y)) for x, y in zip(last[:3], (key, node, n), strict=True))
            sent = np.concatenate(([last[3]], sent))
        same = key[1:] == key[:-1]
        many = np.concatenate((same, [False])) | np.concatenate(([False], same))
        go = many & ~sent
        if go.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[go]), pa.array(node[go]), pa.array(n[go].astype(np.int32))], ["key", "node", "n"])
        last = key[-1], node[-1], n[-1], bool(many[-1] or sent[-1])


#: A set of shingles, or the windows of a context (``passages``): the latter without node.
READ = "node bigint, n int, set binary, key bigint, ctx bigint, d bigint, x bigint, p int"
_READ_TYPES = [{"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in READ.split(", ")]


def _read(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The sets of the lines, and the windows of the contexts, that each text (d, x, t, todo, ats) is asked for."""
    for batch in batches:
        texts = byte_texts(batch.column(2))
        d, x, lines_asked, asked = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
        nodes, ws, rows = [], [], []
        for i, t in enumerate(texts):
            if lines_asked[i]:
                lines = t.translate(LOWER_BYTES).split(b"\n")
                for y in lines_asked[i]:
                    nodes.append(y["node"])
                    ws.append(lines[y["line"]].split())
            if asked[i]:
                found = passages.windows_of(t, asked[i], least)
                rows += [(None, c["n"], s, c["key"], c["ctx"], d[i], x[i], c["p"]) for c, s in zip(asked[i], found, strict=True)]
        if nodes:
            sets, n = _batch_sets(ws)
            ends = np.cumsum(n)
            rows += [(node, k, sets[b - k : b].tobytes(), *[None] * 5) for node, k, b in zip(nodes, n.tolist(), ends.tolist(), strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _READ_TYPES, strict=True)], [c.split()[0] for c in READ.split(", ")])


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", per_cent: int = PER_CENT, min_words: int = MIN_WORDS, recall: float = RECALL, pivots: int = PIVOTS, passage_words: int | None = None) -> DataFrame:
    """key, paragraph (line number from 0), n_shingles, class_doc and class_paragraph (the first of its class), removed, first_word (in the line, from 0), n_words: a row for each paragraph.

    Given ``passage_words``, also a row for each passage, without n_shingles; its class is the place where its first window stands first.
    """
    ship(docs.sparkSession)
    bands, n_rows = tune(per_cent / 100, recall)
    rows = docs.select(whole_key(docs, key).alias("d"), F.col(text).alias("t"))
    found = save(rows.mapInArrow(lambda b: _paragraphs(b, min_words, bands, n_rows), PARAGRAPHS))
    # One paragraph for each set: the digests meet, then only the least node's bands go on.
    first = found.where("one is not null")
    heads = first.groupBy("one", "two", "n").agg(F.min("node").alias("head"))
    heads = save(first.select("node", "one", "two", "n").join(heads, ["one", "two", "n"]).select("node", "head"))
    sole = first.join(heads.where("node = head").select("node"), "node", "left_semi")
    members = save(sole.select(F.explode("bands").alias("key"), "node", "n").repartition("key").sortWithinPartitions("key").mapInArrow(_met, MEMBERS))
    live = first.join(members.select("node").distinct(), "node", "left_semi")
    asked = live.groupBy("d", "x").agg(F.collect_list(F.struct("node", "line")).alias("todo"))
    least = passage_words or 0
    if least:
        places = passages.contexts(rows, least)
        asked = asked.join(passages.wanted(places), ["d", "x"], "full")
    else:
        asked = asked.withColumn("ats", F.expr("CAST(NULL AS ARRAY<STRUCT<key: BIGINT, ctx: BIGINT, p: INT, n: INT>>)"))
    texts = rows.withColumns({"d": F.coalesce("d", F.lit(NULL_ID)), "x": F.xxhash64(F.coalesce("t", F.lit("")))})
    # Equal rows are asked alike, and name the same nodes.
    read = save(texts.join(asked, ["d", "x"]).select("d", "x", "t", "todo", "ats").mapInArrow(lambda b: _read(b, least), READ).dropDuplicates(["node", "d", "x", "p"]))
    sets = read.where("node is not null").select("node", "n", "set")
    labels = link(members.withColumn("s", F.col("n")), sets, per_cent, pivots, LARGE)
    named = heads.join(labels.select(F.col("node").alias("head"), "component"), "head", "left").select(F.col("node").alias("rep"), F.coalesce("component", "head").alias("c"))
    own = save(found.select("d", "line", "words", "n", "rep").join(named, "rep").drop("rep"))
    many = own.groupBy("c").agg(F.count(F.lit(1)).alias("copies"), F.min("d").alias("first")).where("copies > 1").select("c", "first")
    line = own.join(many, "c").where("d = first").groupBy("c", "first").agg(F.min("line").alias("first_line"))
    out = own.join(line, "c", "left").withColumns({"first": F.coalesce("first", "d"), "first_line": F.coalesce("first_line", "line")})
    kind = docs.schema[key].dataType.simpleString()
    back = lambda c: F.nullif(c, F.lit(NULL_ID)).cast(kind)
    lines = out.select(
        back(F.col("d")).alias(key),
        F.col("line").cast("bigint").alias("paragraph"),
        F.col("n").cast("bigint").alias("n_shingles"),
        back(F.col("first")).alias("class_doc"),
        F.col("first_line").cast("bigint").alias("class_paragraph"),
        ((F.col("first") != F.col("d")) | (F.col("first_line") != F.col("line"))).alias("removed"),
        F.lit(0).cast("bigint").alias("first_word"),
        F.col("words").cast("bigint").alias("n_words"),
    )
    if not least:
        return lines
    cut = passages.passages(places, read.where("node is null"), least)
    again = rows.select(F.coalesce("d", F.lit(NULL_ID)).alias("d"), F.xxhash64(F.coalesce("t", F.lit(""))).alias("x"))
    cut = again.join(cut, ["d", "x"])  # as often as the row
    return lines.unionByName(cut.select(
        back(F.col("d")).alias(key),
        F.shiftright("l", 32).alias("paragraph"),
        F.lit(None).cast("bigint").alias("n_shingles"),
        back(F.col("f.d")).alias("class_doc"),
        F.shiftright("f.l", 32).alias("class_paragraph"),
        F.lit(True).alias("removed"),
        F.col("l").bitwiseAND(F.lit(2**32 - 1)).alias("first_word"),
        F.col("n_words").cast("bigint").alias("n_words"),
    ))
