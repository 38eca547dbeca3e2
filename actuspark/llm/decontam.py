"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton holds every substring of the normalised test items. Tasks stream the words of each
document through it and track the longest matching length; wherever the length reaches a window
(``window`` words, or a whole item that is shorter), those words are hit. Runs of words that no item
can contain are skipped with a table of the items' word pairs; that filter loses nothing, as a match
of two words or more only walks over such pairs.

The items are split into shards of at most ``SHARD_WORDS`` words, one automaton each, so what is
broadcast is bounded; hits of several shards are merged exactly, by document. ``verdicts`` judges whole
documents; ``strip`` removes spans over a length or coverage limit from their texts.

Defined cases: a null text or item has no words; an item without words is never met; repeated rows
of documents give repeated results; items with the same id count once; an empty table of items
leaves every document clean; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .shared import byte_texts, ship

WINDOW = 13
#: Words of test items in one automaton. A word costs about 1 kB in Python, so a shard stays below 0.3 GB.
SHARD_WORDS = 200_000

#: Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space.
NORMAL = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Automaton:
    """A generalised suffix automaton of word sequences that knows which windows end in each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(i, [self.ids.setdefault(w, len(self.ids)) for w in ws]) for i, ws in items if ws]
        for _, ws in coded:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        n = len(self.next)
        #: By state: the items of each window length that ends there.
        self.found: list[dict[int, set[str]]] = [{} for _ in range(n)]
        pairs = set()
        for i, ws in coded:
            size = min(window, len(ws))
            state, length = 0, 0
            for j, w in enumerate(ws):
                state, length = self.step(state, length, w)
                if j + 1 >= size:
                    at = state
                    while at and self.length[self.link[at]] >= size:
                        at = self.link[at]
                    self.found[at].setdefault(size, set()).add(i)
                if j:
                    pairs.add((ws[j - 1] << 32) | w)
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        self.shortest = min((min(window, len(ws)) for _, ws in coded), default=0)
        #: By state: the nearest state on the way to the root, itself included, where windows end.
        self.near = [-1] * n
        for v in sorted(range(1, n), key=self.length.__getitem__):
            self.near[v] = v if self.found[v] else self.near[self.link[v]]

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, q, w)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, w)
        return cur

    def _clone(self, p: int, q: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = new
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = new
            p = link[p]
        return new

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        """The state and length of the longest suffix that some item contains, after word ``w``."""
        while state and w not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        if w in self.next[state]:
            return self.next[state][w], length + 1
        return 0, 0

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans [start, end) of hit words, and the items with windows that occur."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.shortest or len(words) < self.shortest:
            return spans, items
        get = self.ids.get
        codes = np.array([get(w, -1) for w in words], dtype=np.int64)
        for a, b in self._runs(codes):
            state = length = 0
            for j in range(a, b):
                state, length = self.step(state, length, int(codes[j]))
                at = self.near[state] if state else -1
                while at > 0:
                    for size, who in self.found[at].items():
                        if size <= length:
                            items |= who
                            start = j + 1 - size
                            while spans and spans[-1][1] >= start:
                                start = min(start, spans.pop()[0])
                            spans.append((start, j + 1))
                    at = self.near[self.link[at]] if self.link[at] > 0 else -1
        return spans, items

    def _runs(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Maximal runs of at least the shortest window in which each pair of words is one of the items'."""
        n = len(codes)
        if self.shortest < 2 or not len(self.pairs):
            known = codes >= 0
        else:
            keys = (codes[:-1] << 32) | codes[1:]
            at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
            known = (self.pairs[at] == keys) & (codes[:-1] >= 0) & (codes[1:] >= 0)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known.astype(np.int8), [0]))))
        extra = 0 if len(known) == n else 1
        for a, b in zip(edges[::2], edges[1::2], strict=True):
            if b - a + extra >= self.shortest:
                yield int(a), int(b) + extra


def shards(items: list[tuple[str, list[bytes]]], limit: int = SHARD_WORDS) -> list[list[tuple[str, list[bytes]]]]:
    out: list[list] = [[]]
    size = 0
    for i, ws in items:
        if size and size + len(ws) > limit:
            out.append([])
            size = 0
        out[-1].append((i, ws))
        size += len(ws)
    return out


def find(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """k, text, n_words, spans (array of [start, end) word positions) and items (sorted array of strings), a row for each document.

    A null item id is the item called "" here. Columns ``carry`` follow in a struct rest.
    """
    spark = docs.sparkSession
    ship(spark)
    books = _books(items, item_key, item_text, shard_words)
    schema = "k bigint, text string, n_words bigint, spans array<array<bigint>>, items array<string>"
    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("text"), *([F.struct(*[F.col(c) for c in carry]).alias("rest")] if carry else []))
    if carry:
        schema += f", rest {rows.schema['rest'].dataType.simpleString()}"
    for n, book in enumerate(books):
        kept = spark.sparkContext.broadcast(book)
        first = n == 0

        def run(batches: Iterator[pa.RecordBatch], kept=kept, first=first) -> Iterator[pa.RecordBatch]:
            auto = Automaton(kept.value, window)
            for batch in batches:
                ns, spans, found = [], [], []
                before = [(None, None)] * batch.num_rows if first else list(zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True))
                for t, (old, named) in zip(byte_texts(batch.column("text")), before, strict=True):
                    ws = words_of(t)
                    s, who = auto.hits(ws)
                    ns.append(len(ws))
                    spans.append(merge([*s, *(old or [])]))
                    found.append(sorted(who | set(named or [])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k"), batch.column("text"), pa.array(ns, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(found, pa.list_(pa.string())), *([batch.column("rest")] if carry else [])],
                    ["k", "text", "n_words", "spans", "items", *["rest"] * bool(carry)],
                )

        rows = rows.mapInArrow(run, schema)
    return rows


def _books(items: DataFrame, item_key: str, item_text: str, shard_words: int) -> list:
    """The items' words, in shards; sorted, so that every run builds the same automata."""
    rows = items.select(F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("i"), F.col(item_text).alias("t")).distinct().orderBy("i", "t")
    return shards([(r["i"], words_of((r["t"] or "").encode())) for r in rows.toLocalIterator()], shard_words)


def merge(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted((int(a), int(b)) for a, b in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def verdicts(found: DataFrame, per_cent: int = 5) -> DataFrame:
    """k, text, n_words, n_hit, n_items, items_sha256, contaminated and the spans."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s[1] - s[0])
    return found.select(
        "k",
        "text",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (100 * n_hit >= per_cent * F.col("n_words"))).alias("contaminated"),
        "spans",
        *[c for c in found.columns if c == "rest"],
    )


def strip(found: DataFrame, longest: int = WINDOW, per_cent: int = 5) -> DataFrame:
    """``found`` (of ``find`` or ``verdicts``) with the text without the spans over a limit, and n_cut, the number of words that went.

    Over the length limit are spans of at least ``longest`` words; where the spans of a document cover
    ``per_cent`` of its words or more, all of them go. Texts without such spans stay as they are, null ones too.
    """
    ship(found.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            todo = []
            for n, spans in zip(batch.column("n_words").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                all_go = 100 * sum(b - a for a, b in spans) >= per_cent * n
                todo.append([x for x in spans if all_go or x[1] - x[0] >= longest])
            texts = batch.column("text")
            if any(todo):
                texts = pa.array([strip_spans(t.encode(), spans).decode() if spans else t for t, spans in zip(texts.to_pylist(), todo, strict=True)], pa.string())
            columns = [texts if name == "text" else batch.column(name) for name in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([sum(b - a for a, b in spans) for spans in todo], pa.int64())], [*batch.schema.names, "n_cut"])

    return found.mapInArrow(run, StructType([*found.schema.fields, StructField("n_cut", LongType())]))


def strip_spans(text: bytes, spans: list[list[int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    norm = text.translate(NORMAL)
    at, out, keep = 0, [], 0
    ends: list[tuple[int, int]] = []
    for w in norm.split():
        at = norm.index(w, at)
        ends.append((at, at + len(w)))
        at += len(w)
    for a, b in spans:
        out.append(text[keep : ends[a][0]])
        keep = ends[b - 1][1]
    return b"".join([*out, text[keep:]])


