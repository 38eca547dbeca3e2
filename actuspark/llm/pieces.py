"""Sampled SentencePiece segmentations, and their decoding.

A text is a lattice of vocabulary pieces. Forward filtering sums the weights of all segmentations of
each prefix, backward sampling then draws a segmentation piece by piece from its end. No piece spans
a newline, or a space after another character, so the lattice factorises there: its parts are kept
by their text, and the draws of all parts of a batch are made together in numpy.

Each draw takes its random number from a hash of (seed, row key, part, step), so a segmentation
depends on the row's key and text alone, not on partitions or batches.

A piece's log weight is ``-alpha * ln(rank + 2)`` with its merge rank from the model file; characters
outside the vocabulary become byte pieces. A leading space is put before the text and taken away by
decoding, so decoding gives back each text to the byte.

Defined cases: a null text is encoded as the empty text; a null key is the key "null"; repeated rows
get equal segmentations; an empty table gives an empty result; other columns are not read. Texts are
read whole, and a part without spaces may be of any length.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import mix64, ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Lattice nodes that a Python worker keeps at most; then it starts anew.
NODES = 2_500_000
#: Characters that are sampled together, and characters of new parts that are filtered together; one longer text or part is taken alone.
BLOCK, NEW = 300_000, 200_000
PARTS = re.compile(r"\n+| +[^ \n]*|[^ \n]+")
GRAIN = 2.0**-30


def vocabulary(model: str = MODEL) -> tuple[dict[str, tuple[int, float]], list[bytes], list[int]]:
    """Pieces with id and rank (a space for the model's space mark), the bytes of each id, and the ids of the 256 byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, raw, byte_ids = {}, [], [0] * 256
    for i in range(sp.get_piece_size()):
        text = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(text[3:5], 16)] = i
            raw.append(bytes([int(text[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            raw.append(b"")
        else:
            text = text.replace("▁", " ")
            pieces[text] = (i, -sp.get_score(i))
            raw.append(text.encode())
    return pieces, raw, byte_ids


def decode(ids: list[int], raw: list[bytes]) -> str:
    return b"".join([raw[i] for i in ids])[1:].decode()


def _roll(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The hash of a string that is longer by the character ``c``."""
    return mix64(h * np.uint64(0x9E3779B97F4A7C15) + c + np.uint64(1))


def _slots(h: np.ndarray) -> tuple[np.ndarray, np.uint64, int]:
    """For sorted hashes: by their first bits, the place of the first one that is not less; the bits to drop, and the most hashes that share the others."""
    bits = (8 * len(h)).bit_length()
    shift = np.uint64(64 - bits)
    return np.searchsorted(h, np.arange(1 << bits, dtype=np.uint64) << shift), shift, int(np.bincount((h >> shift).astype(np.int64)).max())


class Lattice:
    """Parts that were met, as nodes with the sampling weights of the pieces that end there."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], alpha: float, most: int = NODES):
        #: By length: hashes of the pieces' prefixes and their slots, with the piece of that text or -1, its weight, and whether pieces go on; at last a hash that no prefix has.
        self.by_size = {}
        prefixes: dict[str, bool] = {}
        for p in pieces:
            for k in range(1, len(p)):
                prefixes[p[:k]] = True
            prefixes.setdefault(p, False)
        for k in sorted({len(p) for p in prefixes}):
            own = [p for p in prefixes if len(p) == k]
            h = np.zeros(len(own), np.uint64)
            for j in range(k):
                h = _roll(h, np.array([ord(p[j]) for p in own], np.uint64))
            if len(np.unique(h)) < len(h):
                raise ValueError("two prefixes of the vocabulary have one hash")
            o = np.argsort(h)
            ids, logs = zip(*[(pieces[p][0], -alpha * math.log(max(pieces[p][1], 0.0) + 2)) if p in pieces else (-1, 0.0) for p in own], strict=True)
            beyond = lambda x, last: np.append(x[o], np.array(last, x.dtype))
            self.by_size[k] = _slots(h[o]), beyond(h, 2**64 - 1), beyond(np.array(ids, np.int64), -1), beyond(np.array(logs), 0.0), beyond(np.array([prefixes[p] for p in own]), False)
        self.byte_ids, self.alpha, self.most = byte_ids, alpha, most
        self.longest = max(map(len, pieces), default=1)
        self.byte_weight = -alpha * math.log(2 * len(pieces) + 2)
        self.first_char = max([i for i, _ in pieces.values()] + byte_ids) + 1
        self.chars: dict[str, int] = {}  # characters outside the vocabulary, as ids from first_char
        self.char_ids: list[list[int]] = []
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.n_nodes = self.n_edges = 0
        self.key, self.back, self.piece = np.empty(1 << 16), np.empty(1 << 16, np.int32), np.empty(1 << 16, np.int32)
        self.head = np.empty(1 << 16, np.int32)  # each node's first edge

    def add(self, parts: list[str]) -> None:
        """Forward filtering over new parts, all at once, one end position after another."""
        sizes = np.array([len(p) for p in parts], np.int64)
        text = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).astype(np.uint64)
        n, total = len(parts), len(text)
        starts = np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(n), sizes)
        local = np.arange(total) - starts[of]
        left = sizes[of] - local  # characters from here to the part's end
        node = self.n_nodes + np.arange(total) + of  # the node before each character
        begin, size, piece, weight = [], [], [], []
        at, h = np.arange(total), np.zeros(total, np.uint64)
        for k in range(1, self.longest + 1):
            on = left[at] >= k
            at, h = at[on], h[on]
            if not len(at):
                break
            h = _roll(h, text[at + k - 1])
            (slots, shift, most), keys, ids, logs, more = self.by_size[k]
            j = slots[h >> shift]
            for _ in range(most):
                j += keys[j] < h
            known = keys[j] == h
            hit = known & (ids[j] >= 0)
            begin.append(at[hit])
            size.append(np.full(hit.sum(), k))
            piece.append(ids[j[hit]])
            weight.append(logs[j[hit]])
            if k == 1 and not hit.all():
                odd = at[~hit]
                points, back = np.unique(text[odd], return_inverse=True)
                codes = np.array([self._char(chr(int(c))) for c in points])
                lens = np.array([len(self.char_ids[c]) for c in codes])
                begin.append(odd)
                size.append(np.ones(len(odd), np.int64))
                piece.append(self.first_char + codes[back])
                weight.append(lens[back] * self.byte_weight)
            on = known & more[j]
            at, h = at[on], h[on]
        begin, size, piece, weight = (np.concatenate(x) for x in (begin, size, piece, weight))
        stop = local[begin] + size
        source = node[begin] - self.n_nodes
        target = source + size
        # By stop, target and source, as one number: a target's sources differ in size, and no two pieces have one span.
        span = self.longest + 1
        o = np.argsort((stop * (total + n) + target) * span + (self.longest - size))
        source, target, piece, weight, stop, size = source[o], target[o], piece[o], weight[o], stop[o], size[o]
        alpha = np.zeros(total + n)
        cuts = np.searchsorted(stop, np.arange(1, int(stop[-1]) + 2))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            score = alpha[source[a:b]] + weight[a:b]
            heads = np.flatnonzero(np.concatenate(([True], np.diff(target[a:b]) > 0)))
            top = np.maximum.reduceat(score, heads)
            each = np.diff(np.concatenate((heads, [b - a])))
            alpha[target[a:b][heads]] = top + np.log(np.add.reduceat(np.exp(score - np.repeat(top, each)), heads))
        chance = np.exp(alpha[source] + weight - alpha[target])
        # Edges by node; a part's first node has one edge that ends the draw.
        first = starts + np.arange(n)
        o = np.argsort(np.concatenate((target * span + (self.longest - size), first * span)))
        target, source = np.concatenate((target, first))[o], np.concatenate((source, np.full(n, -1)))[o]
        piece, chance = np.concatenate((piece, np.full(n, -1)))[o], np.concatenate((chance, np.ones(n)))[o]
        heads = np.flatnonzero(np.concatenate(([True], np.diff(target) > 0)))
        each = np.diff(np.concatenate((heads, [len(target)])))
        cum = np.cumsum(chance)
        cum -= np.repeat(cum[heads] - chance[heads], each)
        cum = np.minimum(np.ceil(cum / GRAIN) * GRAIN, 1.0)
        cum[heads + each - 1] = 1.0
        m = len(target)
        if self.n_edges + m > len(self.key):
            room = max(len(self.key) * 5 // 4, self.n_edges + m)
            self.key, self.back, self.piece = (np.concatenate([x[: self.n_edges], np.empty(room - self.n_edges, x.dtype)]) for x in (self.key, self.back, self.piece))
        s = slice(self.n_edges, self.n_edges + m)
        self.key[s], self.back[s], self.piece[s] = self.n_nodes + target + cum, self.n_nodes + source, piece
        if self.n_nodes + total + n > len(self.head):
            self.head = np.concatenate([self.head[: self.n_nodes], np.empty(max(self.n_nodes // 4, total + n), np.int32)])
        self.head[self.n_nodes : self.n_nodes + total + n] = self.n_edges + heads
        self.at.update(zip(parts, (self.n_nodes + first + sizes).tolist(), strict=True))
        self.n_edges += m
        self.n_nodes += total + n

    def _char(self, c: str) -> int:
        if (k := self.chars.get(c)) is None:
            k = self.chars[c] = len(self.char_ids)
            self.char_ids.append([self.byte_ids[b] for b in c.encode()])
        return k

    def sample(self, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all parts one after another, and the number of pieces of each part."""
        n, key = len(nodes), self.key[: self.n_edges]
        counts = np.zeros(n, np.int64)
        which = np.argsort(nodes)  # in the order of the table, so that its reads follow each other
        node, steps = nodes[which].astype(np.int64), []
        step = 0
        while len(which):
            u = (mix64(seeds[which] + np.uint64((step * 0x9E3779B97F4A7C15) % 2**64)) >> np.uint64(34)).astype(np.float64) * GRAIN
            edge = self.head[node]
            past = np.flatnonzero(key[edge] - node <= u)  # a node's last key is the next node
            while len(past):
                edge[past] += 1
                past = past[key[edge[past]] - node[past] <= u[past]]
            got = self.piece[edge]
            open_ = got >= 0
            which, edge, got = which[open_], edge[open_], got[open_]
            counts[which] += 1
            steps.append((which, got))
            node = self.back[edge].astype(np.int64)
            step += 1
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if n else 0, np.int64)
        for k, (w, got) in enumerate(steps):
            out[ends[w] - 1 - k] = got
        return out, counts


def _expand(flat: np.ndarray, lattice: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """Ids with characters outside the vocabulary as bytes; the number of ids that each entry gave."""
    sizes = np.ones(len(flat), np.int64)
    odd = np.flatnonzero(flat >= lattice.first_char)
    if not len(odd):
        return flat, sizes
    table = np.array([len(x) for x in lattice.char_ids], np.int64)
    starts = np.cumsum(table) - table
    chars = np.array([i for x in lattice.char_ids for i in x], np.int64)
    sizes[odd] = table[flat[odd] - lattice.first_char]
    rep = np.repeat(flat, sizes)
    inside = np.arange(len(rep)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    is_odd = rep >= lattice.first_char
    k = rep[is_odd] - lattice.first_char
    rep[is_odd] = chars[starts[k] + inside[is_odd]]
    return rep, sizes


def row_seed(key: object, seed: int) -> int:
    name = "null" if key is None else str(key)
    return int.from_bytes(hashlib.blake2b(f"{seed}:{name}".encode(), digest_size=8).digest(), "little")


def encode_block(keys: list, texts: list[str], lattice: Lattice, seed: int) -> list[np.ndarray]:
    """The ids of each text."""
    if lattice.n_nodes > lattice.most:
        lattice.clear()
    parts_of: list[int] = []
    seeds: list[np.ndarray] = []
    found = [PARTS.findall(" " + text) for text in texts]
    at = lattice.at
    new = [p for p in dict.fromkeys(chain.from_iterable(found)) if p not in at]
    while new:
        k, size = 1, len(new[0])
        while k < len(new) and size + len(new[k]) <= NEW:
            size += len(new[k])
            k += 1
        lattice.add(new[:k])
        new = new[k:]
    for key, parts in zip(keys, found, strict=True):
        parts_of.append(len(parts))
        seeds.append(mix64(np.uint64(row_seed(key, seed)) + np.arange(len(parts), dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)))
    nodes = np.fromiter(map(at.__getitem__, chain.from_iterable(found)), np.int64, sum(parts_of))
    flat, counts = lattice.sample(nodes, np.concatenate(seeds) if seeds else np.empty(0, np.uint64))
    ids, sizes = _expand(flat, lattice)
    of_part = np.concatenate(([0], np.cumsum(counts)))
    of_piece = np.concatenate(([0], np.cumsum(sizes)))
    bounds = of_piece[of_part[np.concatenate(([0], np.cumsum(parts_of))).astype(np.int64)]]
    return [ids[a:b].astype(np.int32) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


_kept: dict[tuple, Lattice] = {}


def _lattice(book: tuple, alpha: float, digest: str, nodes: int) -> Lattice:
    """The lattice of the model with this digest; a Python worker keeps one."""
    pieces, _, byte_ids = book
    name = (alpha, digest, nodes)
    if name not in _kept:
        _kept.clear()
        _kept[name] = Lattice(pieces, byte_ids, alpha, nodes)
    return _kept[name]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL, alpha: float = 1.0, seed: int = 0, keep_ids: bool = True, nodes: int = NODES) -> DataFrame:
    """key, n_pieces, ids_sha256 (of the ids as little-endian 32-bit numbers), lossless and, with ``keep_ids``, ids: a row for each document.

    ``nodes``: characters of distinct parts whose lattices a worker remembers; fewer take less memory and more time, and change no result.
    """
    spark = docs.sparkSession
    ship(spark)
    book = spark.sparkContext.broadcast(vocabulary(model))
    with open(model, "rb") as f:
        digest = hashlib.sha256(f.read()).hexdigest()
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, n_pieces bigint, ids_sha256 string, lossless boolean" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, raw = _lattice(book.value, alpha, digest, nodes), book.value[1]
        for batch in batches:
            column, a = batch.column(1), 0
            sizes = np.cumsum(pc.fill_null(pc.utf8_length(column), 0).to_numpy())
            while a < batch.num_rows:
                done = int(sizes[a - 1]) if a else 0
                b = max(a + 1, int(np.searchsorted(sizes, done + BLOCK, "right")))
                keys, texts = batch.column(0).slice(a, b - a), ["" if t is None else t for t in column.slice(a, b - a).to_pylist()]
                ids = encode_block(keys.to_pylist(), texts, lattice, seed)
                lists = [x.tolist() for x in ids]
                out = [
                    keys,
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids], pa.string()),
                    pa.array([b"".join([raw[i] for i in x])[1:] == t.encode() for x, t in zip(lists, texts, strict=True)], pa.bool_()),
                ]
                if keep_ids:
                    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))))
                yield pa.RecordBatch.from_arrays(out, [key, "n_pieces", "ids_sha256", "lossless", *["ids"] * keep_ids])
                a = b

    return rows.mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """key and text from the ids that ``encode`` made."""
    ship(encoded.sparkSession)
    book = encoded.sparkSession.sparkContext.broadcast(vocabulary(model)[1])
    rows = encoded.select(F.col(key).alias(key), F.col(ids).alias("ids"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else decode(x, book.value) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    return rows.mapInArrow(run, f"`{key}` {kind}, text string")
