"""Token counts that follow edits.

Each text is cut into leaves of about ``LEAF`` characters where a letter or digit is followed by a
space. Pre-tokens of the byte-level pattern never cross such a place, so the leaves' token counts add
up exactly. A segment tree over the leaves holds characters and tokens; an edit descends to the
leaves it touches, re-encodes only those and the leaves next to its boundaries, and updates the sums
on their paths.

Defined cases: a null text is empty; null or empty edit lists change nothing; an edit beyond the end
is clipped to the text, a null start or length is 0, a null insertion is empty; repeated rows are counted one by one; an
empty table gives an empty result; other columns are not read. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ship

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-token pattern of the vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 1000


def leaves(text: str, size: int = LEAF) -> list[str]:
    out, start = [], 0
    while (at := text.find(" ", start + size)) >= 0:
        if text[at - 1].isalnum():
            out.append(text[start:at])
            start = at
        else:
            nxt = at
            while nxt >= 0 and not text[nxt - 1].isalnum():
                nxt = text.find(" ", nxt + 1)
            if nxt < 0:
                break
            out.append(text[start:nxt])
            start = nxt
    out.append(text[start:])
    return out


class Tree:
    """Sums of characters and tokens over leaves."""

    def __init__(self, parts: list[str], counts: list[int]):
        self.parts, self.counts = parts, counts
        self.size = 1
        while self.size < len(parts):
            self.size *= 2
        self.chars = [0] * (2 * self.size)
        self.tokens = [0] * (2 * self.size)
        for i, (p, c) in enumerate(zip(parts, counts, strict=True)):
            self.chars[self.size + i], self.tokens[self.size + i] = len(p), c
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def put(self, i: int, part: str, count: int) -> None:
        self.parts[i], self.counts[i] = part, count
        i += self.size
        self.chars[i], self.tokens[i] = len(part), count
        while i > 1:
            i //= 2
            self._sum(i)

    def leaf_at(self, pos: int) -> tuple[int, int]:
        """The leaf of the character at ``pos`` and where the leaf starts."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if pos - start >= self.chars[i]:
                start += self.chars[i]
                i += 1
        return min(i - self.size, len(self.parts) - 1), start


def edit(tree: Tree, start: int, deleted: int, inserted: str, count) -> tuple[Tree, int]:
    """The tree after the edit, and how many characters were encoded anew."""
    total = tree.chars[1]
    start = min(max(start, 0), total)
    deleted = min(max(deleted, 0), total - start)
    if not deleted and not inserted:
        return tree, 0
    a, at = tree.leaf_at(max(0, min(start - 1, total - 1)))
    b, _ = tree.leaf_at(max(0, min(start + deleted, total - 1)))
    old = "".join(tree.parts[a : b + 1])
    new = old[: start - at] + inserted + old[start - at + deleted :]
    fresh = leaves(new)
    room = b + 1 - a
    if len(fresh) > room and len("".join(fresh[room - 1 :])) <= 4 * LEAF:
        fresh = [*fresh[: room - 1], "".join(fresh[room - 1 :])]
    counts = [count(x) for x in fresh]
    if len(fresh) <= room:
        for i in range(room):
            tree.put(a + i, *((fresh[i], counts[i]) if i < len(fresh) else ("", 0)))
        return tree, len(new)
    return Tree(tree.parts[:a] + fresh + tree.parts[b + 1 :], tree.counts[:a] + counts + tree.counts[b + 1 :]), len(new)


def count_edits(docs: DataFrame, edits: Column, key: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """key, n_chars, n_tokens, n_leaves before, and n_edits, n_chars_after, n_tokens_after, n_reencoded (characters) after the edits.

    ``edits`` is an array of structs (start, deleted, inserted) on the row of its document, in the
    order of application; positions are characters of the text at that time.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(ranks, "rb") as f:
        raw = f.read()
    book, digest = spark.sparkContext.broadcast(raw), hashlib.sha256(raw).hexdigest()
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("text"), edits.alias("edits"))
    kind = rows.schema[0].dataType.simpleString()
    names = ["n_chars", "n_tokens", "n_leaves", "n_edits", "n_chars_after", "n_tokens_after", "n_reencoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(book.value, digest)
        count = lambda t: len(encode(t))
        for batch in batches:
            out = []
            for t, changes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                parts = leaves(t or "")
                tree = Tree(parts, [count(p) for p in parts])
                row = [tree.chars[1], tree.tokens[1], len(parts), 0]
                redone = 0
                for c in changes or []:
                    if c is not None:
                        tree, n = edit(tree, c["start"] or 0, c["deleted"] or 0, c["inserted"] or "", count)
                        redone += n
                        row[3] += 1
                out.append([*row, tree.chars[1], tree.tokens[1], redone])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in zip(*out, strict=True)]], [key, *names])

    return rows.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{n} bigint" for n in names))


_encoder: dict = {}


def encoder(raw: bytes, digest: str = ""):
    """A text's token ids; a Python worker keeps one encoder, that of the ranks with this digest."""
    if digest not in _encoder:
        import base64

        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        _encoder.clear()
        _encoder[digest] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    return _encoder[digest]
