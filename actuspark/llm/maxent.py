"""A hashed maximum-entropy language model with a class-factored softmax.

log P(token | context) = log P(class | context) + log P(token | class).

* Classes: the ``OWN`` most frequent tokens are classes of one token each, the end of a text is one,
  and all other tokens, seen or not, fall into classes by a hash of their last bytes.
* P(class | context) is a softmax over sums of weights of hashed features: the previous token, the
  two previous tokens together, and the token before the previous one (a skip).
* P(token | class) has the token itself as its only feature, whose maximum-entropy solution is the
  smoothed relative count; the class's unseen tokens share one count of 0.5.

Training. Token counts come from all training texts: partial counts in the tasks, one shuffle by
token. The class weights are trained in ``ROUNDS`` rounds, each over its own part of all training
texts: every task takes gradient steps (AdaGrad, batches of ``BATCH`` tokens) from the weights of
the round before on its own texts, and Spark averages the weights by row in two levels. The model
has a fixed size (``TABLE_ROWS`` rows a feature), so what is broadcast or brought to the driver
does not grow with the corpus. Scoring runs in numpy over batches of texts; counts of frequent
tokens are broadcast (``FREQUENT`` at most, and always those of the end and of the ``OWN`` tokens),
those of all other tokens are joined by token.

Defined cases: a null text is empty and holds the end alone; a null id is no held-out one; repeated
rows are scored one by one and counted as often as they stand there; an empty table gives an empty
result; other columns are not read. Texts are read whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import LOWER_BYTES, byte_texts, mix64, save, ship

OWN, CLASSES = 40, 64
END_CLASS = CLASSES - 1
TABLE_ROWS, TABLES = 4096, 3
ROUNDS = 2
BATCH = 16_384
RATE = 0.15
FREQUENT = 131_072
SHARD = 256
#: Counts that a task holds before it sends them on.
HELD = 300_000
END = "\n"


def tokens(text: bytes) -> list[bytes]:
    return text.translate(LOWER_BYTES).split()


def held_out(key: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in c], pa.string()), pa.array(list(c.values()), pa.int64())], ["w", "n"])

    c: Counter = Counter()
    for batch in batches:
        for t in byte_texts(batch.column(0)):
            c.update(tokens(t))
            c[b"\n"] += 1
            if len(c) > HELD:
                yield out(c)
                c = Counter()
    if c:
        yield out(c)


def class_of(word: bytes) -> int:
    """The class of a token that is no class of its own."""
    return OWN + zlib.crc32(word[-3:]) % (END_CLASS - OWN)


class Book:
    """Frequent tokens with their counts, and the counts of each class."""

    def __init__(self, frequent: list[tuple[str, int]], total: int, distinct: int):
        frequent = [(w.encode(), n) for w, n in frequent]
        self.total, self.distinct = total, distinct
        words = [(w, n) for w, n in frequent if w != b"\n"]
        self.own = {w: i for i, (w, _) in enumerate(words[:OWN])} | {b"\n": END_CLASS}
        self.at = {w: i for i, (w, _) in enumerate(frequent)}
        self.count = np.array([n for _, n in frequent], np.float64)
        self.cls = np.array([self.class_of(w) for w, _ in frequent], np.int64)
        self.hash = np.array([zlib.crc32(w) for w, _ in frequent], np.uint64)
        self.end = self.at.get(b"\n", -1)
        self.floor = np.zeros(CLASSES)

    def class_of(self, w: bytes) -> int:
        k = self.own.get(w)
        return class_of(w) if k is None else k

    def floors(self, sums: dict[int, tuple[int, int]]) -> None:
        """log10 of each class's smoothed total, from its tokens and distinct tokens."""
        self.floor = np.array([np.log10(sums.get(k, (0, 0))[0] + 0.5 * (sums.get(k, (0, 0))[1] + 1)) for k in range(CLASSES)])

    def read(self, texts: list[bytes]):
        """Class, table rows of the features, place among the frequent tokens (-1: none) of each token; tokens of each text; rare words of each text."""
        at, sizes, codes, rare = self.at, [], [], []
        cls_rare, hash_rare = [], []
        for t in texts:
            ws = tokens(t)
            c = [at.get(w, -1) for w in ws]
            few = [w for w, k in zip(ws, c, strict=True) if k < 0]
            rare.append(few)
            cls_rare += [self.class_of(w) for w in few]
            hash_rare += [zlib.crc32(w) for w in few]
            c.append(self.end)
            if self.end < 0:
                cls_rare.append(END_CLASS)
                hash_rare.append(zlib.crc32(b"\n"))
            codes.append(np.array(c, np.int64))
            sizes.append(len(c))
        code = np.concatenate(codes)
        none = code < 0
        cls, h = np.empty(len(code), np.int64), np.empty(len(code), np.uint64)
        if len(self.at):
            cls, h = self.cls[code], self.hash[code]
        cls[none], h[none] = cls_rare, np.array(hash_rare, np.uint64)
        ends = np.cumsum(sizes)
        first = ends - sizes
        one = np.concatenate(([0], h[:-1])).astype(np.uint64)
        one[first] = 1
        two = np.concatenate(([0], one[:-1])).astype(np.uint64)
        two[first] = 2
        mask = np.uint64(TABLE_ROWS - 1)
        rows = np.stack([mix64(one) & mask, mix64(one * np.uint64(0x9E3779B97F4A7C15) + two) & mask, mix64(two * np.uint64(0xC2B2AE3D27D4EB4F)) & mask]).astype(np.int64)
        rows += np.arange(TABLES)[:, None] * TABLE_ROWS
        return cls, rows, code, np.array(sizes), rare


def scores(w: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log probabilities of all classes; the last row of ``w`` is the bias."""
    x = w[rows[0]] + w[rows[1]]
    x += w[rows[2]]
    x += w[-1]
    x -= x.max(axis=1, keepdims=True)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    return x


def descend(w: np.ndarray, seen: np.ndarray, square: np.ndarray, cls: np.ndarray, rows: np.ndarray, rate: float) -> None:
    """One gradient step over a batch of tokens."""
    g = np.exp(scores(w, rows))
    g[np.arange(len(cls)), cls] -= 1
    for r in (*rows, None):
        if r is None:
            at, sums, n = np.array([len(w) - 1]), g.sum(axis=0, keepdims=True), np.array([len(cls)])
        else:
            o = np.argsort(r.astype(np.uint16), kind="stable")
            own = r[o]
            heads = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            at, n = own[heads], np.diff(np.concatenate((heads, [len(own)])))
            sums = np.add.reduceat(g[o], heads, axis=0)
        square[at] += sums * sums
        seen[at] += n
        w[at] -= rate * sums / np.sqrt(square[at] + 1e-6)


def _train(batches: Iterator[pa.RecordBatch], book: Book, start: np.ndarray, rate: float) -> Iterator[pa.RecordBatch]:
    w, seen, square = start.copy(), np.zeros(len(start), np.int64), np.zeros_like(start)
    for batch in batches:
        texts = byte_texts(batch.column(0))
        for group in _groups(texts):
            cls, rows, *_ = book.read(group)
            for a in range(0, len(cls), BATCH):
                descend(w, seen, square, cls[a : a + BATCH], rows[:, a : a + BATCH], rate)
    part = TaskContext.get().partitionId()
    for k in range(0, len(w), SHARD):
        if seen[k : k + SHARD].any():
            n = seen[k : k + SHARD].astype(np.float64)
            yield _shard(part, k, w[k : k + SHARD].astype(np.float64) * n[:, None], n)


def _shard(part: int, k: int, sums: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([k], pa.int64()), pa.array([sums.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], ["part", "shard", "sums", "n"])


SHARDS = "part bigint, shard bigint, sums binary, n binary"


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by (part, shard) of rows that a shuffle brought together; one pair of arrays is held for each."""
    held: dict[tuple[int, int], list[np.ndarray]] = {}
    for batch in batches:
        for part, k, sums, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            got = [np.frombuffer(sums, np.float64), np.frombuffer(n, np.float64)]
            old = held.get((part, k))
            held[(part, k)] = got if old is None else [x + y for x, y in zip(old, got, strict=True)]
    for (part, k), (sums, n) in held.items():
        yield _shard(part, k, sums, n)


def _groups(texts: list[bytes], size: int = 2_000_000) -> Iterator[list[bytes]]:
    a = 0
    while a < len(texts):
        b, n = a, 0
        while b < len(texts) and (b == a or n + len(texts[b]) <= size):
            n += len(texts[b])
            b += 1
        yield texts[a:b]
        a = b


def _most_frequent(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """Tokens by falling count, at most ``most``: all whose count reaches a limit that a histogram of logarithms sets.

    A sort with a limit would bring ``most`` rows of every task to the driver. The end and the tokens
    that are classes of their own belong to them whatever the limit.
    """
    always = counts.orderBy(F.desc(F.col("w") == END), F.desc("n"), "w").limit(OWN + 1).collect()
    step = F.floor(F.log2("n") * 16)
    limit, n = None, 0
    for r in sorted(counts.groupBy(step.alias("b")).agg(F.count(F.lit(1)).alias("v")).collect(), key=lambda r: -r["b"]):
        n += r["v"]
        if n > most:
            break
        limit = r["b"]
    more = [] if limit is None else counts.where(step >= limit).collect()
    return sorted({r["w"]: r["n"] for r in [*always, *more]}.items(), key=lambda x: (-x[1], x[0]))


def fit(texts: DataFrame, rounds: int = ROUNDS, rate: float = RATE, frequent: int = FREQUENT) -> tuple[Book, np.ndarray, DataFrame]:
    """The book, the class weights and the counts of all tokens, from a table with the columns text and d."""
    spark = texts.sparkSession
    ship(spark)
    only = texts.select("text")
    counts = save(only.mapInArrow(_counts, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n")))
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    book = Book(_most_frequent(counts, frequent), sums["n"], sums["v"])
    own = spark.sparkContext.broadcast(book)

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = own.value
        for batch in batches:
            cls = np.array([b.class_of(w) for w in byte_texts(batch.column(0))])
            n = np.bincount(cls, batch.column(1).to_numpy(), CLASSES).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(n), pa.array(np.bincount(cls, minlength=CLASSES).astype(np.int64))], ["k", "n", "v"])

    found = counts.mapInArrow(classes, "k bigint, n bigint, v bigint").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    book.floors({r["k"]: (r["n"], r["v"]) for r in found})
    own = spark.sparkContext.broadcast(book)
    w = np.zeros((TABLES * TABLE_ROWS + 1, CLASSES), np.float32)
    for r in range(rounds):
        now = spark.sparkContext.broadcast(w)
        part = texts.where(F.pmod(F.xxhash64("d", F.lit("round")), F.lit(rounds)) == r).select("text")
        trained = part.mapInArrow(lambda b, now=now: _train(b, own.value, now.value, rate), SHARDS)
        trained = trained.withColumn("part", F.floor(F.col("part") / 32)).repartition("part", "shard").mapInArrow(_add_up, SHARDS)
        trained = trained.withColumn("part", F.lit(0).cast("bigint")).repartition("shard").mapInArrow(_add_up, SHARDS)
        for x in trained.collect():
            n = np.frombuffer(x["n"], np.float64)
            got = n > 0
            at = np.flatnonzero(got) + x["shard"]
            w[at] = (np.frombuffer(x["sums"], np.float64).reshape(-1, CLASSES)[got] / n[got, None]).astype(np.float32)
    return book, w, counts


def score(docs: DataFrame, book: Book, weights: np.ndarray, counts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each document."""
    spark = docs.sparkSession
    ship(spark)
    own = spark.sparkContext.broadcast((book, weights))
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("d"), F.xxhash64(text).alias("x"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, w = own.value
        log_count = np.log10(b.count + 0.5)
        for batch in batches:
            n_tokens, known, logs, model, rare = [], [], [], [], []
            for group in _groups(byte_texts(batch.column(3))):
                cls, feats, code, sizes, few = b.read(group)
                p = np.concatenate([scores(w, feats[:, a : a + BATCH])[np.arange(len(cls[a : a + BATCH])), cls[a : a + BATCH]] for a in range(0, len(cls), BATCH)]).astype(np.float64)
                p = p / np.log(10) - b.floor[cls]
                heads = np.cumsum(sizes) - sizes
                # The end may have no count at all when no text was trained on.
                c = np.where(code >= 0, log_count[code] if len(log_count) else 0.0, np.where(cls == END_CLASS, np.log10(0.5), 0.0))
                n_tokens += sizes.tolist()
                known += np.add.reduceat((code >= 0).astype(np.int64), heads).tolist()
                logs += np.add.reduceat(c, heads).tolist()
                model += np.add.reduceat(p, heads).tolist()
                rare += [[x.decode() for x in f] for f in few]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(logs, pa.float64()), pa.array(model, pa.float64()), pa.array(rare, pa.list_(pa.string()))],
                ["d", "x", "held_out", "n_tokens", "known", "logs", "model", "rare"],
            )

    made = save(rows.mapInArrow(run, f"d {kind}, x bigint, held_out boolean, n_tokens bigint, known bigint, logs double, model double, rare array<string>"))
    # Rare tokens meet their counts; equal rows bring equal words, so sums are divided by the number of such rows.
    words = made.select("d", "x", F.posexplode("rare").alias("p", "w"))
    met = words.join(counts, "w", "left")
    tail = met.groupBy("d", "x").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("tail"), F.count("n").alias("tail_known"), F.count_if(F.col("p") == 0).alias("copies"))
    tail = tail.select(F.col("d").alias("td"), F.col("x").alias("tx"), (F.col("tail") / F.col("copies")).alias("tail"), (F.col("tail_known") / F.col("copies")).cast("bigint").alias("tail_known"))
    out = made.drop("rare").join(tail, F.col("d").eqNullSafe(F.col("td")) & F.col("x").eqNullSafe(F.col("tx")), "left")
    logs = F.col("logs") + F.coalesce("tail", F.lit(0.0))
    floor = float(np.log10(book.total + 0.5 * (book.distinct + 1)))
    return out.select(
        F.col("d").alias(key),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(book.total).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * floor).alias("base_score"),
        (logs + F.col("model")).alias("score"),
    )


def score_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, rate: float = RATE, frequent: int = FREQUENT) -> DataFrame:
    """Learn from the documents that are not held out, and score all."""
    train = docs.where(~held_out(F.col(key))).select(F.col(text).alias("text"), F.xxhash64(key, text).alias("d"))
    return score(docs, *fit(train, rounds, rate, frequent), key, text)
