"""N-gram Jaccard join in the Jaccard metric space.

Documents are sets of word shingles; two link when their Jaccard similarity is at least
``per_cent``/100, that is when their Jaccard distance, a metric, is at most epsilon.

1. Coarse regions. Every shingle is a pivot (the set of itself alone). A document's nearest pivots
   are its shingles, and a global order (fewest documents first, then by hash; any order gives the
   same result) ranks them. A set within epsilon of a document can lack at most n - ceil(t n) of its
   shingles, so a document that is put into the regions of its first n - ceil(t n) + 1 pivots shares
   a region with each document that it links with. The counts come from all documents (in steps of an eighth of a doubling): each block of
   documents sends its shingles once to the slice of their hashes, and gets back those that other
   sets hold as well. A document whose own shingles alone fill the prefix links with nothing and
   leaves here; the others are few in a corpus of mostly different texts.
   Regions with the same members are one region.
2. Each document is compared with the pivot document (the least of a region) that most of its regions
   name, then with the next one. What links is one component and needs no comparison with each other.
3. Recursion. In regions with several components, documents outside the component of the region's
   least one become the next pivots, at most ``PIVOTS`` at a time, and are compared with the members
   of other components that the triangle inequality leaves (their distances to the region's first
   pivot differ by at most epsilon), until no document of a region is left. A round works on the
   open regions only. Regions of more than ``LARGE`` members are dealt out in parts, each with a copy
   of up to ``MANY`` pivots, which a member meets all at once.

Documents as pivots of the first level alone would not do: unrelated texts are all at a distance
near 1 of each other, so the windows would copy each document into every region.

Every comparison is exact, on 64-bit shingle hashes (of two texts, unequal shingles meet with a
chance below 1e-12). Equal sets are found by their digests and compared once.

Defined cases: a null text, or one without words, has no shingles and links with nothing; a null
id comes before all others (its component_id is null where it is the least); rows of one id are
told apart by their text; equal rows are one document with as many results; an empty table gives an
empty result; other columns are not read. The id is a whole number; ids of another type raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graph import components
from .shared import LOWER_BYTES, byte_texts, fresh_name, save, ship, whole_key
from .suffix import NULL_ID, pair

WORDS, PER_CENT = 5, 75
#: Pivot documents of a region in one round; in one of more than ``LARGE`` members, up to ``MANY`` with ``PIVOT_HASHES`` shingles in all.
PIVOTS, LARGE, MANY, PIVOT_HASHES = 64, 256, 1024, 2_000_000
#: Members of a large region that a task compares as one part.
PART = 2048
#: Pivots that each document meets one after another before the rounds.
TRIES = 2
#: A block sends at most so many documents of one shingle; of a shingle that more of them hold, it sends their number.
CAP = 16
#: Bytes and rows of text that a task holds as one block.
BLOCK_BYTES, BLOCK_ROWS = 4_000_000, 65_536
#: Slices of the hash space for each shuffle partition at least, and bytes of text for each slice at most (so a slice's hashes and counts take some 100 MB).
SLICES, SLICE_BYTES = 4, 32_000_000
#: Bits of a node's number for its place in its block, and for the block's place in its partition.
ORD_BITS, BLOCK_BITS = 28, 14


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of a text with fewer words, of all its words as one."""
    ws = text.translate(LOWER_BYTES).split()
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    k = min(words, len(ws))
    x = h[: len(h) - k + 1]
    for j in range(1, k):
        x = pair(x, h[j : len(h) - k + 1 + j])
    return np.unique(x)


def prefix_size(n, per_cent: int):
    return n - -(-n * per_cent // 100) + 1


def blocks(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[tuple[int, list, list[bytes]]]:
    """(block, ids, texts) of the rows (id, text) of a partition; block numbers are unique among all partitions and leave ``ORD_BITS`` bits for a row."""
    block = TaskContext.get().partitionId() << BLOCK_BITS
    last = block + (1 << BLOCK_BITS)
    for batch in batches:
        column, a = batch.column(1).cast(pa.binary()), 0
        sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy())
        while a < batch.num_rows:
            done = int(sizes[a - 1]) if a else 0
            b = min(a + BLOCK_ROWS, max(a + 1, int(np.searchsorted(sizes, done + most, "right"))))
            if block == last:
                raise ValueError("too many blocks in one partition; read with smaller partitions")
            yield block, [NULL_ID if d is None else d for d in batch.column(0).slice(a, b - a).to_pylist()], byte_texts(column.slice(a, b - a))
            block += 1
            a = b


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, so that the bytes that all share compress."""
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def _whole(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view(np.uint64).reshape(-1)


#: A row for a document (hashes null), or for shingles of a block: their hashes, the documents (ords) that
#: hold them and, once known, the levels of their counts; hashes without ords tell how many documents of a block hold them
#: (32-bit counts), and come back with the levels of the counts over all blocks.
POSTINGS = "at int, block bigint, ord int, d bigint, x bigint, n int, rep int, hashes binary, ords binary, counts binary"
_NAMES = [c.split()[0] for c in POSTINGS.split(", ")]
_KINDS = [{"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in POSTINGS.split(", ")]


def _batch(rows: int, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[k], t) if k in cols else pa.nulls(rows, t) for k, t in zip(_NAMES, _KINDS, strict=True)], _NAMES)


def _postings(batches: Iterator[pa.RecordBatch], words: int, slices: int) -> Iterator[pa.RecordBatch]:
    """The documents of each block, and the shingles of its distinct sets by slice."""
    for block, ids, texts in blocks(batches):
        x = [xxhash.xxh64_intdigest(t, 42) for t in texts]
        own, found, reps = [], {}, []
        for k, t in enumerate(texts):
            s = shingles(t, words)
            own.append(s)
            name = xxhash.xxh3_128_digest(s)
            first = found.setdefault(name, k) if len(s) else k
            if ids[k] < ids[first]:  # the least id stands for the set
                found[name] = k
            reps.append(name)
        rep = [found[name] if len(s) else k for k, (name, s) in enumerate(zip(reps, own, strict=True))]
        n = len(texts)
        yield _batch(n, at=[block % slices] * n, block=[block] * n, ord=range(n), d=ids, x=[v - ((v >> 63) << 64) for v in x], n=[len(s) for s in own], rep=rep)
        sets = [(k, s) for k, s in enumerate(own) if rep[k] == k and len(s)]
        if not sets:
            continue
        h = np.concatenate([s for _, s in sets])
        ord_ = np.repeat(np.array([k for k, _ in sets], np.uint16), [len(s) for _, s in sets])
        by_hash = np.argsort(h, kind="stable")
        heads = np.flatnonzero(np.concatenate(([True], h[by_hash][1:] != h[by_hash][:-1])))
        many = np.repeat(np.diff(np.concatenate((heads, [len(h)]))) >= CAP, np.diff(np.concatenate((heads, [len(h)]))))
        often = np.zeros(len(h), bool)
        often[by_hash[many]] = True
        if often.any():
            yield _batch(1, at=[block % slices], block=[block], hashes=[_planes(h[often])], ords=[ord_[often].tobytes()], counts=[np.zeros(often.sum(), np.uint8).tobytes()])
            known, inside = np.unique(h[often], return_counts=True)
            at, cuts = _cuts(known, slices)
            yield _batch(len(at), at=at, block=[block] * len(at), hashes=[_planes(known[a:b]) for a, b in cuts], counts=[inside[a:b].astype(np.uint32).tobytes() for a, b in cuts])
        h, ord_ = h[~often], ord_[~often]
        if len(h):
            order = np.argsort(_slice(h, slices), kind="stable")
            h, ord_ = h[order], ord_[order]
            at, cuts = _cuts(h, slices)
            yield _batch(len(at), at=at, block=[block] * len(at), hashes=[_planes(h[a:b]) for a, b in cuts], ords=[ord_[a:b].tobytes() for a, b in cuts])


def _slice(h: np.ndarray, slices: int) -> np.ndarray:
    return (((h >> np.uint64(40)) * np.uint64(slices)) >> np.uint64(24)).astype(np.int32)


def _cuts(h: np.ndarray, slices: int) -> tuple[list[int], list[tuple[int, int]]]:
    """The slices of hashes that are in the order of slices, and where each begins and ends."""
    of = _slice(h, slices)
    heads = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    return of[heads].tolist(), list(zip(heads.tolist(), [*heads[1:].tolist(), len(h)], strict=True))


def _level(count: np.ndarray) -> np.ndarray:
    """Counts as bytes, in steps of an eighth of a doubling."""
    return np.minimum(8 * np.log2(count), 255).astype(np.uint8)


def _groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[list[dict]]:
    """Rows of sorted partitions with one value of ``by``."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[by] != held[0][by]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by slice: the shingles that several sets hold, with their counts, for each block; other rows as they are."""

    def wanted() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = {c: batch.column(c).is_valid().to_numpy(zero_copy_only=False) for c in ("hashes", "ords", "counts")}
            ready = ~has["hashes"] | (has["ords"] & has["counts"])
            passed.append(batch.filter(pa.array(ready)))
            yield batch.filter(pa.array(~ready))

    passed: list[pa.RecordBatch] = []
    for group in _groups(wanted(), "at"):
        yield from passed
        passed.clear()
        hashes = [_whole(r["hashes"]) for r in group]
        sizes = [len(h) for h in hashes]
        h = np.concatenate(hashes)
        ords = np.concatenate([np.zeros(k, np.uint16) if r["ords"] is None else np.frombuffer(r["ords"], np.uint16) for r, k in zip(group, sizes, strict=True)])
        times = np.concatenate([np.frombuffer(r["counts"], np.uint32) if r["ords"] is None else np.ones(k, np.uint32) for r, k in zip(group, sizes, strict=True)])
        of = np.repeat(np.arange(len(group)), sizes)
        order = np.argsort(h, kind="stable")
        s = h[order]
        heads = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        counts = np.add.reduceat(times[order].astype(np.int64), heads)
        count = np.empty(len(h), np.int64)
        count[order] = np.repeat(counts, np.diff(np.concatenate((heads, [len(h)]))))
        go = np.flatnonzero(count > 1)
        if not len(go):
            continue
        of, turns = of[go], np.flatnonzero(np.diff(of[go])) + 1
        parts = list(zip([0, *turns.tolist()], [*turns.tolist(), len(go)], strict=True))
        yield _batch(
            len(parts),
            at=[group[0]["at"]] * len(parts),
            block=[group[of[a]]["block"] for a, _ in parts],
            hashes=[_planes(h[go[a:b]]) for a, b in parts],
            ords=[None if group[of[a]]["ords"] is None else ords[go[a:b]].tobytes() for a, b in parts],
            counts=[_level(count[go[a:b]]).tobytes() for a, b in parts],
        )
    yield from passed


PLACED = "node bigint, d bigint, x bigint, n int, rep bigint, set binary, keys array<bigint>"


def _placed(batches: Iterator[pa.RecordBatch], per_cent: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by block: the documents; those that may link with their regions (keys) and the shingles that other sets hold too (set)."""
    for group in _groups(batches, "block"):
        block = group[0]["block"] << ORD_BITS
        docs = sorted((r for r in group if r["hashes"] is None), key=lambda r: r["ord"])
        found = [r for r in group if r["ords"] is not None]
        told = [r for r in group if r["hashes"] is not None and r["ords"] is None]
        n = np.array([r["n"] for r in docs], np.int64)
        rep = np.array([r["rep"] for r in docs], np.int64)
        sets: list = [None] * len(docs)
        keys: list = [None] * len(docs)
        if found:
            h = np.concatenate([_whole(r["hashes"]) for r in found])
            ords = np.concatenate([np.frombuffer(r["ords"], np.uint16) for r in found]).astype(np.int64)
            counts = np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in found])
            if told:
                known = np.concatenate([_whole(r["hashes"]) for r in told])
                o = np.argsort(known, kind="stable")
                spot = o[np.minimum(np.searchsorted(known[o], h), len(known) - 1)]
                counts = np.where(known[spot] == h, np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in told])[spot], counts)
            shared = np.bincount(ords, minlength=len(docs))
            need = prefix_size(n, per_cent) - (n - shared)
            live = (need > 0) & (n > 0) & (rep == np.arange(len(docs)))
            on = live[ords]
            h, ords, counts = h[on], ords[on], counts[on]
            o = np.lexsort((h, counts, ords))
            h, ords = h[o], ords[o]
            heads = np.searchsorted(ords, np.arange(len(docs) + 1))
            for k in np.flatnonzero(live):
                own = h[heads[k] : heads[k + 1]]
                sets[k], keys[k] = np.sort(own).tobytes(), own[: need[k]].view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(docs)) + block), pa.array([r["d"] for r in docs], pa.int64()), pa.array([r["x"] for r in docs], pa.int64()), pa.array(n.astype(np.int32)),
                pa.array(rep + block), pa.array(sets, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
            ],
            ["node", "d", "x", "n", "rep", "set", "keys"],
        )


def _resolve(docs: DataFrame, key: str, text: str, words: int, per_cent: int, pivots: int, large: int = LARGE) -> DataFrame:
    """node, d, x, n and the component c of each document."""
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")).first()["bytes"]
    slices = min(max(SLICES * int(spark.conf.get("spark.sql.shuffle.partitions")), size // SLICE_BYTES), 1 << 24)
    rows = docs.select(whole_key(docs, key).alias("d"), F.col(text).alias("t"))
    placed = save(
        rows.mapInArrow(lambda b: _postings(b, words, slices), POSTINGS)
        .repartition("at")
        .sortWithinPartitions("at")
        .mapInArrow(_counted, POSTINGS)
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(lambda b: _placed(b, per_cent), PLACED)
    )
    # Equal sets of different blocks: all their shingles are shared ones.
    live = placed.where("set is not null")
    same = F.when(F.octet_length("set") == 8 * F.col("n"), F.md5("set")).otherwise(F.col("node").cast("string"))
    heads = save(live.select("node", same.alias("name")).join(live.groupBy(same.alias("name")).agg(F.min("node").alias("head")), "name").select("node", "head"))
    sets = live.join(heads.where("node = head").select("node"), "node", "left_semi")
    labels = link(sets.select("node", "n", shared_size("set"), F.explode("keys").alias("key")), sets.select("node", "n", "set"), per_cent, pivots, large)
    named = heads.join(labels.select(F.col("node").alias("head"), "component"), "head", "left").select(F.col("node").alias("rep"), F.coalesce("component", "head").alias("c"))
    return placed.select("node", "d", "x", "n", "rep").join(named, "rep", "left").withColumn("c", F.coalesce("c", "rep"))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, per_cent: int = PER_CENT, pivots: int = PIVOTS, large: int = LARGE) -> DataFrame:
    """key, n_shingles, component_id: a row for each document. ``key`` is a whole number."""
    out = save(_resolve(docs, key, text, words, per_cent, pivots, large).select("c", "d", "n"))
    first = out.groupBy("c").agg(F.min("d").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("c", "first")
    kind = docs.schema[key].dataType.simpleString()
    back = lambda c: F.nullif(c, F.lit(NULL_ID)).cast(kind)
    return out.join(first, "c", "left").select(back(F.col("d")).alias(key), F.col("n").cast("bigint").alias("n_shingles"), back(F.coalesce("first", "d")).alias("component_id"))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, per_cent: int = PER_CENT, pivots: int = PIVOTS) -> DataFrame:
    """The rows of ``docs`` without those that link, over any number of steps, with an earlier one; of equal rows one stays, and texts without words stay all that differ."""
    out = save(_resolve(docs, key, text, words, per_cent, pivots).select("c", "d", "x"))
    least = out.groupBy("c").agg(F.min("d").alias("d"))
    least = out.join(least, ["c", "d"], "left_semi").groupBy("c", "d").agg(F.min("x").alias("x"))
    d, x = fresh_name(docs, "kept_d"), fresh_name(docs, "kept_x")
    own = docs.withColumns({d: F.coalesce(whole_key(docs, key), F.lit(NULL_ID)), x: F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    return own.join(least.select(F.col("d").alias(d), F.col("x").alias(x)), [d, x], "left_semi").dropDuplicates([d, x]).drop(d, x)


def _may_link(a: str, b: str, per_cent: int) -> Column:
    """Whether sets of ``n`` shingles each, ``s`` of which another set may hold too, can link: they share at most the lesser s."""
    most = F.least(f"{a}s", f"{b}s")
    return 100 * most >= per_cent * (F.col(f"{a}n") + F.col(f"{b}n") - most)


def link(members: DataFrame, sets: DataFrame, per_cent: int, pivots: int = PIVOTS, large: int = LARGE) -> DataFrame:
    """(node, component) of all nodes that link with another.

    ``members`` has a row (key, node, n, s) for each region of a node, ``sets`` has (node, n, set): the
    size n of the node's set and the sorted hashes of all its shingles that another set may hold; s is their number.
    """
    placed, edges, labels = _regions(members), None, None
    size = placed.count()
    named = placed.where((F.col("node") != F.col("pivot")) & _may_link("", "p", per_cent)).groupBy("node", "pivot").agg(F.sum("times").alias("votes"))
    named = save(named.withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("votes"), "pivot"))).where(F.col("rank") <= TRIES), size)
    for k in range(1, TRIES + 1):
        pairs = named.where(F.col("rank") == k).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        if labels is not None:
            pairs = _labelled(pairs, labels, "a", "b").where("ca <> cb").select("a", "b")
        links = compare(pairs, sets, per_cent).where("links").select("a", "b")
        edges = links if edges is None else edges.unionByName(links)
        labels = save(components(edges, rows=size), size)
    now = _labelled(placed, labels, "node", "pivot").select("key", "node", "n", "s", "m", F.col("cnode").alias("c"), F.col("cpivot").alias("home"), F.lit(False).alias("done"), F.lit(None).cast("double").alias("far"))
    now, moves = save(_open(now), size), None
    size = now.count()
    if not size:
        return labels
    sets = save(sets.join(now.select("node").distinct(), "node", "left_semi"))
    first = True
    while size:
        chosen = _next_pivots(now, pivots, large, size)
        wide = F.col("m") > large
        met = now.where(~wide).join(chosen, "key").where((F.col("node") != F.col("p")) & (F.col("c") != F.col("pc")) & _may_link("", "p", per_cent))
        # A member without a distance to the first pivot has everything in its window.
        met = met.where(F.coalesce(F.abs(F.col("far") - F.col("pfar")) <= 1 - per_cent / 100 + 1e-9, F.lit(True)))
        judged = compare(met.select(F.col("node").alias("a"), F.col("p").alias("b")).distinct(), sets, per_cent)
        linked = judged.where("links").select("a", "b")
        if not now.where(wide).isEmpty():
            linked = linked.unionByName(_crowds(now.where(wide), chosen, sets, per_cent))
        linked = _labelled(linked, now.select("node", F.col("c").alias("component")).distinct(), "a", "b")
        fresh = save(linked.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), size)
        moves = fresh if moves is None else moves.unionByName(fresh)
        moved = components(fresh, rows=size)
        used = chosen.select("key", F.col("p").alias("node"), F.lit(True).alias("used"))
        now = now.join(used, ["key", "node"], "left").withColumn("done", F.col("done") | F.coalesce("used", F.lit(False))).drop("used")
        if first:
            gone = (1 - F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter"))).alias("away")
            now = now.join(chosen.where("rank = 1").select("key", F.col("p").alias("b")), "key", "left").join(judged.select(F.col("a").alias("node"), "b", gone), ["node", "b"], "left")
            now = now.withColumn("far", F.when(F.col("node") == F.col("b"), 0.0).otherwise(F.col("away"))).drop("b", "away")
            first = False
        now = _labelled(now, moved, "c", "home").drop("c", "home").withColumnsRenamed({"cc": "c", "chome": "home"})
        now = save(_open(now.select("key", "node", "n", "s", "m", "c", "home", "done", "far")), size)
        size = now.count()
    moved = save(components(moves))
    grown = labels.join(moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return grown.unionByName(moved.join(labels.select("node"), "node", "left_anti").select("node", "component"))


def _regions(members: DataFrame) -> DataFrame:
    """key, node, n, s of the members of regions with several of them, m (their number), the least one (pivot, pn, ps), and times: for how many equal regions a region stands."""
    names = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"name{k}") for k in (1, 2)]
    regions = members.groupBy("key").agg(F.min("node").alias("pivot"), F.min_by("n", "node").alias("pn"), F.min_by("s", "node").alias("ps"), F.count(F.lit(1)).alias("m"), *names).where("m > 1")
    sole = regions.groupBy("pivot", "pn", "ps", "m", "name1", "name2").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("times"))
    return save(members.join(sole.drop("name1", "name2"), "key"))


def _labelled(df: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
    """``df`` with the component of each of its columns of nodes, in a column with a c before its name; a node without a label is its own."""
    for x in columns:
        df = df.join(labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")), x, "left").withColumn(f"c{x}", F.coalesce(f"c{x}", x))
    return df


def _next_pivots(now: DataFrame, pivots: int, large: int, rows: int) -> DataFrame:
    """key, p, pn, ps, pc, pfar, rank: the next documents outside the component of their region's least one."""
    w = Window.partitionBy("key").orderBy("node")
    first = now.where("c <> home and not done").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= MANY)
    room = F.when(F.col("m") <= large, F.col("rank") <= pivots).otherwise((F.col("hashes") <= PIVOT_HASHES) | (F.col("rank") == 1))
    chosen = first.withColumn("hashes", F.sum("s").over(w)).where(room)
    return save(chosen.select("key", F.col("node").alias("p"), F.col("n").alias("pn"), F.col("s").alias("ps"), F.col("c").alias("pc"), F.col("far").alias("pfar"), "rank"), rows)


def _crowds(now: DataFrame, chosen: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """(a, b): links of members of large regions with pivots of other components, those of a part without the ones that join nothing new."""
    parts = F.ceil(F.col("m") / PART).cast("int")
    one = now.select("key", "node", "c", F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"), F.lit(1).alias("role"))
    heads = chosen.join(now.select("key", "m").distinct(), "key").select("key", F.col("p").alias("node"), F.col("pc").alias("c"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("role"))
    rows = one.unionByName(heads.select(*one.columns)).join(sets, "node")
    rows = rows.repartition("key", "part").sortWithinPartitions("key", "part", "role").select("key", "part", "role", "node", "c", "n", "set")
    return save(rows.mapInArrow(lambda b: _met_at_once(b, per_cent), "a bigint, b bigint"))


def _met_at_once(batches: Iterator[pa.RecordBatch], per_cent: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (key, part), the pivots first: the links of members with pivots that join components within the part."""
    at, heads, index, up = None, [], None, {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    for batch in batches:
        out: list[tuple[int, int]] = []
        for key, part, role, node, c, n, own in zip(*[x.to_pylist() for x in batch.columns], strict=True):
            s = np.frombuffer(own, np.uint64)
            if at != (key, part):
                at, heads, index, up = (key, part), [], None, {}
            if role == 0:
                heads.append((node, c, n, s))
                continue
            if index is None:
                h, of = np.concatenate([x[3] for x in heads]), np.repeat(np.arange(len(heads)), [len(x[3]) for x in heads])
                o = np.argsort(h, kind="stable")
                names, comps, sizes = (np.array([x[k] for x in heads]) for k in range(3))
                index = h[o], of[o]
            lo, hi = np.searchsorted(index[0], s, "left"), np.searchsorted(index[0], s, "right")
            size = hi - lo
            spots = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
            inter = np.bincount(index[1][spots], minlength=len(heads))
            hit = np.flatnonzero((100 * inter >= per_cent * (n + sizes - inter)) & (comps != c))
            for k in hit.tolist():
                if (x := root(c)) != (y := root(int(comps[k]))):
                    up[x] = y
                    out.append((node, int(names[k])))
        if out:
            a, b = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _open(now: DataFrame) -> DataFrame:
    """The members of regions in which a pivot is still to come."""
    return now.join(now.where("c <> home and not done").select("key").distinct(), "key", "left_semi")


def shared_size(column: str) -> Column:
    """The number of hashes in a set."""
    return F.shiftright(F.octet_length(column), 3).alias("s")


def compare(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """(a, b, na, nb, inter, links) of distinct pairs of nodes, exactly."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("set").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb")
    links = 100 * F.col("inter") >= per_cent * (F.col("na") + F.col("nb") - F.col("inter"))
    return save(both.mapInArrow(_overlaps, "a bigint, b bigint, na int, nb int, inter bigint").withColumn("links", links))


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        inter = []
        for s, t in zip(batch.column(4), batch.column(5), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (s, t))
            if len(x) > len(y):
                x, y = y, x
            inter.append(int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0)
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(inter, pa.int64())], ["a", "b", "na", "nb", "inter"])
