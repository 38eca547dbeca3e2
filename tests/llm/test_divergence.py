"""The divergence audit against exact arithmetic in plain Python, and its defined cases."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from actuspark.llm import divergence

KIND = "doc_id int, text string, lang string, source string, term string, n int"


def brute(rows, min_docs, k):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.add((lang or "", source or ""))
        count[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang, source in groups:
        kept = sorted(t for t, d in docs[lang].items() if d >= min_docs)
        v = len(kept)
        total = lambda c: sum(c[t] for t in kept)
        share = lambda c, t: 1 + 10**9 * (c[t] + 2) // (total(c) + 2 * v)
        mine, all_of = count[lang, source], Counter()
        for (own, _), c in list(count.items()):
            if own == lang:
                all_of.update(c)
        found = []
        for own, other in groups:
            if own == lang and other != source:
                theirs = count[lang, other]
                found.append((other, sum((share(mine, t) - share(theirs, t)) ** 2 // (share(mine, t) + share(theirs, t)) for t in kept)))
        ranked = lambda x: sorted(x, key=lambda y: (-y[1], y[0].encode()))
        out += [(lang, source, "pair", i, f, r + 1) for r, (i, f) in enumerate(ranked(found))]
        over = [(t, (share(mine, t) - share(all_of, t)) ** 2 // (share(mine, t) + share(all_of, t))) for t in kept if mine[t] and share(mine, t) > share(all_of, t)]
        out += [(lang, source, "term", i, f, r + 1) for r, (i, f) in enumerate(ranked(over)[:k])]
    return sorted(out)


def test_equals_exact_arithmetic(spark):
    rnd = random.Random(3)
    words = [f"w{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(120)] + ["Éa", "éa", "日本", "z"]
    rows = []
    for n in range(400):
        lang, source = rnd.choice([("en", "a"), ("en", "b"), ("en", "c"), ("de", "a"), ("de", None), (None, "x"), ("fr", "only")])
        lo = {"a": 0, "b": 30}.get(source, 10)
        rows.append((" ".join(rnd.choices(words[lo : lo + 70] + words[-4:], k=rnd.randint(0, 40))), lang, source))
    rows += [(None, "en", "d"), ("", "it", "p"), ("rare", "it", "q"), ("A1b2C " * 20, "en", "a"), ("long " * 300_000, "en", "b")] + [("same same", "en", "a")] * 3
    df = spark.createDataFrame([(n, *r, "clash", 1) for n, r in enumerate(rows)], KIND).repartition(5)
    for k in (2, 10):
        got = sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.audit(df, min_docs=10, k=k).collect())
        assert got == brute(rows, 10, k)
    # Blocks of two sources give the same sums.
    groups, cells = divergence.shares(df)
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(divergence.pairs(groups, cells, block=2)) == key(divergence.pairs(groups, cells))


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], KIND)).count() == 0


def test_skyband_keeps_what_fewer_than_k_dominate():
    rnd = random.Random(5)
    rows = [("l", s, f"t{n:03}", rnd.randint(1, 9), rnd.randint(1, 12)) for s in "ab" for n in range(150)]
    rows.sort(key=lambda r: (r[1], -r[3], r[4], r[2]))
    names = ["lang", "source", "term", "n", "lang_n"]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names)
    for k in (1, 4):
        got = {(r["source"], r["term"]) for b in divergence._skyband(iter([batch.slice(0, 70), batch.slice(70)]), k) for r in b.to_pylist()}
        over = lambda a, b: a[1] == b[1] and a[3] >= b[3] and a[4] <= b[4] and a[2] < b[2]
        assert got == {(b[1], b[2]) for b in rows if sum(over(a, b) for a in rows) < k}
        assert len(got) < len(rows) / 2


def test_shares_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = 10**13
    df = spark.createDataFrame([(big, 3 * big, 7)], "n bigint, total bigint, v bigint")
    assert df.select(divergence._share(F.col("n"), F.col("total"), F.col("v"))).first()[0] == 1 + 10**9 * (big + 2) // (3 * big + 14)
