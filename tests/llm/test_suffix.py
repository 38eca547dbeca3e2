import hashlib
import random

import pytest

from actuspark.llm import suffix

SCHEMA = "doc_id bigint, text string, kept string, d int"


def brute(rows, length=100):
    """By (id, text): bytes, removed bytes, removed runs, digest of the rest."""
    first = {}
    key = lambda d: -(2**63) if d is None else d
    for d, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            first[w] = min(first.get(w, (key(d), s)), (key(d), s))
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < (key(d), s):
                gone[s : s + length] = b"\x01" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out[(d, t)] = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def text(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


def corpus():
    rng = random.Random(5)
    docs = [(i, text(rng, rng.randint(1, 120))) for i in range(40)]
    passage = text(rng, 40)
    for i in range(40, 80):
        base = docs[rng.randrange(40)][1]
        at = rng.randrange(len(base))
        docs.append((i, base[:at] + rng.choice(["", "X", passage]) + base[at + rng.randint(0, 9) :]))
    docs += [(80 + i, text(rng, 10) + passage + text(rng, 10)) for i in range(30)]
    docs += [(120, "ab" * 400), (121, "Esshor " * 90), (122, "a" * 99), (123, "a" * 100), (124, "a" * 101), (125, None), (126, ""), (None, passage), (None, None)]
    docs += [(7, docs[7][1]), (7, docs[7][1]), (3, docs[9][1])]
    return docs


@pytest.mark.parametrize("group,chunk", [(2000, 4_000_000), (3, 150)])
def test_removes_what_brute_force_removes(spark, group, chunk):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(6)
    got = suffix.dedup(df, group=group, chunk=chunk).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    mine = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], str(r["doc_id"])) for r in got)
    assert mine == sorted((*want[(d, t)], str(d)) for d, t in rows)
    for r in got:
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


def test_empty_table(spark):
    assert suffix.dedup(spark.createDataFrame([], SCHEMA)).count() == 0
