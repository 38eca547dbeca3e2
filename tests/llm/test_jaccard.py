import random

import pytest

from actuspark.llm import jaccard

SCHEMA = "doc_id bigint, text string, n_shingles string, d int"


def sets_of(text):
    ws = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    if not ws:
        return frozenset()
    k = min(5, len(ws))
    return frozenset(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))


def brute(rows):
    sets = [sets_of(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    low = {}
    key = lambda d: -(2**63) if d is None else d
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d, key=key)
    return sorted(((d, len(s), low[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "B", "ce", "dé", "eX", "f", "gg", "hi"]) + str(rng.randrange(40))
    docs = [[word() for _ in range(rng.choice([1, 3, 4, 5, 6, 30, 60, 120]))] for _ in range(60)]
    for _ in range(150):
        d = list(rng.choice(docs))
        for _ in range(rng.randrange(0, 4)):
            d[rng.randrange(len(d))] = word()
        docs.append(d)
    base = [word() for _ in range(100)]
    for _ in range(120):  # a large group of near copies
        d = list(base)
        for _ in range(rng.randrange(1, 4)):
            d[rng.randrange(len(d))] = word()
        docs.append(d)
    passage = [word() for _ in range(12)]
    docs += [[word() for _ in range(4)] + passage + [word() for _ in range(4)] for _ in range(40)]
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    rows += [(1000, None), (1001, " \n"), (None, rows[3][1]), (None, None), (5, rows[9][1]), (5, rows[5][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,pivots,large", [(1, 64, 256), (2, 16, 20)])
def test_same_components_as_brute_force(spark, seed, pivots, large):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(5)
    got = jaccard.join(df, pivots=pivots, large=large).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows)


def test_empty_table(spark):
    assert jaccard.join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_columns_of_the_input_keep_their_values(spark):
    rows = [(1, "a b c d e f", "mine", 7), (2, "a b c d e f", "other", 8), (None, "x", "third", 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept_d string, kept_x int")
    got = sorted(jaccard.representatives(df).collect(), key=str)
    assert [tuple(r) for r in got] == [rows[0], rows[2]]
    with pytest.raises(TypeError):
        jaccard.join(df, key="kept_d")
