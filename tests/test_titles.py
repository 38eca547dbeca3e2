"""Fuzzy title joins against all pairs, by the standard library's matcher."""

import random
import re
from difflib import SequenceMatcher

import pytest
from actuspark.operators import titles

L, R = "id int, a string", "rid int, title string"


def norm(s):
    return re.sub("[^a-z0-9]+", " ", (s or "").lower()).strip()


def brute(left, right, threshold=0.38, overlap=50):
    out = []
    for k, a in left:
        best = None
        for r, b in right:
            x, y = norm(a), norm(b)
            u, v = set(x.split()), set(y.split())
            if not u or not v or 200 * len(u & v) < overlap * (len(u) + len(v)):
                continue
            score = SequenceMatcher(None, x, y).ratio()
            if score >= threshold and (best is None or (-score, y, b, r) < best):
                best = (-score, y, b, r)
        if best:
            out.append((k, a, best[3], best[2], -best[0]))
    return sorted(out)


def made(seed, n, words=40, longest=22):
    """Titles over a small vocabulary; "show" stands in most of them."""
    rng = random.Random(seed)
    return [(k, " ".join(["Show"] * (rng.random() < 0.8) + [f"w{int(rng.paretovariate(0.6)) % words}x" for _ in range(rng.randint(0, longest))])) for k in range(n)]


@pytest.mark.parametrize("overlap", [30, 50, 80, 100])
def test_equals_all_pairs(spark, overlap):
    left, right = made(1, 120) + [(500, None), (501, "!?"), (502, "Show"), (502, "Show")], made(2, 120) + [(600, "show!"), (601, "SHOW"), (602, None), (603, "")]
    got = titles.fuzzy_match(spark.createDataFrame(left, L), spark.createDataFrame(right, R), "a", "title", overlap=overlap)
    want = brute(left, right, overlap=overlap)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 5


def test_a_word_of_all_titles_makes_no_pairs(spark):
    """1,500 titles on each side share one word and two by two another three."""
    frame = lambda s: spark.createDataFrame([(f"{s}{k}", f"show n{k} o{k} p{k}") for k in range(1500)], "id string, title string")
    got = titles.title_pairs(frame("l"), frame("r")).select("l", "r").collect()
    assert sorted((r["l"][1:], r["r"][1:]) for r in got) == sorted((str(k), str(k)) for k in range(1500))
    keys = titles._keys(frame("l").selectExpr("id", "split(concat_ws(' ', slice(split(title, ' '), 2, 3), 'show'), ' ') as words"), 50, "own", "other")
    assert {r["other"] for r in keys.where("word = 'show'").collect()} <= {2}


def test_long_and_empty(spark):
    long = " ".join(f"t{k}" for k in range(3000))
    left, right = [(1, long), (2, long[: len(long) // 2])], [(7, long + " end")]
    assert sorted(tuple(r) for r in titles.fuzzy_match(spark.createDataFrame(left, L), spark.createDataFrame(right, R), "a", "title").select("id", "rid").collect()) == [(1, 7), (2, 7)]
    assert titles.fuzzy_match(spark.createDataFrame([], L), spark.createDataFrame(right, R), "a", "title").collect() == []
    assert titles.fuzzy_match(spark.createDataFrame(left, L), spark.createDataFrame([], R), "a", "title").collect() == []
    with pytest.raises(ValueError):
        titles.fuzzy_match(spark.createDataFrame(left, L), spark.createDataFrame(left, L), "a", "a")


@pytest.mark.parametrize(("overlap", "alone"), [(20, 3), (50, 0)])
def test_pairs_of_frequent_words(spark, overlap, alone):
    """Every pair that shares enough words, once, however many titles a word may have to be a key alone."""
    sides = [{norm(t) for _, t in made(s, 150, 30, 9)} - {""} for s in (3, 4)]
    frame = lambda s: spark.createDataFrame([(t, t) for t in sorted(s)], "id string, title string")
    got = sorted((r["l"], r["r"]) for r in titles.title_pairs(frame(sides[0]), frame(sides[1]), overlap, alone).collect())
    held = {t: set(t.split()) for s in sides for t in s}
    want = sorted((x, y) for x in sides[0] for y in sides[1] if 200 * len(held[x] & held[y]) >= overlap * (len(held[x]) + len(held[y])))
    assert got == want and len(want) > 20


def test_pairs_that_meet_are_not_shuffled(spark):
    """Pairs of short titles are whole and single as they leave the join of the keys, and the scores are computed once."""
    left, right = spark.createDataFrame(made(5, 60), L), spark.createDataFrame(made(6, 60), R)
    pairs = titles.title_pairs(*[df.selectExpr("k as id", "t as title") for df in (left.toDF("k", "t"), right.toDF("k", "t"))])
    keyed = pairs._jdf.queryExecution().optimizedPlan().toString().split("Union")[0]
    assert "Aggregate" not in keyed
    plan = titles.fuzzy_match(left, right, "a", "title")._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.splitlines() if "EvalPython" in x]) == 1
