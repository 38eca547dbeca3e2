"""Operators that work row by row, and the chat and language models."""

import base64
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from actuspark.llm import chat, decontam, edit_counts, jaccard, maxent, pieces, quality, queries, urls

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOCS)


def words(rng, n, odd=0.0):
    return [rng.choice("abcdefghij") + str(rng.randrange(30)) if rng.random() >= odd else rng.choice(["é▁x", "漢字", "\t", "🙂", "A-B", ""]) for _ in range(n)]


# Decontamination


def test_decontamination_by_brute_force(spark):
    rng = random.Random(2)
    items = [(i, " ".join(words(rng, rng.choice([1, 2, 5, 13, 14, 30])))) for i in range(25)] + [(90, None), (91, " - "), (None, "zz yy")]
    rows = []
    for i in range(120):
        ws = words(rng, rng.randrange(0, 150))
        for _ in range(rng.randrange(0, 3)):
            it = rng.choice(items[:25])[1].split()
            a = rng.randrange(len(it))
            ws[len(ws) // 2 : len(ws) // 2] = it[a : a + rng.randrange(1, 31)]
        rows.append((i, rng.choice([" ", "-", ", "]).join(w.upper() if rng.random() < 0.2 else w for w in ws)))
    rows += [(500, None), (501, ""), (5, rows[5][1]), (502, "ZZ, yy")]
    split = lambda t: decontam.words_of((t or "").encode())
    want = {}
    for d, t in rows:
        ws, hit, met = split(t), set(), set()
        for i, text in items:
            it = split(text)
            n = min(13, len(it))
            for w in {tuple(it[p : p + n]) for p in range(len(it) - n + 1)} if n else ():
                for p in range(len(ws) - n + 1):
                    if tuple(ws[p : p + n]) == w:
                        hit |= set(range(p, p + n))
                        met.add("" if i is None else str(i))
        want[d] = (len(ws), len(hit), sorted(met), len(hit) > 0 and 20 * len(hit) >= len(ws))
    for limit in (10**6, 40):
        bench = spark.createDataFrame(items, "item_id int, text string")
        found = decontam.find(docs(spark, rows), bench, shard_words=limit)
        got = decontam.verdicts(found).join(found.select("k", "items"), "k").distinct().collect()
        assert {r["k"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got} == want
    none = decontam.verdicts(decontam.find(docs(spark, rows), spark.createDataFrame([], "item_id int, text string")))
    assert none.where("contaminated or n_items > 0").count() == 0


def test_spans_are_cut_out():
    text = "One, two -- three four.\nFive".encode()
    assert decontam.strip_spans(text, [[1, 3]]) == b"One,  four.\nFive"


def test_spans_over_a_limit_go(spark):
    item = " ".join(f"b{i}" for i in range(20))
    rest = " ".join(f"w{i}" for i in range(1000))
    rows = [(1, f"{rest} {item}, end"), (2, f"start, short one {item}"), (3, rest), (4, None), (5, f"{rest} short one"), (6, ""), (3, rest), (7, "Short, ONE é")]
    bench = spark.createDataFrame([(1, item), (2, "short one")], "item_id int, text string")
    found = decontam.find(docs(spark, rows), bench, carry=("lang",))
    got = sorted(((r["k"], r["text"], r["n_cut"], r["rest"]["lang"]) for r in decontam.strip(decontam.verdicts(found)).collect()), key=str)
    want = [(1, f"{rest} , end", 20), (2, "start, ", 22), (3, rest, 0), (3, rest, 0), (4, None, 0), (5, f"{rest} short one", 0), (6, "", 0), (7, " é", 2)]
    assert got == sorted([(*w, "en") for w in want], key=str)
    assert decontam.strip(decontam.find(docs(spark, []), bench)).count() == 0


# Pieces


def test_pieces_are_lossless_and_reproducible(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, rng.randrange(0, 60), 0.2)) + rng.choice(["", "\n", "  ", " ▁ "])) for i in range(80)]
    rows += [(200, None), (None, "  two  spaces \n\n"), (None, None), (3, rows[3][1]), (201, "x" * 5000), (202, "▁▁ ▁")]
    got = pieces.encode(docs(spark, rows).repartition(3)).collect()
    assert all(r["lossless"] for r in got) and len(got) == len(rows)
    again = pieces.encode(docs(spark, rows[::-1]).coalesce(1)).collect()
    key = lambda r: (str(r["doc_id"]), r["ids"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    back = pieces.decode_ids(pieces.encode(docs(spark, rows))).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(d), t or "") for d, t in rows)


def test_the_query_returns_ids_that_decode(spark, tmp_path):
    rows = [(1, "two  words\n"), (2, None), (3, "é▁x 漢字")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op6_pieces(spark, str(tmp_path))
    assert sorted((r["doc_id"], r["text"]) for r in pieces.decode_ids(got).collect()) == [(d, t or "") for d, t in rows]


def test_samples_follow_the_lattice():
    """Frequencies of whole segmentations against their probabilities from enumeration."""
    vocab, _, byte_ids = pieces.vocabulary()
    lattice = pieces.Lattice(vocab, byte_ids, 1.0)
    text = "then"
    unit = " " + text
    ways = {}

    def walk(at, ids, weight):
        if at == len(unit):
            ways[tuple(ids)] = math.exp(weight)
        for k in range(at + 1, len(unit) + 1):
            if unit[at:k] in vocab:
                i, rank = vocab[unit[at:k]]
                walk(k, [*ids, i], weight - math.log(rank + 2))

    walk(0, [], 0.0)
    total, n = sum(ways.values()), 20_000
    got = Counter(tuple(x.tolist()) for x in pieces.encode_block(list(range(n)), [text] * n, lattice, 0))
    assert set(got) <= set(ways)
    for w, p in ways.items():
        assert abs(got[w] / n - p / total) < 0.02


def test_the_lattice_is_sorted_and_read_by_single_numbers(monkeypatch):
    """No sort by several keys, and edges by node, then by the start of the piece: all pieces that end there, odd characters as one."""
    vocab, _, byte_ids = pieces.vocabulary()
    lattice = pieces.Lattice(vocab, byte_ids, 1.0)
    monkeypatch.setattr(np, "lexsort", lambda *_: pytest.fail("sorted by several keys"))
    rng = random.Random(8)
    parts = sorted({" " + "".join(rng.choice("theandion漢🙂é") for _ in range(rng.randint(1, 30))) for _ in range(300)}) + ["a" * 3000, "\n\n"]
    lattice.add(parts[:200])
    lattice.add(parts[200:])
    for part in parts:
        for k in range(len(part) + 1):
            node = lattice.at[part] - len(part) + k
            a, b = lattice.head[node], lattice.head[node + 1] if node + 1 < lattice.n_nodes else lattice.n_edges
            starts = [i for i in range(max(0, k - lattice.longest), k) if part[i:k] in vocab or i == k - 1] if k else [None]
            assert [None if p < 0 else int(x) - node + k for x, p in zip(lattice.back[a:b], lattice.piece[a:b])] == starts
            assert (np.diff(lattice.key[a:b]) >= 0).all() and lattice.key[b - 1] == node + 1


# Token counts


def test_counts_after_edits(spark):
    rng = random.Random(8)
    with open(edit_counts.RANKS, "rb") as f:
        encode = edit_counts.encoder(f.read())
    rows = [(i, " ".join(words(rng, rng.choice([0, 3, 900, 3000]), 0.1))) for i in range(25)] + [(90, None), (91, "")]
    made = []
    for d, t in rows:
        changes = [(rng.randrange(-5, len(t or "") + 9), rng.choice([0, 1, 7, 2500, None]), rng.choice(["", " ", "x", "it's  \n", None, " ".join(words(rng, 700))])) for _ in range(rng.randrange(0, 7))]
        made.append((d, t, changes))
    df = spark.createDataFrame(made, "doc_id bigint, text string, edits array<struct<start:int,deleted:int,inserted:string>>")
    got = {r["doc_id"]: r for r in edit_counts.count_edits(df, F.col("edits")).collect()}
    for d, t, changes in made:
        t = t or ""
        assert (got[d]["n_chars"], got[d]["n_tokens"]) == (len(t), len(encode(t)))
        for a, k, s in changes:
            a = min(max(a, 0), len(t))
            t = t[:a] + (s or "") + t[a + (k or 0) :]
        assert (got[d]["n_chars_after"], got[d]["n_tokens_after"]) == (len(t), len(encode(t)))


# Quality and URLs


def test_quality_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b c a b c x"), (4, "w1 w2\n\nw1 w2\n w1 w2"), (None, " ".join(f"wörd{i}" for i in range(60))), (6, "# # $ | <x>")]
    got = {r["doc_id"]: r for r in quality.quality(docs(spark, rows), into="n_chars_").collect()}
    assert [got[d]["n_chars_"]["n_repeat_words"] for d in (1, 2, 3, 4)] == [0, 0, 6, 6]
    assert got[4]["n_chars_"]["n_dup_lines"] == 1 and got[6]["n_chars_"]["n_symbols"] == 6
    assert got[None]["kept"] and not got[1]["kept"]
    assert quality.quality(docs(spark, [])).count() == 0


def test_the_order_of_rules_never_changes_the_verdict(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng, rng.choice([5, 60, 200]), 0.1)) + "\n###" * rng.randrange(0, 40)) for i in range(40)]
    a = quality.quality(docs(spark, rows), rules=list(quality.RULES)).select("doc_id", "kept").collect()
    b = quality.quality(docs(spark, rows), rules=list(reversed(quality.RULES))).select("doc_id", "kept").collect()
    assert sorted(a) == sorted(b)
    assert sorted(r["doc_id"] for r in quality.keep(docs(spark, rows)).collect()) == sorted(r["doc_id"] for r in a if r["kept"])
    assert sorted(r.name for r in quality.order_rules(docs(spark, rows * 5))) == sorted(r.name for r in quality.RULES)


def test_a_rule_after_a_rejection_measures_nothing(spark):
    asked = quality.Rule("never", lambda f: F.raise_error(F.lit("measured")).cast("boolean"))
    short = quality.BASE_RULES[0]
    assert [r["kept"] for r in quality.quality(docs(spark, [(1, "a b"), (2, None)]), rules=[short, asked]).collect()] == [False, False]


def test_urls(spark):
    rules = spark.createDataFrame([("com", "/", "allow"), ("a.com", "/en/", "block"), ("net", "", "block"), (None, "/x", "block")], "host string, path string, verdict string")
    rows = [(1, "http://A.com/en/x?q"), (2, "http://b.a.com/en/"), (3, "https://xa.com/en/"), (4, None), (5, "no scheme"), (6, "http://q.net"), (7, "http://net#f"), (None, "http://a.com/en"), (1, "http://A.com/en/x?q"), (8, "://")]
    got = sorted((str(r["page_id"]), r["host"], r["path"], str(r["rule"]), r["verdict"]) for r in urls.classify(spark.createDataFrame([(p, u, "h") for p, u in rows], "page_id bigint, url string, host string"), rules).collect())
    assert got == sorted(
        [("1", "a.com", "/en/x", "a.com/en/", "block")] * 2
        + [("2", "b.a.com", "/en/", "a.com/en/", "block"), ("3", "xa.com", "/en/", "com/", "allow"), ("4", "", "", "None", "allow"), ("5", "", "", "None", "allow")]
        + [("6", "q.net", "", "net", "block"), ("7", "net", "", "net", "block"), ("None", "a.com", "/en", "com/", "allow"), ("8", "", "", "None", "allow")]
    )


# Chat


def test_roles_and_boundaries(spark):
    rng = random.Random(6)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, "assistant" if t % 2 else "user", "\n".join(" ".join(words(rng, rng.randrange(1, 40 if t % 2 else 8))) for _ in range(rng.randrange(1, 3)))))
    rows += [(999, t, "assistant" if t % 2 else "user", " ".join(words(rng, 5))) for t in range(600)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    raw = chat.transcripts(df)
    model = chat.fit(raw.where("conv_id % 5 <> 1"))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = chat.parse(raw.drop("role"), model).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    true = {(c, t): r for c, t, r, _ in rows}
    assert sum(true[(r["conv_id"], r["turn"])] == r["role"] for r in got if r["conv_id"] % 5 == 1) >= 0.97 * sum(r["conv_id"] % 5 == 1 for r in got)
    # One task gives the same as several.
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        alone = chat.parse(raw.drop("role"), model).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(str, alone)) == sorted(map(str, got))
    odd = spark.createDataFrame([(None, None, None), (None, 1, "User: hi"), (3, 0, "")], "conv_id bigint, turn bigint, text string")
    assert chat.parse(odd, model).count() == 3 and chat.parse(odd.limit(0), model).count() == 0


def test_viterbi_by_enumeration():
    rng = np.random.default_rng(3)
    norm = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    model = {"start": norm(rng.random(6)), "move": norm(rng.random((6, 6))), "emit": norm(rng.random((6, chat.CODES)))}
    import itertools

    codes = rng.integers(0, chat.CODES, 5)
    value = lambda s: model["start"][s[0]] + model["emit"][s[0], codes[0]] + sum(model["move"][a, b] + model["emit"][b, c] for a, b, c in zip(s, s[1:], codes[1:]))
    best = max(itertools.product(range(6), repeat=5), key=value)
    assert tuple(chat.viterbi(codes, model)) == best
    table = chat.chain(codes, model)
    assert np.isclose((model["start"][:, None] + table).max(), value(best))


# Language model


def test_base_scores_and_distribution(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice([["the", "Of", "and"], ["der", "und"]][i % 2]) + (" " + w) for w in words(rng, rng.randrange(0, 80)))) for i in range(300)]
    rows += [(900, None), (None, "the x"), (7, rows[7][1]), (901, "unseen-token")]
    df = docs(spark, rows)
    got = maxent.score_corpus(df, frequent=40).collect()
    split = lambda t: (t or "").lower().split() + ["\n"]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    c = Counter(w for d, t in rows if not held(d) for w in split(t))
    n, v = sum(c.values()), len(c)
    want = {(str(d), len(split(t)), sum(c[w] > 0 for w in split(t)), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in split(t)), 6)) for d, t in rows}
    assert {(str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got} == want
    assert len(got) == len(rows) and {r["train_tokens"] for r in got} == {n}
    out = [r for r in got if r["held_out"]]
    assert out and sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    # The probabilities of all tokens and of one unseen token of each class sum to one.
    train = df.where(~maxent.held_out(F.col("doc_id"))).select("text", F.col("doc_id").alias("d"))
    book, w, _ = maxent.fit(train, frequent=40)
    p = np.exp(maxent.scores(w, np.array([[5], [maxent.TABLE_ROWS + 9], [2 * maxent.TABLE_ROWS + 7]])))[0]
    seen = np.zeros(maxent.CLASSES)
    for x, k in c.items():
        seen[book.class_of(x.encode())] += k + 0.5
    assert np.isclose(sum(p * (seen + 0.5) / 10**book.floor), 1)
    assert maxent.score_corpus(docs(spark, [])).count() == 0


def test_the_forty_most_frequent_tokens_are_classes_of_their_own():
    book = maxent.Book([(f"w{i}", 1000 - i) for i in range(60)], 60_000, 60)
    own = {book.class_of(f"w{i}".encode()) for i in range(40)}
    assert len(own) == 40 and not own & {book.class_of(f"w{i}".encode()) for i in range(40, 60)}
    assert len({book.class_of(f"x{i}".encode()) for i in range(2000)}) == 23


def test_scores_do_not_depend_on_the_limit_of_frequent_tokens(spark):
    rng = random.Random(11)
    few = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(few) for _ in range(300))) for i in range(40)]
    df = docs(spark, rows)
    by = [{r["doc_id"]: r for r in maxent.score_corpus(df, frequent=n).collect()} for n in (1, 10**6)]
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 1
    c = Counter(w for d, t in rows if not held(d) for w in [*t.split(), "\n"])
    n, v = sum(c.values()), len(c)
    assert c["\n"] < min(k for w, k in c.items() if w != "\n")
    for d, t in rows:
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*t.split(), "\n"])
        for got in by:
            assert got[d]["n_known"] == got[d]["n_tokens"] == 301 and math.isclose(got[d]["base_score"], base, abs_tol=1e-6)
        assert math.isclose(by[0][d]["score"], by[1][d]["score"], abs_tol=1e-3)


# Pipeline


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(12)
    base = [" ".join(f"{w}q" for w in words(rng, 120)) for _ in range(12)]
    item = " ".join(f"bench{i}" for i in range(20))
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20, base[0]), (21, base[1] + " extra"), (22, base[2] + " " + item), (23, "too short"), (24, None), (25, base[3][:300] + " " + " ".join(f"u{i}" for i in range(90)))]
    rows += [(5, base[5])]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = docs(spark, rows)
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = out
        out = stage(spark, before, str(tmp_path))
        if name != "pieces":
            assert out.columns == before.columns
        kept.append(sorted(r["doc_id"] for r in out.select("doc_id").collect()))
    assert kept[0] == sorted([*range(12), 20, 21, 22, 25, 5])
    assert kept[1] == [*range(12), 25] or kept[1] == [*range(12), 22, 25]
    assert 22 not in kept[3] and kept[4] == kept[3]
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(got) == kept[4] and all(r["lossless"] for r in got.values())


def test_the_benchmark_stage_cuts_spans_out_of_kept_documents(spark, tmp_path):
    item, rest = " ".join(f"b{i}" for i in range(20)), " ".join(f"w{i}" for i in range(1000))
    rows = [(1, f"{rest} {item}, end", "en", "s", 7), (2, f"one two {item}", "en", "s", 7), (3, rest, None, "s", None), (None, None, "en", "s", 7), (5, "", "en", "s", 0)]
    before = spark.createDataFrame(rows, DOCS)
    spark.createDataFrame([(1, item)], "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.benchmark_stage(spark, before, str(tmp_path))
    assert out.schema.names == before.schema.names
    assert {r["doc_id"]: (r["text"], r["n_chars"], r["lang"]) for r in out.collect()} == {1: (f"{rest} , end", len(rest) + 6, "en"), 3: (rest, None, None), None: (None, 7, "en"), 5: ("", 0, "en")}


def test_kept_rows_use_sparks_hash(spark):
    import xxhash

    for t in ("", "a", "é" * 40):
        x = xxhash.xxh64_intdigest(t.encode(), 42)
        assert spark.range(1).select(F.xxhash64(F.lit(t)).alias("x")).first()["x"] == x - ((x >> 63) << 64)
    assert jaccard.prefix_size(100, 75) == 26


def test_quality_keeps_clashing_columns(spark):
    text = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(1, text, "a", "b", "c"), (2, "too few", "d", "e", "f")], "doc_id bigint, text string, __row string, __quality__words string, __kept string")
    assert [tuple(r) for r in quality.keep(df).collect()] == [(1, text, "a", "b", "c")]
