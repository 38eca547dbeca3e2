import random

from actuspark.llm import paragraphs, queries

from .test_jaccard import sets_of

SCHEMA = "doc_id bigint, text string, paragraph string, d int"


def brute(rows):
    """(doc, line, first doc, first line) of each paragraph."""
    key = lambda d: -(2**63) if d is None else d
    ps = [(d, i, sets_of(t)) for d, text in rows for i, t in enumerate((text or "").split("\n")) if len(t.split()) >= 5]
    up = list(range(len(ps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ps)):
        for j in range(i):
            a, b = ps[i][2], ps[j][2]
            if 100 * len(a & b) >= 75 * len(a | b):
                up[root(i)] = root(j)
    low = {}
    for i, (d, n, _) in enumerate(ps):
        low[root(i)] = min(low.get(root(i), (d, n)), (d, n), key=lambda x: (key(x[0]), x[1]))
    return sorted(((d, n, *low[root(i)]) for i, (d, n, _) in enumerate(ps)), key=str)


def test_classes(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdef") + str(rng.randrange(50))
    lines = [[word() for _ in range(rng.choice([2, 5, 8, 20, 60]))] for _ in range(60)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(rng.randrange(0, 5)):
            d = list(rng.choice(lines))
            if len(d) > 50 and rng.random() < 0.7:
                d[rng.randrange(len(d))] = word()
            own.append(" ".join(d))
        rows.append((i, "\n".join(own)))
    rows += [(None, rows[4][1]), (None, None), (90, "")]
    got = paragraphs.dedup(spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(4)).collect()
    assert sorted(((r["doc_id"], r["paragraph"], r["class_doc"], r["class_paragraph"]) for r in got), key=str) == brute(rows)
    assert all(r["removed"] == ((r["doc_id"], r["paragraph"]) != (r["class_doc"], r["class_paragraph"])) for r in got)


def test_recall_of_the_tuned_bands():
    bands, rows = paragraphs.tune(0.75)
    assert 1 - (1 - 0.75**rows) ** bands >= paragraphs.RECALL


def test_empty_table(spark):
    assert paragraphs.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_query_takes_short_lines(spark, tmp_path):
    rows = [(1, "Read more\n\nread  MORE\nmore read\nread more now"), (2, " \nread more\nend"), (3, "end")]
    spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["doc_id"], r["paragraph"]): (r["n_shingles"], r["class_doc"], r["class_paragraph"], r["removed"]) for r in queries.op3_paragraph_dedup(spark, str(tmp_path)).collect()}
    assert got == {
        (1, 0): (1, 1, 0, False), (1, 2): (1, 1, 0, True), (1, 3): (1, 1, 3, False), (1, 4): (1, 1, 4, False),
        (2, 1): (1, 1, 0, True), (2, 2): (1, 2, 2, False), (3, 0): (1, 2, 2, True),
    }


def brute_passages(rows, least):
    """(doc, line, first word, words, first doc, its line) of each passage; ids are told apart by nothing else here."""
    seen, found = {}, []
    for d, text in sorted({(-(2**63) if d is None else d, t or "") for d, t in rows}):
        at = [(i, j) for i, line in enumerate(text.split("\n")) for j, _ in enumerate(line.split())]
        words = text.lower().split()
        first = {i: f for i in range(len(words) - least + 1) if (f := seen.setdefault(tuple(words[i : i + least]), (d, at[i][0])))[0] < d}
        runs = []
        for i in sorted(first):
            if not runs or i > runs[-1][1]:
                runs.append([i, 0])
            runs[-1][1] = i + least
        found += [(d, *at[a], b - a, *first[a]) for a, b in runs]
    return sorted(found)


def marked(df):
    """The passages of a result, as ``brute_passages`` gives them, and its lines."""
    id_of = lambda d: -(2**63) if d is None else d
    rows = df.collect()
    assert all(r["removed"] for r in rows if r["n_shingles"] is None)
    return sorted((id_of(r["doc_id"]), r["paragraph"], r["first_word"], r["n_words"], id_of(r["class_doc"]), r["class_paragraph"]) for r in rows if r["n_shingles"] is None), [r for r in rows if r["n_shingles"] is not None]


def test_passages_within_lines(spark, tmp_path):
    rng = random.Random(5)
    words = lambda n: [f"{rng.choice('abcdef')}{rng.randrange(400)}" for _ in range(n)]
    stock, circle = [words(n) for n in (50, 51, 52, 80, 200)], words(3)
    rows = []
    for i in range(60):
        own = words(rng.randrange(0, 120))
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(stock)
            a = rng.randrange(0, max(1, len(p) - 60))
            own += p[a : a + rng.choice([51, 60, 500])] + words(rng.randrange(0, 90))
        if i % 15 == 0:
            own += circle * rng.randrange(10, 900)
        text = "".join(w + rng.choice([" "] * 40 + ["\n", "\n\n", " \n"]) for w in own)
        rows.append((i, text.upper() if i % 7 == 0 else text))
    rows += [(None, " ".join(words(30) + stock[3] + words(30))), (99, None), (100, ""), (101, " ".join(words(9) + stock[1]))]
    expected = brute_passages(rows, 51)
    assert len(expected) > 40
    spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got, lines = marked(queries.op3_paragraph_dedup(spark, str(tmp_path)))
    assert got == expected
    assert any(f > 0 for _, _, f, *_ in got)
    plain = paragraphs.dedup(spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA), min_words=1).collect()
    assert sorted(map(str, lines)) == sorted(map(str, plain))
    assert all(r["first_word"] == 0 and r["n_words"] == len(dict(rows)[r["doc_id"]].split("\n")[r["paragraph"]].split()) for r in plain)


def test_passages_of_equal_rows_and_ids(spark):
    rng = random.Random(7)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    p, own = words(51), words(20)
    rows = [(1, f"{p} {own}"), (1, f"{p} {own}"), (2, f"{own[:9]} {p}"), (2, f"{own[:9]} {p}"), (3, f"{p[3:]} {own} {p[3:]}"), (4, f"{words(5)}\n{p}"), (4, f"{words(5)} {p} {words(5)}")]
    got, _ = marked(paragraphs.dedup(spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA), passage_words=51))
    assert [r[0] for r in got] == [2, 2, 3, 4, 4] and all(r[4:] == (1, 0) for r in got)
    none, _ = marked(paragraphs.dedup(spark.createDataFrame([(1, f"{own} {own} {own} {own} {own} {own}"), (2, words(300))], "doc_id bigint, text string"), passage_words=51))
    assert none == []
    assert paragraphs.dedup(spark.createDataFrame([], SCHEMA), passage_words=51).count() == 0
