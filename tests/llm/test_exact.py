"""Exact dedup against grouping in plain Python, and its defined cases."""

import hashlib
from collections import defaultdict

import pytest

from actuspark.llm import exact

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KIND = "doc_id int, text string, k string, rest string, T int"


def brute(rows, keep):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        kept = [True] + [False] * (ids.count(best) - 1)
        for i in ids:
            out.append((i, best, len(ids), kept.pop(0) if i == best else False, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("k", "keep_id", "group_size", "kept", "text_sha256")) for r in df.collect()), key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_equals_grouping(spark, keep):
    texts = ["", None, "A b", "a B", "É", "é", "x" * 300_000, "X" * 300_000, "same start of sixteen 1", "same start of sixteen 2", " a b"]
    rows = [(n, texts[n % len(texts)]) for n in range(200)] + [(7, "a b"), (7, "a b"), (None, "a b"), (None, "only without id"), (None, "only without id")]
    # A large group of copies goes over several partitions and batches.
    rows += [(1000 + n, "Copy of a long passage") for n in range(2000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(i, t, "k", "r", 1) for i, t in rows], KIND).repartition(7)
        assert rows_of(exact.dedup(df, keep=keep)) == brute(rows, keep)
        left = exact.survivors(df, keep=keep)
        assert left.columns == df.columns
        assert left.count() == len({(t or "").translate(LOWER) for _, t in rows})
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_texts_with_one_hash_are_told_apart():
    """Neighbours are compared in full, and runs that share a mark with a batch's edge stay open."""
    import pyarrow as pa

    class Here:
        def partitionId(self):
            return 3

    batch = pa.RecordBatch.from_arrays([pa.array([5, 6, 1, 2, 9]), pa.array(["a", "a", "b", "b", "c"]), pa.array([1, 1, 1, 1, 2])], ["k", "t", "mark"])
    kept, exact.TaskContext = exact.TaskContext, type("T", (), {"get": staticmethod(Here)})
    try:
        (out,) = exact._runs(iter([batch]))
    finally:
        exact.TaskContext = kept
    assert out.column("keep_id").to_pylist() == [5, 5, 1, 1, 9] and out.column("n").to_pylist() == [2, 2, 2, 2, 1]
    assert out.column("run_text").to_pylist() == ["a", None, "b", None, "c"]
    assert len(set(out.column("run").to_pylist())) == 3


def test_empty_table_and_wrong_arguments(spark):
    df = spark.createDataFrame([], KIND)
    assert exact.dedup(df).count() == 0 and exact.survivors(df).columns == df.columns
    with pytest.raises(ValueError):
        exact.dedup(df, keep="both")
    with pytest.raises(TypeError):
        exact.dedup(df, key="text")
