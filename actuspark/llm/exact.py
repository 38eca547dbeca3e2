"""Exact deduplication by a sort of contents.

Texts are compared after lower-casing A-Z. Spark samples splitters and deals the rows out by range; a
splitter holds the first characters of a text, its 64-bit hash and the row's id, so splitters have a
bounded size however long the texts are, and thousands of copies of one text are cut by id into
several ranges. Each range is sorted externally by start, hash, whole text and id, which places equal
texts side by side. One pass over the sorted rows compares neighbours in full and closes runs of equal
texts at the end of each batch. Only the runs at the edges of batches can go on elsewhere: their texts,
one for each run, are grouped in full, and their rows get the group's figures by a join on the run.

Defined cases: a null text is empty; rows without an id stay only if no row with an id has their text,
and one of them stays then; of repeated rows (the same id and text) one stays; ids must be whole numbers; an
empty table gives no rows; a text of any length is one value; columns ``carry`` follow in a struct rest
and can have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import lower_ascii, save, ship, whole_key

#: Characters of a text that a splitter holds.
START = 16
_SCHEMA = "k bigint, keep_id bigint, n bigint, first boolean, sha binary, run bigint, run_text string"


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest", carry: tuple[str, ...] = ()) -> DataFrame:
    """k, keep_id (the id that stays), group_size, kept and text_sha256 (of the normalised text), a row for each document.

    ``keep``: whether the smallest or the largest id of equal texts stays.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep}")
    ship(docs.sparkSession)
    ids = F.col("k").asc_nulls_last() if keep == "smallest" else F.col("k").desc_nulls_last()
    rest = [F.struct(*[F.col(c) for c in carry]).alias("rest")] if carry else []
    rows = docs.select(whole_key(docs, key).alias("k"), lower_ascii(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("t"), *rest)
    rows = rows.withColumns({"start": F.substring("t", 1, START), "mark": F.xxhash64("t")})
    placed = rows.repartitionByRange("start", "mark", ids).sortWithinPartitions("start", "mark", "t", ids).drop("start")
    schema = _SCHEMA + (f", rest {rows.schema['rest'].dataType.simpleString()}" if carry else "")
    runs = save(placed.mapInArrow(_runs, schema))

    edges = runs.where("run_text is not null").select("run", "run_text", "keep_id", "n")
    first = F.min_by if keep == "smallest" else F.max_by
    least = F.struct(F.col("keep_id").isNull() if keep == "smallest" else F.col("keep_id").isNotNull(), "keep_id", (F.col("run") if keep == "smallest" else -F.col("run")).alias("r"))
    groups = edges.groupBy("run_text").agg(first(F.struct("keep_id", "run"), least).alias("best"), F.sum("n").alias("group_size"))
    whole = edges.join(groups, "run_text").select("run", F.col("best.keep_id").alias("keep_id"), F.col("best.run").alias("kept_run"), "group_size")

    out = ["k", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"), *["rest"] * bool(carry)]
    inner = runs.where("run is null").withColumns({"group_size": F.col("n"), "kept": F.col("first")})
    outer = runs.where("run is not null").drop("keep_id").join(whole, "run").withColumn("kept", F.col("first") & (F.col("run") == F.col("kept_run")))
    return inner.select(*out).unionByName(outer.select(*out))


def survivors(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    return dedup(docs, key, text, keep, carry=tuple(docs.columns)).where("kept").select(*[F.col("rest")[c].alias(c) for c in docs.columns])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal texts in sorted rows; a run that may go on outside its batch gets a number, and its first row the text."""
    number = TaskContext.get().partitionId() << 36
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        t, mark = batch.column("t").cast(pa.binary()), batch.column("mark").to_numpy()
        new = np.ones(n, bool)
        for i in np.flatnonzero(mark[1:] == mark[:-1]).tolist():
            new[i + 1] = not t[i].as_buffer().equals(t[i + 1].as_buffer())
        start = np.flatnonzero(new)
        of = pa.array(np.cumsum(new) - 1)
        # Texts with the mark of the first or last row may have equals in other batches.
        edge = (mark[start] == mark[0]) | (mark[start] == mark[-1])
        named = pa.array(number + np.arange(len(start)), mask=~edge)
        number += len(start)
        sha = pa.array([hashlib.sha256(t[i].as_buffer()).digest() for i in start.tolist()], pa.binary())
        size = pa.array(np.diff(np.append(start, n)))
        shown = pa.array(new & edge[np.cumsum(new) - 1])
        arrays = [
            batch.column("k"),
            batch.column("k").take(pa.array(start)).take(of),
            size.take(of),
            pa.array(new),
            sha.take(of),
            named.take(of),
            pc.if_else(shown, batch.column("t"), pa.scalar(None, batch.column("t").type)),
        ]
        names = ["k", "keep_id", "n", "first", "sha", "run", "run_text"]
        if "rest" in batch.schema.names:
            arrays.append(batch.column("rest"))
            names.append("rest")
        yield pa.RecordBatch.from_arrays(arrays, names)
