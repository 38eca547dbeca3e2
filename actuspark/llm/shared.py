"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Maps A-Z to a-z in bytes and leaves every other byte alone.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())

#: White space of the contracts: space, and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of intermediate tables: ``spark.checkpoint.dir``, or else the checkpoint folder of the session.

    A folder of our own is made only for a local session, where all tasks see it; a cluster without
    either setting is an error.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        top = found.get() if found.isDefined() else None
    if not top:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(top)
    return top.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a file of a small table.
FILE_ROWS = 20_000


def save(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` as a compressed table in the shared folder; for large intermediates, where a checkpoint's plain rows take too much disk.

    ``rows``: a bound of its rows, if known. A table that is small for it is written by few tasks, so that rounds over little that is left don't cost as many tasks as the first.
    """
    if rows is not None and (parts := 1 + rows // FILE_ROWS) < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        df = df.coalesce(parts)
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_key(df: DataFrame, key: str) -> Column:
    """The column ``key``, a whole number, as bigint."""
    if not isinstance(df.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} must be a whole number, not {df.schema[key].dataType.simpleString()}")
    return F.col(key).cast("bigint")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def byte_texts(column: pa.Array) -> list[bytes]:
    """Each text as UTF-8 bytes; a null text is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def split_words(text: bytes, table: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of ``text`` after ``table``, which turns what is no word into spaces; lists from at most about ``size`` bytes each."""
    norm = text.translate(table)
    start = 0
    while len(norm) - start > size:
        end = norm.rfind(b" ", start, start + size)
        if end < start:
            end = norm.find(b" ", start + size)
        if end < start:
            break
        yield norm[start:end].split()
        start = end + 1
    yield norm[start:].split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = Path(__file__).resolve().parent.parent
        out = Path(os.path.realpath(tempfile.mkdtemp(prefix="spark-ship-"))) / "actuspark_code.zip"
        with zipfile.ZipFile(out, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        spark.sparkContext.addPyFile(str(out))
        _shipped[app] = str(out)
