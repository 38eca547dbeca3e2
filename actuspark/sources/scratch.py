"""The folder of intermediate tables that the driver and all executors share."""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache
from itertools import count
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or else the session's checkpoint folder; only a local session may have neither and gets one of its own."""
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


@contextmanager
def space(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes a frame to the shared folder and reads it again, so that its lineage ends there; what it wrote goes at the end."""
    top = f"{folder(spark)}/steps-{uuid.uuid4().hex}"
    numbers = count()

    def keep(df: DataFrame) -> DataFrame:
        path = f"{top}/{next(numbers)}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(top)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@cache
def code_state() -> str:
    """A digest of this package's code, so that what other code stored is not taken for its own."""
    top = Path(__file__).resolve().parent.parent
    own = [p for p in sorted(top.rglob("*.py")) if "llm" not in p.relative_to(top).parts]
    return hashlib.sha256(b"".join(p.read_bytes() for p in own)).hexdigest()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = Path(__file__).resolve().parent.parent
        out = Path(os.path.realpath(tempfile.mkdtemp(prefix="spark-ship-"))) / "actuspark_core.zip"
        with zipfile.ZipFile(out, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        spark.sparkContext.addPyFile(str(out))
        _shipped.add(app)
