"""Tables of slices whose versions are published by one pointer.

A table is a folder. Every write goes to a new folder ``VERSION=...`` below it, partitioned by the slice
column; the file ``_current`` names the version that holds each slice. A reader takes the folders that
the pointer names, so a filter on the slice column prunes whole folders (a join on it, by dynamic
pruning). A new pointer is written beside the old one and renamed over it in one step: a write that fails
before that leaves the table as it was, and slices that a write doesn't hold are not copied. One writer at
a time; folders of older versions stay, so that readers who began before can finish.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import conform_types

POINTER = "_current"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, by: str = "VAL_DATE"):
        self.spark, self.path, self.by = spark, path.rstrip("/"), by
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def slices(self) -> dict[str, str]:
        """The folder name of each slice (as ``VAL_DATE=2000-12-01``) and the version that holds it; empty before the first write."""
        pointer = self._at(POINTER)
        fs = pointer.getFileSystem(self._conf)
        if not fs.exists(pointer):
            return {}
        stream = fs.open(pointer)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self) -> DataFrame:
        """All slices of the present version, with the slice column."""
        now = self.slices()
        if not now:
            raise ValueError(f"{self.path} has no version yet")
        return self.spark.read.option("basePath", self.path).parquet(*[f"{self.path}/{version}/{name}" for name, version in sorted(now.items())]).drop("VERSION")

    def replace(self, df: DataFrame) -> None:
        """The slices that ``df`` holds take the place of those of the same name; the others stay."""
        version = f"VERSION=v{uuid.uuid4().hex}"
        df.write.partitionBy(self.by).parquet(f"{self.path}/{version}")
        folder = self._at(version)
        found = [s.getPath().getName() for s in folder.getFileSystem(self._conf).listStatus(folder)]
        self._publish(self.slices() | {name: version for name in found if name.startswith(f"{self.by}=")})

    def upsert(self, df: DataFrame, on: list[str]) -> None:
        """Rows of ``df`` replace those with the same ``on`` within the slices that ``df`` holds, and are added where there are none. Null keys equal each other."""
        if not self.slices():
            return self.replace(df)
        old = self.read()
        new = conform_types(df, old.schema)
        touched = old.join(new.select(self.by).distinct(), self.by, "left_semi")
        keys = new.select(*[F.col(k).alias(f"_new_{k}") for k in on])
        rest = touched.join(keys, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in on], "left_anti")
        return self.replace(rest.unionByName(new))

    def _publish(self, slices: dict[str, str]) -> None:
        new, jvm = self._at(f"{POINTER}-{uuid.uuid4().hex}"), self.spark._jvm
        out = new.getFileSystem(self._conf).create(new, False)
        try:
            out.write(bytearray(json.dumps(slices).encode()))
        finally:
            out.close()
        rename = getattr(self._hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self._conf).rename(new, self._at(POINTER), how)


def state_of(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """Name, size and time of change of each file of some files or folders: equal as long as nothing was written there."""
    out = []
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        for s in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at):
            out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(out)
