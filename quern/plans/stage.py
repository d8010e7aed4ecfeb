"""Written intermediate tables.

Iterative plans cut their lineage by writing a Parquet table to the folder that
the session names in ``spark.checkpoint.dir`` and reading it back.  All
executors share that folder, so the loss of an executor loses no result.  Only a
local session without the setting gets a temporary folder of its own.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: str | None = None
_made: list[str] = []  # folders of this process


def stage_root(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one for local sessions."""
    global _own
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own is None:
        _own = tempfile.mkdtemp(prefix="quern-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return f"file://{_own}"


class Stage:
    """Tables written under one folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
        _made.append(self.path)
        self._n = 0
        self.last = ""  # path of the table written last
        self.paths: list[str] = []

    def next_path(self) -> str:
        self._n += 1
        self.last = f"{self.path}/{self._n:04d}"
        self.paths.append(self.last)
        return self.last

    def drop_all_but(self, *kept: str) -> None:
        """Delete the tables that are not needed any more."""
        self.drop(*[p for p in self.paths if p not in kept] or [f"{self.path}/none"])
        self.paths = list(kept)

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` and return the written table."""
        path = self.next_path()
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *paths: str) -> None:
        """Delete the given tables, or the whole folder."""
        jvm = self.spark._jvm
        for p in paths or (self.path,):
            at = jvm.org.apache.hadoop.fs.Path(p)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def clean(spark: SparkSession) -> None:
    """Delete all intermediate tables that this process has written; results that were not read yet are lost."""
    while _made:
        p = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
