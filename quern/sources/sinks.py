"""Sinks: validated, atomic and appended JSON lines, and bundles of tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quern.operators.verify import unique_or_raise


def _fs(df: DataFrame, path: str):
    jvm = df.sparkSession._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())


def write_unique_jsonl(df: DataFrame, path: str, key: str, order: str | None = None) -> None:
    """Write rows of a unique key as JSON lines, all or nothing.

    The rows are checked and written beside the target, which is replaced by a
    rename; whatever fails before leaves the old target as it was.
    """
    unique_or_raise(df, key)
    jvm, at, fs = _fs(df, path)
    temporary, old = f"{path}.{uuid.uuid4().hex}", f"{path}.{uuid.uuid4().hex}.old"
    (df.sortWithinPartitions(order) if order else df).write.option("ignoreNullFields", "false").json(temporary)
    p = jvm.org.apache.hadoop.fs.Path
    moved = fs.exists(at) and fs.rename(at, p(old))
    if not fs.rename(p(temporary), at):
        if moved:
            fs.rename(p(old), at)
        raise OSError(f"{path} could not be replaced")
    if moved:
        fs.delete(p(old), True)


def write_jsonl(df: DataFrame, path: str) -> int:
    """Write rows as JSON lines in place of what was there; returns their number, counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def append_jsonl(df: DataFrame, path: str) -> None:
    """Add rows to a folder of JSON lines."""
    df.write.mode("append").json(path)


def write_bundle(tables: dict[str, DataFrame], path: str, facts: dict[str, object]) -> None:
    """Write tables under a folder; ``facts`` are written last, as ``manifest.json``, so a bundle with a manifest is whole."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
    df = next(iter(tables.values()))
    _, at, fs = _fs(df, f"{path}/manifest.json")
    out = fs.create(at, True)
    out.write(bytearray(json.dumps(facts, sort_keys=True, indent=1).encode()))
    out.close()


def first_rows(df: DataFrame, order: str, n: int = 50) -> DataFrame:
    """The first ``n`` rows by ``order``, for a report."""
    return df.orderBy(F.col(order)).limit(n)
