"""File sources: JSON lines, YAML and Python trees."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.keys import is_blank
from quern.plans.files import list_files


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, missing_ok: bool = False) -> DataFrame:
    """Rows of a JSON-lines file, with the schema given.

    Blank lines are skipped; a malformed line fails the query that reads it.  A
    missing path gives no rows with ``missing_ok``.
    """
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).where(~is_blank(F.col("value")))
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def split_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected lines with their file, number (from 1, blank lines counted) and text.

    Files are split between tasks as they lie; only files that hold a rejected line are read again,
    each by one task, to number its lines.
    """
    lines = spark.read.text(path).where(~is_blank(F.col("value"))).select("value", F.input_file_name().alias("file"))
    kinds = lines.withColumn("ok", F.try_parse_json("value").isNotNull())
    good = kinds.where("ok").select(F.from_json("value", schema).alias("r")).select("r.*")
    bad = kinds.where("not ok").select("file").distinct()
    whole = spark.read.text(path, wholetext=True).select("value", F.input_file_name().alias("file")).join(bad, "file", "left_semi")
    numbered = whole.select("file", F.posexplode(F.split("value", "\n")).alias("at", "line")).where(~is_blank(F.col("line")) & F.try_parse_json("line").isNull())
    return good, numbered.select("file", (F.col("at") + 1).alias("number"), "line")


def matching(rows: DataFrame, limit: int | None = None, order: str = "row_idx", **allowed: list[str] | None) -> DataFrame:
    """Rows whose columns are among the allowed values (None: any), at most ``limit`` of them in order.

    Values are stripped and blanks dropped; the conditions are pushed to the scan.
    """
    for column, values in allowed.items():
        kept = sorted({v.strip() for v in values or [] if v and v.strip()})
        if kept:
            rows = rows.where(F.col(column).isin(kept))
    return rows if limit is None else rows.orderBy(order).limit(limit)


def _yaml_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import yaml

    for part in parts:
        rows = []
        for path, content in zip(part["path"], part["content"]):
            parsed = yaml.safe_load(bytes(content).decode("utf-8"))
            for record in parsed if isinstance(parsed, list) else [parsed]:
                if isinstance(record, dict):
                    rows.append((path, {str(k): None if v is None else str(v) for k, v in record.items()}))
        yield pd.DataFrame(rows, columns=["path", "record"])


def read_yaml(spark: SparkSession, path: str, pattern: str = "*.yaml") -> DataFrame:
    """``path, record`` (a map of strings) of all records of a tree of YAML files; a file is read where its rows are made."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "content").mapInPandas(_yaml_rows, "path string, record map<string,string>")


def read_problems(spark: SparkSession, path: str, levels: list[str] | None = None, others: tuple[str, ...] = ("bugfix",)) -> DataFrame:
    """``path, record`` of the YAML files in the level folders (``level1`` .. ``level4``, or those named) and the other ones, in order of their paths."""
    wanted = "|".join([*(levels or [f"level_?{i}" for i in range(1, 5)]), *others])
    return read_yaml(spark, path).where(F.col("path").rlike(f"/({wanted})/[^/]*$")).orderBy("path")


def latest(spark: SparkSession, folder: str, pattern: str = "") -> str | None:
    """Path of the last file of a folder by name, of those that match a pattern; null if there is none."""
    names = [n for n in list_files(spark, folder) if re.search(pattern, n)]
    return f"{folder}/{names[-1]}" if names else None


def read_sources(spark: SparkSession, path: str, pattern: str = "*.py") -> DataFrame:
    """``path, code`` of all files of a tree, each one row; unreadable files are skipped."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("ignoreCorruptFiles", "true")
    return reader.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("code"))


def file_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, sha256`` of all files under a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def first_available(*frames: DataFrame) -> DataFrame:
    """The first frame that has rows, else the last."""
    for f in frames[:-1]:
        if not f.isEmpty():
            return f
    return frames[-1]
