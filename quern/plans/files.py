"""Small files in the shared folder, through the file system of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    p, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of change of a file or of the files in a folder, without reading them."""
    p, fs = _at(spark, path)
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def make_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file at once; an existing one is an error."""
    p, fs = _at(spark, path)
    part, _ = _at(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(part)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(p) or not fs.rename(part, p):
        fs.delete(part, False)
        raise FileExistsError(path)
