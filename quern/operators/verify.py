"""Checks between tables: consistency, positions, recomputed hashes, counts against pins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.canonical import struct_hash


def missing_rows(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` lacks; nulls equal nulls.  Rows are compared by one hash of all columns."""
    x = left.select(*columns).distinct().withColumn("_h", struct_hash(*columns))
    y = right.select(struct_hash(*columns).alias("_h")).distinct()
    return x.join(y, "_h", "left_anti").drop("_h")


def both_ways(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that only one side has, with ``side`` left or right."""
    a = missing_rows(left, right, columns).withColumn("side", F.lit("left"))
    return a.unionByName(missing_rows(right, left, columns).withColumn("side", F.lit("right")))


def positional(reports: DataFrame, index: str, rows: DataFrame, position: str, columns: list[str]) -> DataFrame:
    """Reports joined with the row at their index; ``found`` is false for an index outside the rows."""
    target = rows.select(F.col(position).alias("_p"), *columns, F.lit(True).alias("_f"))
    return reports.join(target, reports[index] == F.col("_p"), "left").withColumn("found", F.coalesce("_f", F.lit(False))).drop("_p", "_f")


def zipped(left: DataFrame, right: DataFrame, position: str) -> DataFrame:
    """Rows of equal position; an error if the sides differ in length."""
    n, m = left.count(), right.count()
    if n != m:
        raise ValueError(f"sides of {n} and {m} rows cannot be zipped")
    return left.join(right, position)


def wrong_hashes(rows: DataFrame, key: str, committed: Column, recomputed: Column) -> DataFrame:
    """Rows whose committed hash is missing or differs from the recomputed one."""
    same = F.coalesce(committed == recomputed, F.lit(False))
    return rows.where(~same).select(key, committed.alias("committed"), recomputed.alias("recomputed"))


def against_pins(counts: DataFrame, pins: DataFrame, key: str) -> DataFrame:
    """Pins (key, expected) with the actual count and whether they agree."""
    out = pins.join(counts, key, "left").withColumn("actual", F.coalesce("actual", F.lit(0).cast("long")))
    return out.withColumn("agrees", F.col("actual") == F.col("expected"))


def unique_or_raise(rows: DataFrame, key: str) -> DataFrame:
    """The rows; an error if a key is null or stands twice."""
    bad = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col(key).isNull() | (F.col("n") > 1)).limit(1).collect()
    if bad:
        raise ValueError(f"{key} {bad[0][0]!r} is missing or not unique")
    return rows
