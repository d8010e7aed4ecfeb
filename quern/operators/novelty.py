"""Fingerprints, first-wins novelty, duplicates and decontamination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import clean_key


def architecture(c: Column | str = "gpu_architecture", default: str = "blackwell") -> Column:
    """Cleaned architecture label; missing ones get the default."""
    return F.coalesce(clean_key(c), F.lit(default))


def scoped(arch: Column, value: Column) -> Column:
    """Content hash within an architecture; null where there is no content."""
    return F.when(value.isNotNull(), F.concat_ws(":", arch, value))


def novelty(rows: DataFrame, exact: list[str], near: list[str], order: str, known: DataFrame | None = None) -> DataFrame:
    """``order, verdict`` for every row: exact, near or novel.

    A row is exact if one of its exact keys is known or stands in an earlier row,
    else near if one of its near keys does.  Keys are added whatever the verdict
    of their row, so a row has a seen key exactly if it is not the first bringer of
    all its keys: keys are reduced to their smallest position (combined on the map
    side), positions to the number of keys they brought first, and that number is
    compared with the row's keys.  So a key that a third of all rows share is one
    row in every join.  ``known`` holds the same key columns.  Null keys match
    nothing; positions must be unique.
    """

    def keys(df: DataFrame, at: Column) -> DataFrame:
        both = [F.when(F.col(c).isNotNull(), F.struct(F.lit(k).alias("kind"), F.col(c).alias("key"))) for k, cols in (("e", exact), ("n", near)) for c in cols]
        return df.select(at.cast("long").alias("at"), F.explode(F.array_distinct(F.array_compact(F.array(*both)))).alias("k")).select("at", "k.kind", "k.key")

    own = keys(rows, F.col(order))
    every = own if known is None else own.unionByName(keys(known, F.lit(-(1 << 62))))
    brought = every.groupBy("kind", "key").agg(F.min("at").alias("at")).groupBy("at")
    count = lambda k: F.count_if(F.col("kind") == k)
    brought = brought.agg(count("e").alias("e_first"), count("n").alias("n_first"))
    has = rows.select(F.col(order).alias("at"), *[sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0)).alias(k) for k, cols in (("e", exact), ("n", near))]) if max(len(exact), len(near)) < 2 else None
    if has is None:
        has = rows.select(F.col(order).alias("at")).join(own.groupBy("at").agg(count("e").alias("e"), count("n").alias("n")), "at", "left")
    out = has.join(brought, "at", "left").na.fill(0)
    verdict = F.when(F.col("e_first") < F.col("e"), "exact").when(F.col("n_first") < F.col("n"), "near").otherwise("novel")
    return out.select(F.col("at").alias(order), verdict.alias("verdict"))


def novelty_report(verdicts: DataFrame) -> DataFrame:
    """Counts of all verdicts in one row."""
    count = lambda v: F.count_if(F.col("verdict") == v)
    return verdicts.agg(F.count("*").alias("verified_rows"), count("exact").alias("exact_rows"), count("near").alias("near_rows"), count("novel").alias("novel_rows"))


def first_of_each(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of the lowest ``order`` of each key; rows without a key are all kept."""
    low = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(order))
    return rows.join(low, [key, order], "left_semi").unionByName(rows.where(F.col(key).isNull()))


def duplicate_groups(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Keys of more than one row with their first row and count."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
