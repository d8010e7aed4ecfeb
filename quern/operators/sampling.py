"""Coverage-first stratified sampling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.canonical import joined_hash
from quern.functions.keys import first_filled


def bucket(*columns: Column) -> Column:
    """First filled column, else ``unknown``."""
    return first_filled(*columns, F.lit("unknown"))


def stratified_sample(rows: DataFrame, source: str, family: str, key: str, limit: int, salt: str, max_share: float = 0.25) -> DataFrame:
    """At most ``limit`` rows: every source gives one before any gives a second, families of a source likewise.

    A source gives at most ``ceil(limit * max_share)`` unless the others cannot
    fill the sample.  The choice is by salted hash of ``key`` (unique), so it is
    the same for the same salt and rows.  Only rows that can be chosen are ranked
    within their source: a family's rows beyond the limit are cut by the same
    window that ranks them (the engine keeps at most ``limit`` rows a group on
    every task before the shuffle).
    """
    if limit <= 0:
        return rows.limit(0)
    cap = max(1, math.ceil(limit * max_share))
    h = rows.withColumns({"_quern_k": joined_hash(F.lit(salt), F.col(key)), "_quern_f": joined_hash(F.lit(salt), F.col(family)), "_quern_s": joined_hash(F.lit(salt), F.col(source))})
    in_family = Window.partitionBy(source, family).orderBy("_quern_k", key)
    ranked = h.withColumn("_quern_r", F.row_number().over(in_family)).where(F.col("_quern_r") <= limit)
    in_source = Window.partitionBy(source).orderBy("_quern_r", "_quern_f", family)
    placed = ranked.withColumn("_quern_p", F.row_number().over(in_source)).where(F.col("_quern_p") <= limit)
    order = [(F.col("_quern_p") > cap).cast("int"), F.col("_quern_p"), F.col("_quern_s"), F.col(source)]
    return placed.orderBy(*order).limit(limit).drop("_quern_k", "_quern_f", "_quern_s", "_quern_r", "_quern_p")


def catalogue_hash(rows: DataFrame, *columns: str) -> DataFrame:
    """Order-independent hash of a catalogue of any size, and its row count.

    The hash of every row is summed in two halves of 128 bits modulo 2**64 and
    the sums are hashed: partial sums combine on the map side, no row list is built.
    """
    digest = F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in columns]), 256)
    part = lambda i: F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")
    sums = rows.select(digest.alias("h")).agg(*[F.coalesce(F.sum(part(i)), F.lit(0)).cast("decimal(38,0)").alias(f"s{i}") for i in range(8)], F.count("*").alias("n_rows"))
    return sums.select(F.sha2(F.concat_ws(",", *[F.col(f"s{i}").cast("string") for i in range(8)]), 256).alias("catalogue_hash"), "n_rows")
