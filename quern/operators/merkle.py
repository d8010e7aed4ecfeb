"""Merkle trees over ordered rows.

Leaves are hex hashes with dense positions 0 .. n-1.  A parent is the SHA-256 of the
bytes of its two children; an odd last node is paired with itself; the root of no
leaves is the SHA-256 of no bytes.  As a dozen levels are one block of 4,096
leaves, whole blocks are folded inside one task each (positions sent to the block
they belong to), so a tree of n leaves takes ceil(log2(n) / 12) shuffles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.plans.stage import Stage

LEVELS = 12
EMPTY = hashlib.sha256(b"").hexdigest()


def parent(left: str, right: str) -> str:
    return hashlib.sha256(bytes.fromhex(left) + bytes.fromhex(right)).hexdigest()


def dense_positions(rows: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """Rows with ``pos`` 0 .. n-1 by ``order`` (unique): a range sort, counts per partition, and a running number within."""
    stage = Stage(rows.sparkSession, "positions")
    placed = stage.write(rows.repartitionByRange(order).select(F.spark_partition_id().alias("_p"), order, *[c for c in columns if c != order]))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = placed.groupBy("_p").agg(F.count("*").alias("_n")).select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    within = Window.partitionBy("_p").orderBy(order)
    out = placed.join(F.broadcast(offsets), "_p")  # one row per partition
    return out.withColumn("pos", (F.row_number().over(within) - 1 + F.col("_o")).cast("long")).drop("_p", "_o")


def level(nodes: DataFrame) -> DataFrame:
    """The next level of ``pos, hash``, by one aggregation in the JVM."""
    pair = nodes.groupBy(F.floor(F.col("pos") / 2).cast("long").alias("pos")).agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("hash"))).alias("l"), F.max(F.when(F.col("pos") % 2 == 1, F.col("hash"))).alias("r"))
    return pair.select("pos", F.sha2(F.unhex(F.concat("l", F.coalesce("r", "l"))), 256).alias("hash"))


def _fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of 2**LEVELS nodes (rows sorted by position) to one node each."""
    block, nodes = None, []

    def done() -> pd.DataFrame:
        level_nodes = nodes
        for _ in range(LEVELS):
            level_nodes = [parent(level_nodes[i], level_nodes[min(i + 1, len(level_nodes) - 1)]) for i in range(0, len(level_nodes), 2)]
        return pd.DataFrame({"pos": [block], "hash": [level_nodes[0]]})

    for part in parts:
        for pos, h in zip(part["pos"], part["hash"]):
            b = pos >> LEVELS
            if b != block:
                if nodes:
                    yield done()
                block, nodes = b, []
            nodes.append(h)
    if nodes:
        yield done()


def merkle_root(leaves: DataFrame) -> str:
    """Root of ``pos, hash``."""
    stage = Stage(leaves.sparkSession, "merkle")
    nodes = stage.write(leaves.select("pos", "hash"))
    n = nodes.count()
    if n == 0:
        return EMPTY
    while n > 1 << LEVELS:
        by_block = nodes.withColumn("b", F.shiftright("pos", LEVELS)).repartition("b").sortWithinPartitions("pos").drop("b")
        nodes = stage.write(by_block.mapInPandas(_fold, "pos long, hash string"))
        n = (n + (1 << LEVELS) - 1) >> LEVELS
    rest = [r.hash for r in nodes.orderBy("pos").collect()]  # at most 2**LEVELS rows
    while len(rest) > 1:
        rest = [parent(rest[i], rest[min(i + 1, len(rest) - 1)]) for i in range(0, len(rest), 2)]
    return rest[0]
