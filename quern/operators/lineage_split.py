"""Splits that keep ancestry and shared identities together.

Rows and their keys (own id, parent id, identity) form a two-sided graph.  Labels
spread by alternating minima: a key takes the smallest label of its rows, a row
the smallest of its keys, then labels jump to the label of their label; rounds
grow with the logarithm of the longest chain.  A key shared by very many rows is
one aggregated row, never a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import first_filled
from quern.plans.stage import Stage


def identity(family: Column, *others: tuple[str, Column]) -> Column:
    """The strongest identity of a record: its family, else the first filled other one, each with its prefix."""
    parts = [("family", family), *others]
    return first_filled(*[F.concat(F.lit(f"{name}:"), F.nullif(c, F.lit(""))) for name, c in parts])


def components(links: DataFrame) -> DataFrame:
    """``row, component`` from links ``row, key`` (strings; rows are unique ids and every row has a key).

    The component is the smallest row id.
    """
    stage = Stage(links.sparkSession, "lineage")
    links = stage.write(links.select("row", "key").where("row is not null and key is not null").distinct())
    label = stage.write(links.select("row", F.col("row").alias("label")).distinct())
    while True:
        by_key = links.join(label, "row").groupBy("key").agg(F.min("label").alias("label"))
        by_row = links.join(by_key, "key").groupBy("row").agg(F.min("label").alias("label"))
        jump = by_row.select(F.col("row").alias("label"), F.col("label").alias("next"))
        moved = by_row.join(jump, "label", "left").select("row", F.coalesce("next", "label").alias("label"))
        before = label.select("row", F.col("label").alias("before"))
        old = stage.last
        new = stage.write(moved.join(before, "row").select("row", "label", (F.col("label") != F.col("before")).alias("changed")))
        label = new.select("row", "label")
        stage.drop(old)
        if new.where("changed").isEmpty():
            return label.select("row", F.col("label").alias("component"))


def assign_by_lineage(rows: DataFrame, key: str, group: str, reserved: str, dev_fraction: float = 0.1) -> DataFrame:
    """``key, split_group, split`` and ``conflict`` for rows with their component.

    A group with a reserved split takes it (its smallest one; ``conflict`` marks groups with several); every
    other group is dev if the first byte of its hash is below ``dev_fraction`` of 256, else train.
    """
    facts = rows.groupBy(group).agg(F.min(reserved).alias("_low"), F.max(reserved).alias("_high"))
    name = F.concat(F.lit("component:"), F.sha2(F.col(group), 256))
    byte = F.conv(F.substring(F.sha2(name, 256), 1, 2), 16, 10).cast("int")
    split = F.coalesce("_low", F.when(byte < int(dev_fraction * 256), "dev").otherwise("train"))
    facts = facts.select(group, name.alias("split_group"), split.alias("split"), F.coalesce(F.col("_low") != F.col("_high"), F.lit(False)).alias("conflict"))
    return rows.select(key, group).join(facts, group).select(key, "split_group", "split", "conflict")
