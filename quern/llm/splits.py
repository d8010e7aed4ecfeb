"""Splits that keep related records together.

*Components* by Hash-to-Min: every node keeps a cluster of nodes (at first its
neighbours and itself); in each round it sends its whole cluster to the smallest
member and that member to everyone in the cluster, until its component is settled (the
smallest node's cluster is the component, every other one's is that node), which a
count per smallest node tells; settled components take no part in later rounds.  The
clusters are rows ``(node, member)``, never arrays, so no cluster has to fit a
task: the minimum of a cluster is a combined aggregation, and the exchange is a
join whose hot keys adaptive execution splits.  Hubs (shared sources) are made to
sort first, so a star settles in two rounds.

*Assignment* by weighted rendezvous hashing: a component gets a score
``-ln(u) / weight`` per split, u a hash of component and split, and takes the
split of the lowest score, so a split gets components in proportion to its weight, and
as long as the weights stay a new component moves no other.  Components that hold more than
``1 / MAX_LARGE`` of all records (at most MAX_LARGE of them, by arithmetic) would
ruin the proportions if left to chance: they are placed first, largest first, by
rendezvous among the splits that still have room for them (else the roomiest),
and the weights of all others are what remains to be filled; these weights change with
the records, and a component whose scores are close may then change its split.

Defined cases: null keys tie nothing; a record without ties is a component of its
own; shares are normalised by their sum; targets that are null or not positive get
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.plans.stage import Stage

MAX_LARGE = 1000
MAX_SPLITS = 1000


def hash_to_min(edges: DataFrame) -> DataFrame:
    """Component of every node: ``node, component`` (its smallest node).

    ``edges``: string columns ``a`` and ``b``, any direction, repeats and loops allowed.
    """
    stage = Stage(edges.sparkSession, "components")
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
    loops = both.select("v", F.col("v").alias("u"))
    clusters = stage.write(both.unionByName(loops).distinct())
    kept: list[str] = []
    parts: list[DataFrame] = []
    while True:
        low = clusters.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("c"))
        nodes = F.count("*")
        # Settled: the minimum's cluster is all nodes of this minimum, and every other one's is the minimum.
        settled = (F.sum("c") == 2 * nodes - 1) & (F.max(F.when(F.col("v") == F.col("m"), F.col("c"))) == nodes)
        low = stage.write(low)
        at = stage.last
        state = stage.write(low.join(low.groupBy("m").agg(F.coalesce(settled, F.lit(False)).alias("settled")), "m").select("v", "m", "settled"))
        kept.append(stage.last)
        parts.append(state.where("settled").select(F.col("v").alias("node"), F.col("m").alias("component")))
        stage.drop(at)
        open_ = state.where("not settled").select("v", "m")
        if open_.isEmpty():
            out = stage.write(reduce(DataFrame.unionByName, parts))
            stage.drop_all_but(stage.last)
            return out
        sent = clusters.join(open_, "v").select("u", "m")
        out = sent.select(F.col("m").alias("v"), "u").unionByName(sent.select(F.col("u").alias("v"), F.col("m").alias("u")))
        clusters = stage.write(out.distinct())
        stage.drop_all_but(*kept, stage.last)


def record_groups(records: DataFrame, key: str, parent: str, source: str) -> DataFrame:
    """``key, group_key``: records tied by parent links, shared parents or shared sources.

    Keys must be clean and ``key`` unique.  group_key is the smallest key of the group's records.
    """
    own, up, src = (F.concat(F.lit(p), F.col(c)) for p, c in (("1", key), ("1", parent), ("0", source)))
    edges = records.select(own.alias("a"), F.explode(F.array_compact(F.array(own, up, src))).alias("b"))
    component = hash_to_min(edges)
    tied = component.where(F.col("node").startswith("1")).select(F.substring("node", 2, 1 << 30).alias(key), "component")
    tied = tied.join(records.select(key), key, "left_semi")
    low = tied.groupBy("component").agg(F.min(key).alias("group_key"))
    return tied.join(low, "component").select(key, "group_key")


def _unit(*parts: str) -> float:
    return (int.from_bytes(hashlib.sha256("|".join(parts).encode()).digest()[:7], "big") + 1) / ((1 << 56) + 1)


def assign_splits(groups: DataFrame, targets: DataFrame, key: str, salt: str = "quern") -> DataFrame:
    """``key, group_key, split_name`` for records with ``key, group_key``; targets: ``split_name, target_share``."""
    rows = targets.where("split_name is not null and target_share > 0").groupBy("split_name").agg(F.sum("target_share").alias("w")).limit(MAX_SPLITS + 1).collect()
    if not rows or len(rows) > MAX_SPLITS:
        raise ValueError("between 1 and MAX_SPLITS splits with a positive share are needed")
    whole = sum(r.w for r in rows)
    total = groups.count()
    room = {r.split_name: total * r.w / whole for r in sorted(rows)}
    size = groups.groupBy("group_key").agg(F.count("*").alias("n"))
    large = size.where(F.col("n") * MAX_LARGE > total).orderBy(F.desc("n"), "group_key").limit(MAX_LARGE).collect()  # at most MAX_LARGE rows by arithmetic
    fixed = {}
    for r in large:
        open_ = [s for s in room if room[s] >= r.n] or [max(room, key=lambda s: (room[s], s))]
        pick = min(open_, key=lambda s: (-math.log(_unit(salt, s, r.group_key)) / max(room[s], 1e-9), s))
        fixed[r.group_key] = pick
        room[pick] -= r.n
    free = {s: x for s, x in room.items() if x > 0} or {s: 1.0 for s in room}
    scores = []
    for s, x in sorted(free.items()):
        u = (F.pmod(F.xxhash64(F.lit(salt), F.lit(s), "group_key"), F.lit(1 << 53)) + 1) / F.lit(float((1 << 53) + 1))
        scores.append(F.struct((-F.log(u) / F.lit(x)).alias("score"), F.lit(s).alias("split_name")))
    best = F.array_min(F.array(*scores))["split_name"]
    if fixed:
        placed = F.create_map(*[F.lit(x) for kv in fixed.items() for x in kv])
        best = F.coalesce(F.try_element_at(placed, F.col("group_key")), best)
    return groups.select(key, "group_key", best.alias("split_name"))
