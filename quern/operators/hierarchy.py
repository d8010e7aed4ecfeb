"""Parent-child links to full hierarchies.

Input: one row per node with the node's key and its parent's key.  Each row is a
link of weight 1.  The links are resolved as a weighted disjoint-set forest:

1. *Partition-local forests.*  Every Arrow batch of links is a forest of its
   own; each node is compressed to its local root with the offset (number of
   links) to it.
2. *Merging.*  Forests are merged by joining each unresolved pointer with the
   forest that holds its target and adding the offsets, which doubles the
   length covered; so ceil(log2(longest chain)) merges suffice.  A pointer whose
   target has no link is resolved; resolved rows are written once and only those
   that an unresolved pointer names are joined again: up to BROADCAST_TARGETS such names
   are sent to the scans, so that no other row is shuffled.
3. *Cycles.*  If a merge resolves nothing although rows are left, all rows left
   run into cycles.  Merging goes on until neither the set of targets nor the
   smallest key seen changes; the targets are then exactly periodic nodes.
4. *Paths.*  On request each pointer carries the keys it skips, in order, so the
   merges also put together the whole path.

Defined cases: a null or blank key is no node; a parent that is null or names no
node makes its child a root; a node that is its own parent is a cycle of length
one; several rows of one node must be reduced before (``current_records``);
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.plans.stage import Stage

#: Names of targets that are broadcast (they are short keys), beyond which a shuffled join picks the rows.
BROADCAST_TARGETS = 200_000
_SCHEMA = "node string, ptr string, dist long, low string"


def _local_forest(with_path: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, parents = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            up = dict(zip(nodes, parents))
            found: dict[str, tuple[str, int, str]] = {}
            for start in nodes:
                chain, seen, x = [], set(), start
                while x in up and x not in found and x not in seen:
                    seen.add(x)
                    chain.append(x)
                    x = up[x]
                if x in seen:  # a cycle within the batch: leave plain links
                    for y in chain:
                        found[y] = (up[y], 1, y)
                    continue
                root, dist, low = found.get(x, (x, 0, None))
                for y in reversed(chain):
                    dist += 1
                    low = y if low is None or y < low else low
                    found[y] = (root, dist, low)
            rows = [found[n] for n in nodes]
            out = {
                "node": pa.array(nodes, pa.string()),
                "ptr": pa.array([r[0] for r in rows], pa.string()),
                "dist": pa.array([r[1] for r in rows], pa.int64()),
                "low": pa.array([r[2] for r in rows], pa.string()),
            }
            if with_path:  # keys from just below the pointer down to the node
                segments = []
                for n, (_, dist, _) in zip(nodes, rows):
                    seg = [n]
                    while len(seg) < dist:
                        seg.append(up[seg[-1]])
                    segments.append(seg[::-1])
                out["seg"] = pa.array(segments, pa.list_(pa.string()))
            yield pa.RecordBatch.from_pydict(out)

    return run


def resolve_hierarchy(links: DataFrame, with_path: bool = False) -> DataFrame:
    """Root and depth of every node.

    ``links``: columns ``node`` (unique, not null) and ``parent``.  Returns
    ``node, root, depth, linked`` (linked: the parent names a node) and with
    ``with_path`` also ``path`` (keys from root to node).  A node from which no
    root can be reached has depth -1, the smallest key of the cycle it runs into
    as root, and a null path.
    """
    spark = links.sparkSession
    stage = Stage(spark, "hierarchy")
    links = links.select("node", "parent")
    nodes = links.select(F.col("node").alias("parent"))
    edges = links.where("parent is not null").join(nodes, "parent", "left_semi").select("node", "parent")
    schema = _SCHEMA + (", seg array<string>" if with_path else "")
    extra = ["seg"] if with_path else []
    active = stage.write(edges.mapInArrow(_local_forest(with_path), schema))
    resolved: list[DataFrame] = []
    left = active.count()
    cyclic = None
    while left:
        known = active.withColumn("done", F.lit(False))
        for part in resolved:
            known = known.unionByName(part.withColumn("done", F.lit(True)))
        wanted = active.select(F.col("ptr").alias("node")).distinct()
        few = wanted.limit(BROADCAST_TARGETS + 1).count() <= BROADCAST_TARGETS
        known = known.join(F.broadcast(wanted) if few else wanted, "node", "left_semi")
        target = known.select(F.col("node").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("dist").alias("dist2"), F.col("low").alias("low2"), "done", *[F.col(c).alias("seg2") for c in extra])
        step = active.join(target, "ptr", "left").select(
            "node",
            F.coalesce("ptr2", "ptr").alias("ptr"),
            (F.col("dist") + F.coalesce("dist2", F.lit(0))).alias("dist"),
            F.least("low", "low2").alias("low"),
            *[F.when(F.col("ptr2").isNull(), F.col("seg")).otherwise(F.concat("seg2", "seg")).alias("seg") for _ in extra],
            (F.col("ptr2").isNull() | F.coalesce("done", F.lit(False))).alias("finished"),
        )
        merged = stage.write(step)
        n_done = merged.where("finished").count()
        resolved.append(merged.where("finished").drop("finished"))
        active = merged.where("not finished").drop("finished")
        left -= n_done
        if left and not n_done:
            cyclic = _cycles(active.select("node", "ptr", "low"), stage)
            break
    parts = [p.select("node", F.col("ptr").alias("root"), F.col("dist").alias("depth"), *[F.concat(F.array("ptr"), "seg").alias("path") for _ in extra]) for p in resolved]
    if cyclic is not None:
        parts.append(cyclic.select("node", "root", F.lit(-1).cast("long").alias("depth"), *[F.lit(None).cast("array<string>").alias("path") for _ in extra]))
    if not parts:
        return links.select("node", F.col("node").alias("root"), F.lit(0).cast("long").alias("depth"), F.lit(False).alias("linked"), *[F.array("node").alias("path") for _ in extra])
    linked = parts[0]
    for p in parts[1:]:
        linked = linked.unionByName(p)
    out = links.select("node").join(linked, "node", "left")
    return out.select(
        "node",
        F.coalesce("root", "node").alias("root"),
        F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
        F.col("depth").isNotNull().alias("linked"),
        *[F.when(F.col("depth").isNull(), F.array("node")).otherwise(F.col("path")).alias("path") for _ in extra],
    )


def _cycles(active: DataFrame, stage: Stage) -> DataFrame:
    """node, root for rows that all run into cycles; root: smallest key of the cycle."""
    before = None
    state, own = active, ""
    while True:
        targets = state.select(F.col("ptr").alias("node")).distinct()
        on = targets.join(state, "node").agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("node", "low").cast("decimal(38,0)")), F.lit(0))).first()
        if before == on:
            break
        before = on
        nxt = state.select(F.col("node").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("low").alias("low2"))
        state = stage.write(state.join(nxt, "ptr").select("node", F.col("ptr2").alias("ptr"), F.least("low", "low2").alias("low")))
        if own:
            stage.drop(own)
        own = stage.last
    low = state.select(F.col("node").alias("ptr"), F.col("low").alias("root"))
    return state.select("node", "ptr").join(low, "ptr").select("node", "root")


def descendants(resolved: DataFrame) -> DataFrame:
    """All (ancestor, node, distance) with distance >= 1, from rows with a path.

    Every path is taken apart where it lies, so no subtree is gathered; nodes
    that reach no root have no path and give no row.
    """
    out = resolved.where("path is not null").select("node", "depth", F.posexplode("path").alias("at", "ancestor"))
    return out.select("ancestor", "node", (F.col("depth") - F.col("at")).alias("distance")).where("distance > 0")
