"""Filling fixed-capacity containers with items.

Only an item's size matters for packing, and sizes are whole numbers up to the
capacity.  So the packing is planned on the histogram of sizes (at most
``capacity`` numbers whatever the number of items) and carried out by rank:

1. Items above the capacity are cut into full pieces and one rest; no other item
   is divided.
2. *Martello-Toth reduction* on the histogram, largest size first.  A container
   is fixed when its set provably dominates every other set with its largest
   item: alone, if nothing fits beside it; with the largest item k that fits, if k
   fills the gap exactly, if no two items fit beside it, or if no three do and no
   two together exceed k.  All copies of a size are fixed at once.
3. *Best fit* of what is left, in decreasing size, again with all items of a size
   at once: the fullest open container that takes the size is filled with as many
   of them as it takes.
4. The plan lists, per size, ranges of ranks and their containers.  Every item
   gets its rank among the items of its size (counted in hashed sub-buckets, so
   a size that a third of all items share is ranked by many tasks) and looks its
   container up in the broadcast plan.  Best fit adds at most three patterns per
   size, so the plan grows with the histogram, which the sum of the capacities bounds.

Defined cases: null and blank texts are no items; equal sizes are ranked by
sub-bucket and id; capacities below 1 or null are left out; an empty table gives
empty results.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.plans.stage import Stage

#: Capacities of all specs together: the histograms and the plan on the driver hold a few numbers for each unit at most.
MAX_CAPACITIES = 1 << 18
ITEMS_PER_BUCKET = 200_000


@dataclass
class Plan:
    """Patterns of containers: (sizes with quantities, number of containers); the first ``fixed`` containers come from the reduction."""

    capacity: int
    patterns: list[tuple[tuple[tuple[int, int], ...], int]] = field(default_factory=list)
    fixed: int = 0

    @property
    def containers(self) -> int:
        return sum(m for _, m in self.patterns)


def _reduce(count: dict[int, int], plan: Plan) -> None:
    """Fix dominating sets; takes their items out of ``count``."""
    c = plan.capacity
    sizes = sorted(count)

    def take(*used: int) -> None:
        """As many containers with these sizes as there are items for."""
        need = {s: used.count(s) for s in used}
        n = min(count[s] // q for s, q in need.items())
        plan.patterns.append((tuple(sorted(need.items(), reverse=True)), n))
        plan.fixed += n
        for s, q in need.items():
            count[s] -= n * q
            if not count[s]:
                del count[s]
                sizes.pop(bisect_left(sizes, s))

    def smallest(n: int, without: int) -> int | None:
        """Sum of the n smallest items left besides one of size ``without``."""
        total, left = 0, n
        for s in sizes:
            have = count[s] - (s == without)
            used = min(left, have)
            total += used * s
            left -= used
            if not left:
                return total
        return None

    def best_pair(room: int, j: int) -> int:
        """Largest sum of two items within room, besides one of size j."""
        free = [s for s in sizes[: bisect_right(sizes, room)] if count[s] > (s == j)]
        best = max((2 * s for s in free if 2 * s <= room and count[s] - (s == j) >= 2), default=0)
        lo, hi = 0, len(free) - 1
        while lo < hi:
            total = free[lo] + free[hi]
            if total > room:
                hi -= 1
            else:
                best = max(best, total)
                lo += 1
        return best

    j = max(sizes, default=0)
    while j:
        room = c - j
        while count.get(j, 0):
            at = bisect_right(sizes, room) - 1
            k = sizes[at] if at >= 0 else 0
            if k == j and count[j] < 2:
                k = sizes[at - 1] if at >= 1 else 0
            if not k:
                take(j)
                continue
            two, three = smallest(2, j), smallest(3, j)
            if k == room or two is None or two > room or ((three is None or three > room) and best_pair(room, j) <= k):
                take(j, k)
                continue
            break
        at = bisect_left(sizes, j) - 1
        j = sizes[at] if at >= 0 else 0


def _best_fit(count: dict[int, int], plan: Plan) -> None:
    """Best fit, decreasing, with all items of a size at once."""
    open_: dict[int, list[list]] = {}  # room -> [pattern, containers]
    rooms: list[int] = []

    def put(room: int, pattern: tuple, n: int) -> None:
        if n:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append([pattern, n])

    for s in sorted(count, reverse=True):
        left = count[s]
        while left:
            at = bisect_left(rooms, s)
            if at < len(rooms):
                room = rooms[at]
                pattern, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                room, pattern = plan.capacity, ()
                n = -(-left // (room // s))
            each = room // s
            full = min(n, left // each)
            put(room - each * s, (*pattern, (s, each)), full)
            left -= full * each
            if full < n:
                if left and left < each:
                    put(room - left * s, (*pattern, (s, left)), 1)
                    left, full = 0, full + 1
                if pattern:
                    put(room, pattern, n - full)
    for room in sorted(open_):
        plan.patterns.extend((p, n) for p, n in open_[room])


def plan_packing(histogram: dict[int, int], capacity: int) -> Plan:
    """Packing of ``histogram`` (size -> number of items, sizes 1 .. capacity)."""
    plan = Plan(capacity)
    count = {s: n for s, n in histogram.items() if n}
    _reduce(count, plan)
    _best_fit(count, plan)
    return plan


def _ranges(plan: Plan) -> list[tuple[int, int, int, int]]:
    """(size, first rank, first container, items of the size per container), by size and rank."""
    used: dict[int, int] = {}
    out, container = [], 0
    for pattern, n in plan.patterns:
        for s, q in pattern:
            out.append((s, used.get(s, 0), container, q))
            used[s] = used.get(s, 0) + n * q
        container += n
    return sorted(out)


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = shared.value
        for batch in batches:
            spec, size, rank = (batch.column(i).to_numpy() for i in (0, 3, 4))
            container = np.empty(len(spec), np.int64)
            for s in np.unique(spec):
                at = np.flatnonzero(spec == s)
                key, first, base, each = plans[int(s)]
                r = np.searchsorted(key, (size[at] << 40) + rank[at], "right") - 1
                container[at] = base[r] + (rank[at] - first[r]) // each[r]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(container)], names=["spec", "doc", "piece", "tokens", "container"])

    return run


def pack(sizes: DataFrame, specs: DataFrame) -> tuple[DataFrame, list[tuple[str, Plan]]]:
    """Containers of all items for every spec.

    ``sizes``: ``doc, tokens``; ``specs``: ``spec_name, capacity_tokens``.  Returns
    ``spec_name, container, doc, piece, first_token, tokens`` and the plans.
    """
    spark = sizes.sparkSession
    stage = Stage(spark, "packing")
    wanted = specs.where("spec_name is not null and capacity_tokens >= 1").select("spec_name", "capacity_tokens").distinct()
    if (wanted.agg(F.sum("capacity_tokens")).first()[0] or 0) > MAX_CAPACITIES:
        raise ValueError(f"capacities of more than {MAX_CAPACITIES} tokens together: pack the specs one by one")
    wanted = sorted((r[0], r[1]) for r in wanted.collect())  # at most MAX_CAPACITIES rows
    empty = "spec_name string, container long, doc long, piece long, first_token long, tokens long"
    if not wanted:
        return spark.createDataFrame([], empty), []
    n_buckets = max(16, sizes.count() // ITEMS_PER_BUCKET)
    kinds = F.array(*[F.struct(F.lit(i).alias("spec"), F.lit(c).cast("long").alias("capacity")) for i, (_, c) in enumerate(wanted)])
    each = sizes.where("tokens >= 1").select("doc", "tokens", F.explode(kinds).alias("k")).select("doc", "tokens", "k.spec", "k.capacity")
    items = each.select("spec", "doc", "tokens", "capacity", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / F.col("capacity")))).alias("piece"))
    size = F.least("capacity", F.col("tokens") - F.col("piece") * F.col("capacity"))
    items = items.select("spec", "doc", "piece", size.alias("tokens"), F.pmod(F.xxhash64("doc", "piece"), F.lit(n_buckets)).cast("int").alias("bucket"))
    counts = stage.write(items.groupBy("spec", "tokens", "bucket").agg(F.count("*").alias("n")))
    histogram: list[dict[int, int]] = [{} for _ in wanted]
    for r in counts.groupBy("spec", "tokens").agg(F.sum("n").alias("n")).collect():  # at most capacity rows a spec
        histogram[r.spec][r.tokens] = r.n
    plans = [plan_packing(h, c) for h, (_, c) in zip(histogram, wanted)]
    ranges = [_ranges(p) for p in plans]
    tables = []
    for r in ranges:
        a = np.array(r, np.int64).reshape(-1, 4)
        tables.append(((a[:, 0] << 40) + a[:, 1], a[:, 1], a[:, 2], a[:, 3]))
    shared = spark.sparkContext.broadcast(tables)
    before = Window.partitionBy("spec", "tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("spec", "tokens", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("spec", "tokens", "bucket").orderBy("doc", "piece")
    ranked = items.withColumn("r", F.row_number().over(within)).join(offsets, ["spec", "tokens", "bucket"])
    ranked = ranked.select("spec", "doc", "piece", "tokens", (F.col("r") - 1 + F.col("offset")).cast("long").alias("rank"))
    placed = ranked.mapInArrow(_place(shared), "spec int, doc long, piece long, tokens long, container long")
    names = F.array(*[F.lit(n) for n, _ in wanted])
    caps = F.array(*[F.lit(c).cast("long") for _, c in wanted])
    out = placed.select(names[F.col("spec")].alias("spec_name"), "container", "doc", "piece", (F.col("piece") * caps[F.col("spec")]).alias("first_token"), "tokens")
    return out, [(n, p) for (n, _), p in zip(wanted, plans)]
