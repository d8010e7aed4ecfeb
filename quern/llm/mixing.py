"""Mixing sources to target weights.

*Amount.*  A source with T tokens and at most R repeats can give R * T.  The mix is
the largest whose every usable source gives its share of it: total = min R * T /
share, shares normalised over the sources that have documents.

*Choice.*  The documents of a source stand in hashed order.  A quota of q tokens takes
every document floor(q / T) times, then one pass more of those that end within the
rest.  The gap left (less than one document) is filled with one more use of documents
that may be used again, the longest that fit first, chosen on the histogram of their
sizes (sizes above GAP_SIZES are left out, so a source's histogram is bounded).  Running sums are taken in
sub-buckets, so a source that holds a third of all documents is handled by many tasks.  A
bucket is a range of hashes: the order, and with it the choice, is the same for any number of buckets.

*Order.*  Pfair scheduling: the chosen tokens of a source form one stream, cut into
blocks of equal length, at document borders or not; block i of a source of weight w
is released once i / w and due before (i + 1) / w blocks of all sources are
delivered, and each slot goes to the released block that is due first.  After any
number of slots each source is within one block of its weight of what is delivered.
The driver makes the schedule and writes it in stretches, so a block has its tokens in
a mix of any size.  A document that crosses block ends gives one row for
each block, with the first token of its part; nothing else of it is changed.

Defined cases: null and blank texts are no documents; documents of null sources or
sources without a target are not used; targets without documents, or with a null
or non-positive share or repeats, get nothing and are reported with an actual share
of 0; source names are compared cleaned; if several targets have one name, shares add up and
the larger number of repeats holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.keys import clean_key
from quern.plans.stage import Stage

BLOCK = 4096
RUN = 1024  # blocks of a source whose slots are one row
STRETCH = 1 << 19  # slots that are written, or summed, at once
MAX_SOURCES = 1000
GAP_SIZES = 1 << 16
DOCS_PER_BUCKET = 200_000


def pfair_order(tokens: dict[str, int], block: int) -> Iterator[str]:
    """The source of each slot, earliest deadline first, for sources with that many tokens.

    Time is what is delivered, in whole tokens, so it is exact at any length; the last block of a source may be shorter.
    """
    whole = sum(tokens.values())
    names = sorted(s for s, n in tokens.items() if n)
    sizes = [tokens[s] for s in names]
    ready: list[tuple[int, int]] = [(whole * block // n, s) for s, n in enumerate(sizes)]  # due before, source
    ready.sort()
    waiting: list[tuple[int, int]] = []  # released, source
    given, time = [0] * len(names), 0
    left = list(sizes)
    while ready or waiting:
        while waiting and (not ready or waiting[0][0] <= time):
            _, s = heappop(waiting)
            heappush(ready, ((given[s] + 1) * whole * block // sizes[s], s))
        _, s = heappop(ready)
        yield names[s]
        given[s] += 1
        size = min(block, left[s])
        left[s] -= size
        time += size
        if left[s]:
            heappush(waiting, (-(-given[s] * whole * block // sizes[s]), s))


def pfair_slots(tokens: dict[str, int], block: int) -> dict[str, list[int]]:
    """The slots of every block of each source."""
    slots: dict[str, list[int]] = {s: [] for s in tokens}
    for t, s in enumerate(pfair_order(tokens, block)):
        slots[s].append(t)
    return slots


def _write_schedule(stage: Stage, tokens: dict[str, int], block: int) -> DataFrame:
    """The schedule as a table ``source, run, slots``, with RUN blocks a row; the driver holds a stretch, and RUN slots of each source."""
    schema, path, rows = "source string, run long, slots array<long>", stage.next_path(), []
    begun: dict[str, list[int]] = {s: [] for s in tokens}
    runs = dict.fromkeys(tokens, 0)

    def write() -> None:
        stage.spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
        rows.clear()

    for t, s in enumerate(pfair_order(tokens, block)):
        begun[s].append(t)
        if len(begun[s]) == RUN:
            rows.append((s, runs[s], begun[s]))
            begun[s] = []
            runs[s] += 1
            if len(rows) * RUN >= STRETCH:
                write()
    rows += [(s, runs[s], mine) for s, mine in begun.items() if mine]
    write()
    return stage.spark.read.schema(schema).parquet(path)


def _choose(rooms: dict[str, int]):
    """Per source, how many unused documents of which size fill its gap."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("tokens", ascending=False)
        room, out = rooms[part["source"].iloc[0]], []
        for size, n in zip(part["tokens"], part["n"]):
            used = min(int(n), room // int(size))
            if used:
                out.append((part["source"].iloc[0], int(size), used))
                room -= used * int(size)
        return pd.DataFrame(out, columns=["source", "tokens", "wanted"])

    return run


def _fill_gaps(stage: Stage, spare: DataFrame, rooms: dict[str, int], begin: dict[str, int]) -> DataFrame:
    """Documents that fill the gaps of their sources by one more use: ``source, doc, tokens, at, copy``."""
    spark = spare.sparkSession
    facts = spark.createDataFrame([(s, r, begin[s]) for s, r in sorted(rooms.items())], "source string, room long, begin long")
    fit = spare.join(F.broadcast(facts), "source").where(F.col("tokens") <= F.least("room", F.lit(GAP_SIZES)))  # at most MAX_SOURCES rows
    counts = stage.write(fit.groupBy("source", "tokens", "bucket").agg(F.count("*").alias("n")))
    sizes = counts.groupBy("source", "tokens").agg(F.sum("n").alias("n"))
    wanted = stage.write(sizes.groupBy("source").applyInPandas(_choose(rooms), "source string, tokens long, wanted long"))  # at most GAP_SIZES rows a source
    before = Window.partitionBy("source", "tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.join(wanted, ["source", "tokens"]).select("source", "tokens", "bucket", "wanted", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")).where("offset < wanted")
    within = Window.partitionBy("source", "tokens", "bucket").orderBy("key", "doc", "copy")
    ranked = fit.join(offsets, ["source", "tokens", "bucket"]).withColumn("r", F.row_number().over(within) + F.col("offset")).where("r <= wanted")
    along = Window.partitionBy("source").orderBy(F.desc("tokens"), "doc", "copy").rowsBetween(Window.unboundedPreceding, -1)  # at most a gap's tokens
    return ranked.select("source", "doc", "tokens", (F.col("begin") + F.coalesce(F.sum("tokens").over(along), F.lit(0))).alias("at"), "copy")


def mix(sizes: DataFrame, targets: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The selection ``slot, source, doc, copy, first_token, tokens`` and the report per target.

    ``sizes``: ``doc, source, tokens``; ``targets``: ``source, target_share, max_repeats``.
    """
    spark = sizes.sparkSession
    stage = Stage(spark, "mixing")
    rows = targets.select(clean_key("source").alias("source"), "target_share", "max_repeats").where("source is not null")
    rows = rows.groupBy("source").agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("repeats")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"at most {MAX_SOURCES} sources")
    goal = {r.source: (r.share or 0.0, r.repeats or 0) for r in rows}
    sizes = sizes.select("doc", clean_key("source").alias("source"), "tokens").where(F.col("source").isin(list(goal)) & (F.col("tokens") > 0))
    bits = max(4, (sizes.count() // DOCS_PER_BUCKET).bit_length())
    sizes = sizes.withColumn("key", F.xxhash64("doc")).withColumn("bucket", F.shiftright("key", 64 - bits).cast("int"))  # buckets follow the keys
    sums = stage.write(sizes.groupBy("source", "bucket").agg(F.sum("tokens").alias("t")))
    have = {r[0]: r[1] for r in sums.groupBy("source").agg(F.sum("t")).collect()}  # at most MAX_SOURCES rows
    usable = {s: x for s, (x, r) in goal.items() if x > 0 and r > 0 and have.get(s)}
    whole = sum(usable.values())
    total = min((goal[s][1] * have[s] * whole / x for s, x in usable.items()), default=0.0)
    quota = {s: int(x / whole * total + 1e-6) for s, x in usable.items()}
    passes = {s: q // have[s] for s, q in quota.items()}
    facts = [(s, passes[s], have[s], quota[s] - passes[s] * have[s], int(goal[s][1])) for s in sorted(quota)]
    facts = spark.createDataFrame(facts, "source string, passes long, have long, rest long, repeats int")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "bucket", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("upto", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(offsets, ["source", "bucket"]).join(F.broadcast(facts), "source")  # at most MAX_SOURCES rows
    placed = stage.write(placed.select("source", "bucket", "key", "doc", "tokens", (F.col("offset") + F.col("upto")).alias("at"), "passes", "have", "rest", "repeats"))
    in_rest = F.col("at") + F.col("tokens") <= F.col("rest")
    begun = {r.source: r.t for r in placed.where(in_rest).groupBy("source").agg(F.sum("tokens").alias("t")).collect()}  # at most MAX_SOURCES rows
    rooms = {s: q - passes[s] * have[s] - begun.get(s, 0) for s, q in quota.items()}
    rooms = {s: r for s, r in rooms.items() if r}
    uses = F.col("passes") + F.when(in_rest, 1).otherwise(0)
    chosen = placed.where(uses > 0).select("source", "doc", "tokens", "at", "have", F.explode(F.sequence(F.lit(0).cast("long"), uses - 1)).alias("copy"))
    chosen = chosen.select("source", "doc", "tokens", (F.col("copy") * F.col("have") + F.col("at")).alias("at"), "copy")
    if rooms:
        spare = placed.where(uses < F.col("repeats")).select("source", "doc", "tokens", "bucket", "key", uses.alias("copy"))
        chosen = chosen.unionByName(_fill_gaps(stage, spare, rooms, {s: quota[s] - r for s, r in rooms.items()}))
    chosen = stage.write(chosen)
    given = chosen.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("uses"), F.count_if(F.col("copy") == 0).alias("documents"), F.max("copy").alias("c"))
    given = stage.write(given)
    tokens = {r.source: r.tokens for r in given.collect()}  # at most MAX_SOURCES rows
    mixed = sum(tokens.values())
    schedule = _write_schedule(stage, tokens, block)
    parts = chosen.withColumn("i", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("tokens") - 1) / block))))
    first = F.greatest(F.col("i") * block - F.col("at"), F.lit(0))
    last = F.least((F.col("i") + 1) * block - F.col("at"), F.col("tokens"))
    out = parts.withColumn("run", F.floor(F.col("i") / RUN)).join(schedule, ["source", "run"])
    out = out.select(F.get("slots", (F.col("i") % RUN).cast("int")).alias("slot"), "source", "doc", F.col("copy").cast("int").alias("copy"), first.alias("first_token"), (last - first).alias("tokens"))
    all_ = spark.createDataFrame([(s, float(x), int(r)) for s, (x, r) in sorted(goal.items())], "source string, target_share double, max_repeats int")
    report = all_.join(given, "source", "left").na.fill(0, ["tokens", "uses", "documents"])
    report = report.select("source", "target_share", "max_repeats", "tokens", "uses", "documents", (F.coalesce("c", F.lit(-1)) + 1).alias("repeats"), (F.col("tokens") / F.lit(float(max(mixed, 1)))).alias("actual_share"))
    return out, report


def deviations(selection: DataFrame) -> DataFrame:
    """``source, most_tokens``: the largest distance, before or after any slot, between what a source gave and its weight of what all gave.

    Between the slots of a source the distance changes one way only, so its own slots suffice.
    """
    per_slot = selection.groupBy("slot", "source").agg(F.sum("tokens").alias("tokens")).withColumn("stretch", F.floor(F.col("slot") / STRETCH))
    sums = per_slot.groupBy("stretch", "source").agg(F.sum("tokens").alias("t"))
    earlier = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)  # one row for each STRETCH slots
    whole = sums.groupBy("stretch").agg(F.sum("t").alias("t"))
    whole = whole.select("stretch", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("all_before"), F.sum("t").over(Window.partitionBy()).alias("whole"))
    earlier = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    share = sums.select("source", "stretch", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("mine_before"), F.sum("t").over(Window.partitionBy("source")).alias("share"))
    along = Window.partitionBy("stretch").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)  # at most STRETCH rows
    own = Window.partitionBy("stretch", "source").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    sums = per_slot.select("source", "stretch", "tokens", F.sum("tokens").over(along).alias("all"), F.sum("tokens").over(own).alias("mine"))
    sums = sums.join(share, ["source", "stretch"]).join(whole, "stretch")
    sums = sums.select("source", "tokens", (F.col("all_before") + F.col("all")).alias("all"), (F.col("mine_before") + F.col("mine")).alias("mine"), (F.col("share") / F.col("whole")).alias("weight"))
    after = F.abs(F.col("mine") - F.col("weight") * F.col("all"))
    before = F.abs(F.col("mine") - F.col("tokens") - F.col("weight") * (F.col("all") - F.col("tokens")))
    return sums.groupBy("source").agg(F.max(F.greatest(after, before)).alias("most_tokens"))
