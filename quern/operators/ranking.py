"""Best candidates and preference pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def score(correct: Column, compiled: Column, speed: Column, tokens: Column) -> Column:
    """Acceptance score of a candidate; missing parts count as 0."""
    z = lambda c: F.coalesce(c, F.lit(0.0))
    return 100.0 * z(correct) + 10.0 * z(compiled) + 5.0 * z(speed) - 0.01 * z(tokens)


def tier(passed: Column, improved: Column, repairs: Column, composite: Column) -> Column:
    """reject, optimized, repair, gold (composite of at least 0.5) or silver, in this order."""
    return (
        F.when(~F.coalesce(passed, F.lit(False)), "reject")
        .when(F.coalesce(improved, F.lit(False)), "optimized")
        .when(F.coalesce(repairs, F.lit(0)) > 0, "repair")
        .when(composite >= 0.5, "gold")
        .otherwise("silver")
    )


def best_of_each(rows: DataFrame, group: str, *order: Column, keep: list[str]) -> DataFrame:
    """The row of each group with the smallest ``order`` (a struct comparison; nulls first).

    One combined aggregation; a hot group costs one row per map task.
    """
    low = F.min(F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], *[F.col(k) for k in keep])).alias("_b")
    return rows.groupBy(group).agg(low).select(group, *[F.col(f"_b.{k}").alias(k) for k in keep])


def preference_pairs(rows: DataFrame, group: str, key: str, ms: str, text: str, min_speedup: float = 0.03) -> DataFrame:
    """Fastest passing candidate of each group against every other one that is slower by ``min_speedup``.

    ``rows``: passing candidates.  A null or zero time sorts last and gives no
    pair; ties go to the smaller ``key``.  The winner is found by aggregation and joined back, so
    a group of any size is spread over tasks.
    """
    usable = rows.withColumn("_t", F.coalesce(F.nullif(F.col(ms), F.lit(0.0)), F.lit(float("inf"))))
    won = best_of_each(usable, group, F.col("_t"), F.col(key), keep=[key, ms, text])
    won = won.select(group, F.col(key).alias("winner"), F.col(ms).alias("winner_ms"), F.col(text).alias("chosen"))
    both = usable.join(won, group).where(F.col(key) != F.col("winner")).where((F.col(ms) > 0) & F.col("winner_ms").isNotNull())
    filled = (F.trim(text) != "") & (F.trim("chosen") != "")
    speedup = (F.col(ms) - F.col("winner_ms")) / F.col(ms)
    out = both.where(filled).withColumn("speedup", speedup).where(F.col("speedup") >= min_speedup)
    return out.select(group, "winner", F.col(key).alias("loser"), "winner_ms", F.col(ms).alias("loser_ms"), "speedup", "chosen", F.col(text).alias("rejected"))


def timing_summary(rows: DataFrame, group: str, ms: str, bins: int = 4096) -> DataFrame:
    """Count, exact median, 95th percentile by floor index, least and largest time of each group.

    Times are counted in ``bins`` equal bins between the least and largest of the group; the
    running counts of the bins (a bounded table) show in which bins the wanted order
    statistics lie, and only the values of those bins are ordered.  So no group is sorted as a
    whole.  Null times are left out; groups without times give no row.
    """
    used = rows.where(F.col(ms).isNotNull()).select(group, F.col(ms).cast("double").alias("v"))
    facts = used.groupBy(group).agg(F.count("*").alias("n"), F.min("v").alias("min_ms"), F.max("v").alias("max_ms"))
    width = F.col("max_ms") - F.col("min_ms")
    where = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("min_ms")) / width * bins), F.lit(bins - 1))).otherwise(0)
    # A null-safe join, so that rows without a group form one.
    named = facts.withColumnRenamed(group, "_g")
    binned = used.join(F.broadcast(named) if facts.limit(10_001).count() <= 10_000 else named, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
    binned = binned.withColumn("bin", where.cast("int")).groupBy(group, "bin", "v").agg(F.count("*").alias("c"), F.first("n").alias("n"))
    before = Window.partitionBy(group).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins_ = binned.groupBy(group, "bin").agg(F.sum("c").alias("in_bin"), F.first("n").alias("n")).withColumn("before", F.coalesce(F.sum("in_bin").over(before), F.lit(0)))
    ranks = {"a": F.floor((F.col("n") - 1) / 2), "b": F.floor(F.col("n") / 2), "p95_ms": F.floor(0.95 * (F.col("n") - 1))}
    hit = lambda r: (F.col("before") <= r) & (r < F.col("before") + F.col("in_bin"))
    wanted = bins_.where(hit(ranks["a"]) | hit(ranks["b"]) | hit(ranks["p95_ms"])).select(F.col(group).alias("_g"), F.col("bin").alias("_b"), "before")
    within = Window.partitionBy(group, "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    near = binned.join(wanted, F.col(group).eqNullSafe(F.col("_g")) & (F.col("bin") == F.col("_b"))).withColumn("upto", F.col("before") + F.sum("c").over(within))
    at = lambda r: F.min(F.when((F.col("upto") > r) & (r >= F.col("upto") - F.col("c")), F.col("v")))
    got = near.groupBy(F.col(group).alias("_g")).agg(*[at(r).alias(k) for k, r in ranks.items()])
    out = facts.join(got, F.col(group).eqNullSafe(F.col("_g")))
    return out.select(group, "n", ((F.col("a") + F.col("b")) / 2).alias("median_ms"), "p95_ms", "min_ms", "max_ms")
