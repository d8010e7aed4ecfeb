"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.keys import clean_key
from quern.llm.splits import assign_splits, record_groups
from quern.operators.current import current_records
from quern.plans.stage import Stage
from quern.sources.tables import table


def _records(spark: SparkSession, sf: str) -> DataFrame:
    rows = current_records(table(spark, sf, "prompts"), "task_id", "row_idx", ["parent_id", "source", "split"])
    return rows.select("task_id", *[clean_key(c).alias(c) for c in ("parent_id", "source", "split")])


def p2_groups(spark: SparkSession, sf: str) -> DataFrame:
    return record_groups(_records(spark, sf), "task_id", "parent_id", "source").withColumnRenamed("group_key", "group_task_id")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    groups = Stage(spark, "groups").write(p2_groups(spark, sf))
    marked = groups.join(_records(spark, sf).select("task_id", "split"), "task_id")
    mixed = marked.groupBy("group_task_id").agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a <> b")
    return groups.join(mixed, "group_task_id", "left_semi").select("task_id", "group_task_id")


def p2_assigned(spark: SparkSession, sf: str) -> DataFrame:
    groups = Stage(spark, "groups").write(record_groups(_records(spark, sf), "task_id", "parent_id", "source"))
    return assign_splits(groups, table(spark, sf, "split_targets"), "task_id").withColumnRenamed("group_key", "group_task_id")


def p2_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual share of every split, and the records of its largest group."""
    given = Stage(spark, "given").write(p2_assigned(spark, sf))
    total = given.count()
    groups = given.groupBy("split_name", "group_task_id").agg(F.count("*").alias("n"))
    counts = groups.groupBy("split_name").agg(F.sum("n").alias("n_records"), F.count("*").alias("n_groups"), F.max("n").alias("largest_group"))
    out = table(spark, sf, "split_targets").join(counts, "split_name", "left").na.fill(0, ["n_records", "n_groups", "largest_group"])
    return out.select("split_name", "target_share", "n_records", "n_groups", "largest_group", (F.col("n_records") / F.lit(max(total, 1))).alias("actual_share"))


def p2_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Records and groups of the assignment, and what would break the rules: groups in several splits, records without one, a split off its share by more than its largest group."""
    given = Stage(spark, "given").write(p2_assigned(spark, sf))
    names = table(spark, sf, "split_targets").select("split_name")
    groups = given.groupBy("group_task_id").agg(F.count("*").alias("n"), F.count_distinct("split_name").alias("s"), F.min("split_name").alias("split_name"))
    targets = table(spark, sf, "split_targets").groupBy("split_name").agg(F.sum("target_share").alias("w"))
    filled = targets.join(groups.groupBy("split_name").agg(F.sum("n").alias("n"), F.max("n").alias("most")), "split_name", "left").na.fill(0, ["n", "most"])
    total, whole = given.count(), targets.agg(F.sum("w")).first()[0]
    off = F.abs(F.col("n") - F.lit(total) * F.col("w") / F.lit(whole)) > F.greatest("most", F.lit(0.02 * total))
    lost = given.join(names, "split_name", "left_anti").count()
    out = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"), F.count("*").alias("n_groups"), F.count_if(F.col("s") > 1).alias("groups_divided"))
    return out.withColumns({"shares_off": F.lit(filled.where(off).count()).cast("long"), "without_split": F.lit(lost).cast("long")})


QUERIES = {"p2_checked": p2_checked, "p2_found": p2_found, "p2_groups": p2_groups, "p2_assigned": p2_assigned, "p2_shares": p2_shares}

_K = "nullif(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '')"
_GROUPS = f"""
with recursive cur as (select {_K.format('task_id')} t, max(row_idx) r from prompts where {_K.format('task_id')} is not null group by 1),
rec as (select c.t, {_K.format('p.parent_id')} p, {_K.format('p.source')} s, {_K.format('p.split')} sp from cur c join prompts p on p.row_idx = c.r),
e as (select '1' || t a, '1' || p b from rec where p is not null union select '1' || t, '0' || s from rec where s is not null),
adj as (select a, b from e union select b, a from e union select '1' || t, '1' || t from rec),
reach as (select a x, b y from adj union select r.x, d.b from reach r join adj d on d.a = r.y),
g as (select substr(x, 2) task_id, min(substr(y, 2)) group_task_id from reach join rec q on y = '1' || q.t where x in (select '1' || t from rec) group by 1)
"""
ORACLES = {
    "p2_checked": _GROUPS + "select count(*) as n_records, count(distinct group_task_id) as n_groups, 0::bigint as groups_divided, 0::bigint as shares_off, 0::bigint as without_split from g",
    "p2_groups": _GROUPS + "select task_id, group_task_id from g",
    "p2_found": _GROUPS
    + "select g.task_id, g.group_task_id from g where group_task_id in (select group_task_id from g join rec on rec.t = g.task_id group by 1 having count(distinct sp) > 1)",
}
