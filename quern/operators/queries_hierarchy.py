"""Queries of problem 4: hierarchies of prompt records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.keys import clean_key
from quern.operators.current import current_records
from quern.operators.hierarchy import descendants, resolve_hierarchy
from quern.sources.tables import table


def _links(spark: SparkSession, sf: str) -> DataFrame:
    rows = current_records(table(spark, sf, "prompts"), "task_id", "row_idx", ["parent_id"])
    return rows.select(F.col("task_id").alias("node"), clean_key("parent_id").alias("parent"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    out = resolve_hierarchy(_links(spark, sf)).where("linked")
    return out.select(F.col("node").alias("task_id"), F.col("root").alias("root_task_id"), "depth")


def p4_paths(spark: SparkSession, sf: str) -> DataFrame:
    out = resolve_hierarchy(_links(spark, sf), with_path=True)
    below = descendants(out).groupBy(F.col("ancestor").alias("node")).agg(F.count("*").alias("n"))
    return out.join(below, "node", "left").select(
        F.col("node").alias("task_id"),
        F.col("root").alias("root_task_id"),
        "depth",
        F.array_join("path", " > ").alias("path"),
        F.coalesce("n", F.lit(0).cast("long")).alias("descendants"),
    )


def p4_descendants(spark: SparkSession, sf: str) -> DataFrame:
    out = descendants(resolve_hierarchy(_links(spark, sf), with_path=True))
    return out.select(F.col("ancestor").alias("ancestor_task_id"), F.col("node").alias("task_id"), "distance")


QUERIES = {"p4_found": p4_found, "p4_paths": p4_paths, "p4_descendants": p4_descendants}

_K = "nullif(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '')"
_FOUND = """
with recursive cur as (select K_TASK t, max(row_idx) r from prompts where K_TASK is not null group by 1),
rec as (select c.t, K_PARENT p from cur c join prompts x on x.row_idx = c.r),
link as (select a.t, a.p from rec a join rec b on a.p = b.t),
good as (select r.t node, r.t root, 0::bigint d, r.t path from rec r anti join link l on l.t = r.t
         union all
         select l.t, g.root, g.d + 1, g.path || ' > ' || l.t from good g join link l on l.p = g.node),
bad as (select l.t, l.p from link l anti join good g on g.node = l.t),
reach as (select t a, p b from bad union select r.a, b.p from reach r join bad b on r.b = b.t),
cyc as (select a node, min(b) root from (select r.a, r.b from reach r join (select a from reach where a = b) c on r.b = c.a) group by 1)
"""
_FOUND = _FOUND.replace("K_TASK", _K.format("task_id")).replace("K_PARENT", _K.format("x.parent_id"))

ORACLES = {
    "p4_found": _FOUND + "select node as task_id, root as root_task_id, d as depth from good where d > 0 union all select node, root, -1::bigint from cyc",
    "p4_paths": _FOUND
    + """, desc_ as (select l.p a, l.t b from link l semi join good g on g.node = l.t union all select d.a, l.t from desc_ d join link l on l.p = d.b),
num as (select a, count(*) n from desc_ group by 1)
select g.node as task_id, g.root as root_task_id, g.d as depth, g.path as path, coalesce(n.n, 0)::bigint as descendants from good g left join num n on n.a = g.node
union all select node, root, -1::bigint, null, 0::bigint from cyc""",
    "p4_descendants": _FOUND
    + """, desc_ as (select l.p a, l.t b, 1::bigint k from link l semi join good g on g.node = l.t union all select d.a, l.t, d.k + 1 from desc_ d join link l on l.p = d.b)
select a as ancestor_task_id, b as task_id, k as distance from desc_""",
}
