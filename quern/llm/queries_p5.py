"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.keys import is_blank
from quern.llm.likeness import expand_pairs
from quern.llm.order_minhash import near_duplicates, similar_classes
from quern.sources.tables import table


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "trajectories").where(~is_blank(F.col("response")))
    return rows.select(F.col("traj_id").alias("doc"), F.concat(F.coalesce("prompt", F.lit("")), F.lit(" "), F.col("response")).alias("text"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs, members = near_duplicates(_texts(spark, sf))
    out = expand_pairs(pairs.where("likeness >= 0.6"), members)
    return out.select(F.col("x").alias("traj_id_a"), F.col("y").alias("traj_id_b"))


def p5_groups(spark: SparkSession, sf: str) -> DataFrame:
    """The class of every trajectory, and how many others have the same words."""
    return similar_classes(_texts(spark, sf)).withColumnRenamed("doc", "traj_id")


QUERIES = {"p5_found": p5_found, "p5_groups": p5_groups}

_FOUND = """
with d as (select traj_id, any_value(regexp_extract_all(lower(coalesce(prompt, '') || ' ' || response), '[a-z0-9_]+')) w
           from trajectories where response is not null and regexp_replace(response, '\\s+', '', 'g') <> '' group by 1),
s as (select distinct traj_id, unnest(list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) g from d),
n as (select traj_id, count(*) n from s group by 1),
f as (select g, count(*) c from s group by 1),
r as (select s.traj_id, s.g, n.n, row_number() over (partition by s.traj_id order by f.c, s.g) k from s join f using (g) join n using (traj_id)),
p as (select traj_id, g from r where k <= n - ceil(0.6 * n) + 1),
c as (select distinct a.traj_id a, b.traj_id b from p a join p b on a.g = b.g and a.traj_id < b.traj_id),
v as (select c.a, c.b, count(*) shared from c join s x on x.traj_id = c.a join s y on y.traj_id = c.b and x.g = y.g group by 1, 2)
"""
_GROUPS = _FOUND.replace("with d as", "with recursive d as", 1) + """,
m as (select traj_id, min(traj_id) over (partition by w) rep, count(*) over (partition by w) - 1 copies from d where len(w) >= 3),
e as (select distinct p.rep a, q.rep b from v join n x on x.traj_id = v.a join n y on y.traj_id = v.b join m p on p.traj_id = v.a join m q on q.traj_id = v.b
      where v.shared >= 0.6 * (x.n + y.n - v.shared) and p.rep <> q.rep),
adj as (select a, b from e union select b, a from e),
reach as (select rep x, rep y from m union select r.x, adj.b from reach r join adj on adj.a = r.y),
k as (select x, min(y) class_id from reach group by 1)
select m.traj_id, k.class_id, m.copies from m join k on k.x = m.rep"""
ORACLES = {
    "p5_groups": _GROUPS,
    "p5_found": _FOUND + "select v.a as traj_id_a, v.b as traj_id_b from v join n x on x.traj_id = v.a join n y on y.traj_id = v.b where v.shared >= 0.6 * (x.n + y.n - v.shared)",
}
