"""Queries of problem 1."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.keys import clean_key
from quern.llm.history import HistoryIndex, matches, record_keys, submit
from quern.plans.files import file_states
from quern.plans.stage import stage_root
from quern.sources.tables import table


_SOURCES = ("accepted_fingerprints", "registry_snapshots", "accepted_task_ids")


def accepted_index(spark: SparkSession, sf: str) -> HistoryIndex:
    """History of the accepted fingerprints and of the accepted-id lists that a snapshot names.

    The index stands in the shared folder under the names, sizes and times of its source files: if it is
    there already it is opened, and the sources are not read.
    """
    state = [(t, file_states(spark, f"{sf}/{t}.parquet")) for t in _SOURCES]
    index = HistoryIndex(spark, f"{stage_root(spark)}/accepted-{hashlib.sha256(repr((sf, state)).encode()).hexdigest()[:24]}")
    if index.generations:
        return index
    paths = table(spark, sf, "registry_snapshots").select(clean_key("task_ids_path").alias("path")).where("path is not null").distinct()
    listed = table(spark, sf, "accepted_task_ids").select(clean_key("task_ids_path").alias("path"), "task_id").join(paths, "path", "left_semi")
    listed = record_keys(listed.select(F.lit(0).cast("long").alias("id"), F.lit(None).cast("string").alias("gpu_architecture"), "task_id"), "id", (("task_id", False),), (4,))
    index.append(record_keys(table(spark, sf, "accepted_fingerprints"), "fp_id").unionByName(listed))
    return index


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = submit(accepted_index(spark, sf), table(spark, sf, "batch_fingerprints"), append=False)
    return verdicts.where("not is_new").select(F.col("id").alias("fp_id"))


def p1_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each batch, and how many of them bring nothing new."""
    batch = table(spark, sf, "batch_fingerprints")
    verdicts = submit(accepted_index(spark, sf), batch, append=False)
    rows = batch.groupBy("fp_id").agg(F.min("batch_id").alias("batch_id"))
    out = rows.join(verdicts, rows.fp_id == verdicts.id).groupBy("batch_id")
    return out.agg(F.count("*").alias("n_rows"), F.sum(F.when(F.col("is_new"), 0).otherwise(1)).alias("n_found"))


def p1_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Batch rows that the history knows: the most similar of the accepted rows that first brought one of their keys (0: an accepted-id list), the share of keys in which both agree, and how many keys are held."""
    found = matches(accepted_index(spark, sf), table(spark, sf, "batch_fingerprints"))
    return found.select(F.col("id").alias("fp_id"), F.col("match_id").alias("match_fp_id"), "shared", "similarity")


QUERIES = {"p1_found": p1_found, "p1_batches": p1_batches, "p1_matches": p1_matches}

_K = "nullif(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '')"
_H = "nullif(regexp_extract(lower({0}), '([0-9a-f]{{64}})', 1), '')"
_ARCH = f"coalesce({_K.format('gpu_architecture')}, 'blackwell')"
_KEYS = " union ".join(
    [f"select fp_id, 'p' || {_ARCH} || {_H.format('prompt_hash')} k from TABLE_", f"select fp_id, 'a' || {_ARCH} || {_H.format('assistant_ast_hash')} from TABLE_"]
    + [f"select fp_id, '{c[0]}' || {_H.format(c)} from TABLE_" for c in ("semantic_hash", "reference_ast_hash")]
    + [f"select fp_id, 't' || {_K.format('task_id')} from TABLE_"]
)
_FOUND = f"""
with b as (select * from ({_KEYS.replace('TABLE_', 'batch_fingerprints')}) where k is not null),
h as (select k from ({_KEYS.replace('TABLE_', 'accepted_fingerprints')}) where k is not null
      union select 't' || {_K.format('task_id')} from accepted_task_ids where {_K.format('task_id')} is not null
        and {_K.format('task_ids_path')} in (select {_K.format('task_ids_path')} from registry_snapshots where task_ids_path is not null)),
f as (select k, min(fp_id) m from b group by k),
found as (select distinct b.fp_id from b join f using (k) where b.fp_id > f.m or b.k in (select k from h))
"""
_MATCHES = f"""
with b as (select distinct fp_id, k from ({_KEYS.replace('TABLE_', 'batch_fingerprints')}) where k is not null),
h as (select fp_id, k from ({_KEYS.replace('TABLE_', 'accepted_fingerprints')}) where k is not null
      union select 0, 't' || {_K.format('task_id')} from accepted_task_ids where {_K.format('task_id')} is not null
        and {_K.format('task_ids_path')} in (select {_K.format('task_ids_path')} from registry_snapshots where task_ids_path is not null)),
m as (select k, min(fp_id) f from h group by 1),
-- the signature of an accepted-id list holds the key by which it was met only
c as (select b.fp_id, m.f, b.k from b join m using (k)),
n as (select fp_id, count(distinct left(k, 1)) n from b group by 1), hn as (select fp_id, count(*) n from h where fp_id > 0 group by 1),
s as (select c.fp_id, c.f, c.k, case when c.f = 0 then 1.0 / n.n
        else (select count(*) from b x join h y on x.k = y.k where x.fp_id = c.fp_id and y.fp_id = c.f) * 1.0
           / (select count(distinct left(k, 1)) from (select k from b x where x.fp_id = c.fp_id union all select k from h y where y.fp_id = c.f)) end sim
      from c join n using (fp_id)),
r as (select *, row_number() over (partition by fp_id order by sim desc, f) o, count(*) over (partition by fp_id) shared from s)
select fp_id, f as match_fp_id, shared, sim as similarity from r where o = 1"""
ORACLES = {
    "p1_matches": _MATCHES,
    "p1_found": _FOUND + "select fp_id from found",
    "p1_batches": _FOUND + """, r as (select fp_id, min(batch_id) batch_id from batch_fingerprints group by 1)
select batch_id, count(*) as n_rows, sum(case when f2.fp_id is null then 0 else 1 end)::bigint as n_found
from r left join found f2 on f2.fp_id = r.fp_id group by 1""",
}
