"""Queries of problem 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.keys import clean_key
from quern.llm.chunks import cross_overlaps, expand_across, record_overlaps
from quern.operators.current import current_records
from quern.plans.stage import Stage
from quern.sources.tables import table

EVALUATION = ("dev", "eval", "test", "held_out")


def _records(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Current records (doc, task_id, split, source, mask) and the texts of those of a side (doc, text, mask)."""
    rows = table(spark, sf, "prompts")
    records = current_records(rows, "task_id", "row_idx", ["split", "source"])
    split = clean_key("split")
    mask = F.when(split == "train", 1).when(split.isin(*EVALUATION), 2).cast("byte")
    records = Stage(spark, "prompts").write(records.select("task_id", F.col("row_idx").alias("doc"), split.alias("split"), clean_key("source").alias("source"), mask.alias("mask")))
    return records, rows.select(F.col("row_idx").alias("doc"), F.col("prompt").alias("text")).join(records.where("mask is not null").select("doc", "mask"), "doc")


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of current records: train_*, eval_* with task_id, split and source."""
    records, texts = _records(spark, sf)
    pairs, members = cross_overlaps(texts)
    out = expand_across(pairs, members)
    train = records.select(F.col("doc").alias("train_doc"), F.col("task_id").alias("train_task_id"), F.col("source").alias("train_source"))
    evaluation = records.select(F.col("doc").alias("eval_doc"), F.col("task_id").alias("eval_task_id"), F.col("source").alias("eval_source"), F.col("split").alias("eval_split"))
    return out.join(train, "train_doc").join(evaluation, "eval_doc")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    out = _pairs(spark, sf)
    return out.select(F.least("train_task_id", "eval_task_id").alias("task_id_a"), F.greatest("train_task_id", "eval_task_id").alias("task_id_b"))


def p6_report(spark: SparkSession, sf: str) -> DataFrame:
    """Affected evaluation records and pairs per split and source."""
    return _pairs(spark, sf).groupBy("eval_split", "eval_source").agg(F.count("*").alias("n_pairs"), F.count_distinct("eval_task_id").alias("n_records"))


def p6_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    """Per split and source of all records of a side: records, words, words in chunks that the other side holds, and records of which these are at least half."""
    records, texts = _records(spark, sf)
    out = record_overlaps(texts).join(records.select("doc", "split", "source"), "doc").groupBy("split", "source")
    return out.agg(F.count("*").alias("n_records"), F.sum("words").alias("words"), F.sum("shared").alias("shared_words"), F.avg("overlap").alias("mean_overlap"), F.count_if(F.col("overlap") >= 0.5).alias("n_half"))


QUERIES = {"p6_found": p6_found, "p6_report": p6_report, "p6_overlaps": p6_overlaps}

_K = "nullif(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '')"
_FOUND = f"""
with cur as (select {_K.format('task_id')} t, max(row_idx) r from prompts where {_K.format('task_id')} is not null group by 1),
d as (select c.t, {_K.format('p.split')} sp, {_K.format('p.source')} src, regexp_extract_all(lower(prompt), '[a-z0-9_]+') w from cur c join prompts p on p.row_idx = c.r),
s as (select distinct t, sp, unnest(list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) g from d),
n as (select t, count(*) n from s group by 1),
v as (select a.t x, b.t y, count(*) k from s a join s b using (g) where a.sp = 'train' and b.sp in ('dev', 'eval', 'test', 'held_out') group by 1, 2),
found as (select x, y from v join n p on p.t = x join n q on q.t = y where k >= 0.6 * (p.n + q.n - k))
"""
ORACLES = {
    "p6_found": _FOUND + "select least(x, y) as task_id_a, greatest(x, y) as task_id_b from found",
    "p6_report": _FOUND + "select d.sp as eval_split, d.src as eval_source, count(*) as n_pairs, count(distinct y) as n_records from found join d on d.t = y group by 1, 2",
}
