"""Queries of problem 3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.suffix_automaton import cleaned_texts, find_leaks, leaked_items
from quern.sources.tables import table


_FIELDS = (["prompt", "response"], ["prompt", "ground_truth_code"])


def _tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf, "trajectories").select(F.col("traj_id").alias("doc"), "prompt", "response")
    items = table(spark, sf, "eval_items").select(F.col("item_id").alias("item"), "prompt", "ground_truth_code")
    return docs, items


def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = _tables(spark, sf)
    return find_leaks(docs, _FIELDS[0], items, _FIELDS[1])


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaked_items(_leaks(spark, sf)).select(F.col("item").alias("item_id"), F.col("doc").alias("traj_id"))


def p3_items(spark: SparkSession, sf: str) -> DataFrame:
    """How many trajectories each leaked item is found in."""
    return leaked_items(_leaks(spark, sf)).groupBy(F.col("item").alias("item_id")).agg(F.count("*").alias("n_trajectories"))


def p3_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    """Affected texts with the matched spans removed, or dropped where they cover too much."""
    docs, items = _tables(spark, sf)
    out = cleaned_texts(docs, _FIELDS[0], items, _FIELDS[1])
    return out.select(F.col("doc").alias("traj_id"), "field", "words", "covered", "longest", "spans", "dropped", "cleaned")


def p3_covered(spark: SparkSession, sf: str) -> DataFrame:
    """How many words of each affected text stand in spans, and whether that drops it."""
    return p3_cleaned(spark, sf).select("traj_id", "field", "words", "covered", "dropped")


QUERIES = {"p3_covered": p3_covered, "p3_found": p3_found, "p3_items": p3_items, "p3_cleaned": p3_cleaned}

_GRAMS = "unnest(list_transform(range(1, greatest(len(w) - 10, 1)), lambda i: array_to_string(w[i:i + 11], ' '))) g"
_FOUND = f"""
with t as (select traj_id, regexp_extract_all(lower(prompt), '[a-z0-9_]+') w from trajectories
           union all select traj_id, regexp_extract_all(lower(response), '[a-z0-9_]+') from trajectories),
i as (select item_id, regexp_extract_all(lower(prompt), '[a-z0-9_]+') w from eval_items
      union all select item_id, regexp_extract_all(lower(ground_truth_code), '[a-z0-9_]+') from eval_items),
tg as (select distinct traj_id, {_GRAMS} from t where len(w) >= 12),
ig as (select distinct item_id, {_GRAMS} from i where len(w) >= 12),
found as (select distinct item_id, traj_id from ig join tg using (g))
"""
_COVERED = """
with t as (select traj_id, 'prompt' field, any_value(regexp_extract_all(lower(prompt), '[a-z0-9_]+')) w from trajectories group by 1
           union all select traj_id, 'response', any_value(regexp_extract_all(lower(response), '[a-z0-9_]+')) from trajectories group by 1),
i as (select regexp_extract_all(lower(prompt), '[a-z0-9_]+') w from eval_items union all select regexp_extract_all(lower(ground_truth_code), '[a-z0-9_]+') from eval_items),
ig as (select distinct unnest(list_transform(range(1, greatest(len(w) - 10, 1)), lambda i: array_to_string(w[i:i + 11], ' '))) g from i where len(w) >= 12),
tg as (select traj_id, field, unnest(range(1, greatest(len(w) - 10, 1))) place, unnest(list_transform(range(1, greatest(len(w) - 10, 1)), lambda i: array_to_string(w[i:i + 11], ' '))) g from t where len(w) >= 12),
hit as (select traj_id, field, place from tg join ig using (g)),
pos as (select distinct traj_id, field, unnest(range(place, place + 12)) p from hit),
c as (select traj_id, field, count(*) covered from pos group by 1, 2)
select traj_id, field, len(w)::bigint as words, covered, covered > 0.5 * len(w) as dropped from c join t using (traj_id, field)"""
ORACLES = {
    "p3_covered": _COVERED,
    "p3_found": _FOUND + "select item_id, traj_id from found",
    "p3_items": _FOUND + "select item_id, count(*) as n_trajectories from found group by 1",
}
