"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.packing import pack
from quern.llm.tokens import token_sizes
from quern.plans.stage import Stage
from quern.sources.tables import table


def _packed(spark: SparkSession, sf: str):
    sizes = token_sizes(table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "text"))
    return pack(sizes, table(spark, sf, "pack_specs"))


def p7_assigned(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf)[0].withColumnRenamed("doc", "doc_id")


def p7_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Containers, fill and the least possible number of containers of every spec."""
    out, plans = _packed(spark, sf)
    totals = out.groupBy("spec_name").agg(F.count_distinct("container").alias("containers"), F.sum("tokens").alias("tokens"), F.max("container").alias("last"))
    facts = spark.createDataFrame([(n, p.capacity, p.fixed) for n, p in plans], "spec_name string, capacity_tokens long, fixed_containers long")
    return facts.join(totals, "spec_name", "left").select(
        "spec_name",
        "capacity_tokens",
        "containers",
        "fixed_containers",
        "tokens",
        F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_containers"),
        (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("fill"),
    )


def p7_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Per spec: documents placed whole, and what would break the rules (containers above capacity, texts divided without need or not wholly placed)."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "text")
    sizes = token_sizes(docs)
    out, _ = pack(sizes, table(spark, sf, "pack_specs"))
    out = Stage(spark, "packed").write(out)
    full = out.groupBy("spec_name", "container").agg(F.sum("tokens").alias("t")).groupBy("spec_name").agg(F.max("t").alias("fullest"), F.min("container").alias("first"), F.max("container").alias("last"), F.count("*").alias("n"))
    texts = out.groupBy("spec_name", "doc").agg(F.sum("tokens").alias("placed"), F.count("*").alias("pieces"), F.max(F.col("first_token") + F.col("tokens")).alias("end"), F.count_distinct("first_token").alias("starts"))
    specs = table(spark, sf, "pack_specs").select("spec_name", "capacity_tokens").distinct()
    texts = texts.join(sizes, "doc").join(F.broadcast(specs), "spec_name")
    needed = F.ceil(F.col("tokens") / F.col("capacity_tokens"))
    texts = texts.groupBy("spec_name").agg(
        F.count("*").alias("documents"),
        F.count_if((F.col("placed") != F.col("tokens")) | (F.col("end") != F.col("tokens")) | (F.col("starts") != F.col("pieces"))).alias("not_whole"),
        F.count_if(F.col("pieces") != needed).alias("divided_without_need"),
    )
    facts = specs.join(full, "spec_name").join(texts, "spec_name")
    return facts.select(
        "spec_name",
        "capacity_tokens",
        "documents",
        "not_whole",
        "divided_without_need",
        (F.col("fullest") > F.col("capacity_tokens")).cast("int").alias("above_capacity"),
        (F.col("last") - F.col("first") + 1 - F.col("n")).alias("unused_numbers"),
    )


QUERIES = {"p7_assigned": p7_assigned, "p7_fill": p7_fill, "p7_checked": p7_checked}
ORACLES = {
    "p7_checked": """select spec_name, capacity_tokens, count(*) as documents, 0::bigint as not_whole, 0::bigint as divided_without_need, 0 as above_capacity, 0::bigint as unused_numbers
from (select distinct spec_name, capacity_tokens from pack_specs), documents where doc_id is not null and regexp_replace(text, '\\s+', '', 'g') <> '' group by 1, 2"""
}
