"""Queries of problem 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.keys import clean_key
from quern.llm.toxicity import THRESHOLD, score_documents
from quern.sources.tables import table


def p9_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "text")
    labels = table(spark, sf, "review_labels").select(F.col("doc_id").alias("doc"), F.col("abusive").alias("label"))
    return score_documents(docs, labels).withColumnRenamed("doc", "doc_id")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p9_scores(spark, sf).where(F.col("abusive") >= THRESHOLD).select("doc_id")


def p9_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, flagged documents and their rate per source."""
    sources = table(spark, sf, "documents").select("doc_id", clean_key("source").alias("source"))
    out = sources.join(p9_scores(spark, sf), "doc_id").groupBy("source")
    return out.agg(F.count("*").alias("n_documents"), F.count_if(F.col("abusive") >= THRESHOLD).alias("n_flagged"), F.avg((F.col("abusive") >= THRESHOLD).cast("int")).alias("rate"))


QUERIES = {"p9_found": p9_found, "p9_scores": p9_scores, "p9_rates": p9_rates}
ORACLES: dict[str, str] = {}
