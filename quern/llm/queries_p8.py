"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.keys import clean_key
from quern.llm.mixing import BLOCK, deviations, mix
from quern.llm.tokens import token_sizes
from quern.plans.stage import Stage
from quern.sources.tables import table


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    return token_sizes(table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "source", "text"))


def _mixed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return mix(_sizes(spark, sf), table(spark, sf, "mix_targets"))


def p8_selected(spark: SparkSession, sf: str) -> DataFrame:
    return _mixed(spark, sf)[0].withColumnRenamed("doc", "doc_id")


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual share of all tokens of every source with a target."""
    return _mixed(spark, sf)[1]


def p8_deviations(spark: SparkSession, sf: str) -> DataFrame:
    """How far, in tokens, each source is ever from its weight of what is delivered."""
    return deviations(Stage(spark, "mixed").write(_mixed(spark, sf)[0]))


def p8_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Per usable source: its documents, and what would break the rules (uses above the cap, uses not whole, a share off by more than the longest document, a distance of a block)."""
    sizes = _sizes(spark, sf)
    out, report = mix(sizes, table(spark, sf, "mix_targets"))
    out = Stage(spark, "mixed").write(out)
    uses = out.groupBy("source", "doc", "copy").agg(F.sum("tokens").alias("given"), F.max(F.col("first_token") + F.col("tokens")).alias("end"), F.count("*").alias("parts"), F.count_distinct("first_token").alias("starts"))
    uses = uses.join(sizes.select("doc", "tokens"), "doc")
    broken = (F.col("given") != F.col("tokens")) | (F.col("end") != F.col("tokens")) | (F.col("parts") != F.col("starts"))
    docs = uses.groupBy("source", "doc").agg(F.count("*").alias("n"), F.count_if(broken).alias("broken"))
    docs = docs.groupBy("source").agg(F.max("n").alias("most"), F.sum("broken").alias("not_whole"))
    held = sizes.select(clean_key("source").alias("source"), "tokens").groupBy("source").agg(F.count("*").alias("documents_held"), F.max("tokens").alias("longest"))
    facts = report.join(docs, "source").join(held, "source").join(deviations(out), "source")
    whole, mixed = report.where("tokens > 0").agg(F.sum("target_share"), F.sum("tokens")).first()
    off = F.abs(F.col("tokens") - F.col("target_share") * F.lit(float(mixed or 0) / (whole or 1.0))) > F.col("longest")
    return facts.select(
        "source",
        F.col("documents_held").alias("documents"),
        (F.col("most") > F.col("max_repeats")).alias("too_often"),
        "not_whole",
        off.alias("share_off"),
        (F.col("most_tokens") >= BLOCK).alias("block_off"),
    )


QUERIES = {"p8_selected": p8_selected, "p8_shares": p8_shares, "p8_deviations": p8_deviations, "p8_checked": p8_checked}
_K = "nullif(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '')"
ORACLES = {
    "p8_checked": f"""select s as source, count(*) as documents, false as too_often, 0::bigint as not_whole, false as share_off, false as block_off
from (select {_K.format('source')} s from documents where doc_id is not null and regexp_replace(text, '\\s+', '', 'g') <> '') where s in
  (select {_K.format('source')} from mix_targets group by 1 having sum(target_share) > 0 and max(max_repeats) > 0) group by 1"""
}
