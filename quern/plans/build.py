"""A prompt file from its sources: catalogue, hash, seed, sample, split, write, facts."""

from __future__ import annotations

import json
import secrets

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators import bundle, derive, sampling, summary
from quern.operators.lineage_split import assign_by_lineage, components, identity
from quern.plans.stage import Stage
from quern.sources.sinks import write_bundle, write_unique_jsonl

#: Order of the parts of a catalogue; fixed values.
PARTS = ("doc", "mutation", "torch_op", "mined", "evolved")


def run_seed() -> str:
    """256 random bits (hex); to be kept, since a run is repeated by it."""
    return secrets.token_hex(32)


def build_prompts(parts: dict[str, DataFrame], path: str, seed: str, limit: int | None = None, dev_fraction: float = 0.1) -> dict[str, object]:
    """Unite the parts in the order of PARTS, sample, split by lineage, and write ``prompts`` and their facts under ``path``.

    Parts have ``task_id`` (unique over all) and ``prompt``; what they lack of the other columns is null.  A limit
    of at least the number of rows keeps all of them.  Records of one family, reference, parent or
    interface are in one split; groups with a reserved split keep it.  Returns the facts.
    """
    unknown = set(parts) - set(PARTS)
    if unknown:
        raise ValueError(f"unknown parts {sorted(unknown)}")
    rows = derive.catalogue(*[(p, parts[p]) for p in PARTS if p in parts])
    spark = rows.sparkSession
    for c in ("source", "origin", "task_family", "category", "target_api", "torch_reference", "ground_truth_code", "parent_id", "split"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    stage = Stage(spark, "build")
    rows = stage.write(rows)
    digest = sampling.catalogue_hash(rows, "task_id", "prompt").first()
    chosen = rows
    salt = spark.range(1).select(bundle.sampling_seed(F.lit(digest.catalogue_hash), F.lit(seed)).alias("s")).first().s
    if limit is not None and limit < digest.n_rows:
        named = rows.withColumns({"_source": sampling.bucket(F.col("origin"), F.col("source")), "_family": sampling.bucket(F.col("task_family"), F.col("category"), F.col("target_api"))})
        chosen = stage.write(sampling.stratified_sample(named, "_source", "_family", "task_id", limit, salt)).drop("_source", "_family")
    split = lineage_splits(chosen, dev_fraction)
    done = stage.write(chosen.drop("split").join(split.drop("conflict"), "task_id"))
    facts = {"catalogue_sha256": digest.catalogue_hash, "catalogue_rows": digest.n_rows, "run_seed": seed, "sampling_seed": salt, "sampling_version": bundle.SAMPLING_VERSION, "rows": done.count()}
    facts |= {"by_split": {r.split: r.n for r in summary.counts(done, F.col("split")).collect()}, "by_part": {r.part: r.n for r in summary.counts(done, F.col("part")).collect()}}  # a few rows
    write_unique_jsonl(done.drop("part", "part_order"), f"{path}/prompts", "task_id", "task_id")
    write_bundle({"report": summary.counts(done, F.col("source"), F.col("category"))}, path, json.loads(json.dumps(facts)))
    return facts


def lineage_identity(rows: DataFrame):
    """The strongest identity of a record: family, reference code, reference expression, parent, interface, template, own id."""
    has = lambda c: F.nullif(F.col(c), F.lit("")) if c in rows.columns else F.lit(None).cast("string")
    hashed = lambda c: F.sha2(has(c), 256)
    return identity(
        has("task_family"),
        ("reference", hashed("ground_truth_code")),
        ("torch_reference", hashed("torch_reference")),
        ("ancestry", has("parent_id")),
        ("api", has("target_api")),
        ("template", has("prompt_template")),
        ("task", F.col("task_id")),
    )


def lineage_splits(rows: DataFrame, dev_fraction: float = 0.1, reserved: tuple[str, ...] = ("eval", "held_out"), strict: bool = False) -> DataFrame:
    """``task_id, split_group, split, conflict`` of records tied by identity or parent; an error for groups of several reserved splits if ``strict``."""
    own, up = F.concat(F.lit("task id:"), "task_id"), F.concat(F.lit("task id:"), F.nullif(F.col("parent_id"), F.lit("")))
    links = rows.select(F.col("task_id").alias("row"), F.explode(F.array_compact(F.array(lineage_identity(rows), own, up))).alias("key"))
    groups = components(links).withColumnRenamed("row", "task_id")
    held = rows.select("task_id", F.when(F.col("split").isin(*reserved), F.col("split")).alias("reserved"))
    out = assign_by_lineage(held.join(groups, "task_id"), "task_id", "component", "reserved", dev_fraction)
    if strict:
        bad = out.where("conflict").limit(1).collect()
        if bad:
            raise ValueError(f"the group of {bad[0].task_id!r} has several reserved splits")
    return out


def ordered_splits(splits: DataFrame) -> DataFrame:
    """Split rows in the order of the smallest task id of their group, then of their own."""
    first = splits.groupBy("split_group").agg(F.min("task_id").alias("first_task_id"))
    return splits.join(first, "split_group").orderBy("first_task_id", "task_id")
