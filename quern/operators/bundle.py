"""Bundles of answers: requests in canonical form, replay of their hashes, sealing and whole-bundle checks.

A bundle is a table of rows and a manifest of facts.  Checks are tables ``check, row,
issue`` that are united; a bundle is verified if there is none.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.canonical import canonical_hash, canonical_json, joined_hash
from quern.functions.keys import is_blank
from quern.operators.merkle import dense_positions, merkle_root
from quern.plans.files import list_files
from quern.plans.stage import Stage

_ISSUE = "check string, row long, issue string"
#: Files of a bundle that is released.
ARTEFACTS = ("manifest.json", "prompts", "rows", "raw_rows", "validation")
#: Version of the sampling rule that goes into seeds; fixed value.
SAMPLING_VERSION = "stratified-v1"


def sampling_seed(catalogue: Column, run: Column, version: str = SAMPLING_VERSION) -> Column:
    """Seed of a sample from the hash of the catalogue, the run's seed and the rule's version (hex)."""
    return joined_hash(F.lit("sampling"), catalogue, run, F.lit(version))


def evolution_seed(run: Column, parent: Column, depth: Column, version: str = SAMPLING_VERSION) -> Column:
    """Seed of the tasks that evolve from a parent at a depth (hex)."""
    return joined_hash(F.lit("evolution"), run, parent, depth, F.lit(version))


def request_body(model: Column, prompt: Column, system: Column, max_tokens: int, temperature: float, effort: str, nested: bool = True) -> Column:
    """Canonical JSON of a chat request; a blank system prompt has no message; the effort stands in ``reasoning`` or beside the rest."""
    turn = lambda role, text: F.to_json(F.struct(F.lit(role).alias("role"), text.alias("content")))
    messages = F.concat_ws(",", F.when(~is_blank(system), turn("system", system)), turn("user", F.coalesce(prompt, F.lit(""))))
    fixed = json.dumps({"max_tokens": max_tokens, "temperature": temperature} | ({"reasoning": {"effort": effort}} if nested else {"reasoning_effort": effort}))[1:-1]
    named = F.to_json(F.struct(model.alias("model")))  # without a model: {}
    named = F.nullif(F.substring(named, F.lit(2), F.length(named) - 2), F.lit(""))
    return canonical_json(F.concat(F.lit("{"), F.concat_ws(",", named, F.lit(fixed), F.concat(F.lit('"messages":['), messages, F.lit("]"))), F.lit("}")))


def request_hash(body: Column) -> Column:
    return F.sha2(body, 256)


def rebound(rows: DataFrame, prompt: Column, body: Column, keep: str | None = "prior_request_sha256") -> DataFrame:
    """Rows with the prompt of their task and the request hash that belongs to it; the old hash stays in ``keep``.

    ``body`` is the request over the column ``prompt`` as it is then.
    """
    out = rows.withColumn(keep, F.col("request_sha256")) if keep else rows
    out = out.withColumn("prompt", prompt)
    return out.withColumn("request_sha256", request_hash(body))


def leaf_hash(rows: DataFrame, columns: list[str]) -> Column:
    """Content hash of a row over the canonical JSON of the columns, nulls included."""
    return canonical_hash(F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}))


def sealed(rows: DataFrame, order: str, columns: list[str]) -> dict[str, object]:
    """Facts of the rows in order: their number and the root of their leaves."""
    leaves = dense_positions(rows.select(order, leaf_hash(rows, columns).alias("hash")), order, ["hash"])
    return {"sample_count": leaves.count(), "merkle_root": merkle_root(leaves)}


def proved(rows: DataFrame, order: str, columns: list[str], passed: Column, least: float = 0.0) -> tuple[DataFrame, dict[str, object]]:
    """The passing rows and their sealed facts; an error below the least pass rate, or if none passes."""
    facts = rows.agg(F.count("*").alias("n"), F.count_if(F.coalesce(passed, F.lit(False))).alias("p")).first()
    rate = facts.p / facts.n if facts.n else 0.0
    if not facts.p or rate < least:
        raise ValueError(f"{facts.p} of {facts.n} rows pass, at least {least:.0%} must")
    kept = Stage(rows.sparkSession, "proved").write(rows.where(F.coalesce(passed, F.lit(False))))
    return kept, sealed(kept, order, columns) | {"raw_sample_count": facts.n, "pass_rate": rate}


def row_checks(rows: DataFrame, order: str, **checks: Column) -> DataFrame:
    """``check, row, issue`` of the rows for which a check's condition is not true (null counts as not true)."""
    bad = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(name).alias("check"), F.lit(f"{name} fails").alias("issue"))) for name, ok in checks.items()]))
    return rows.select(F.col(order).cast("long").alias("row"), F.explode(bad).alias("b")).select("b.check", "row", "b.issue")


def fact_checks(spark: SparkSession, facts: dict[str, object], manifest: dict[str, object]) -> DataFrame:
    """``check, row, issue`` of the facts that the manifest states otherwise."""
    wrong = [(k, None, f"{k}: manifest {manifest.get(k)!r}, rows {v!r}") for k, v in facts.items() if manifest.get(k) != v]
    return spark.createDataFrame(wrong, _ISSUE)


def missing_artefacts(spark: SparkSession, folder: str, wanted: tuple[str, ...] = ARTEFACTS) -> DataFrame:
    """``check, row, issue`` of the files that a bundle lacks."""
    there = set(list_files(spark, folder))
    return spark.createDataFrame([("artefact", None, f"missing {w}") for w in wanted if w not in there], _ISSUE)


def inconsistent(raw: DataFrame, rows: DataFrame, columns: list[str], order: str) -> DataFrame:
    """``check, row, issue`` of the rows that no raw row equals in the columns (nulls equal)."""
    key = F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}), 256)
    lost = rows.select(F.col(order).cast("long").alias("row"), key.alias("_k")).join(raw.select(key.alias("_k")).distinct(), "_k", "left_anti")
    return lost.select(F.lit("raw").alias("check"), "row", F.lit("stands in no raw row").alias("issue"))


def verified(*checks: DataFrame) -> tuple[DataFrame, bool]:
    """All issues, and whether there is none."""
    found = reduce(DataFrame.unionByName, checks)
    return found, found.isEmpty()
