"""The release gate: verified rows, issues per row, novelty of what is left, a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import clean_key, first_filled
from quern.operators import contamination as D
from quern.operators.gate import exploded, gate_counts, issues, secrets
from quern.operators.novelty import novelty, novelty_report
from quern.plans.stage import Stage
from quern.sources.sinks import first_rows, write_bundle

#: Blocked rows that the report lists.
LISTED = 50


def row_issues(rows: DataFrame, keys: DataFrame, structures: bool = True) -> DataFrame:
    """Fingerprinted rows with ``issues``: origin, reserved split, evaluation item, not passed, code of an item, secrets in any text column."""
    checked = D.task_hits(rows, keys)
    code = []
    if structures:
        checked = D.code_hits(checked, keys)
        code = [(F.col("code_hit"), "code of an evaluation item, or none")]
    own = D.task_issues(first_filled(F.col("origin"), F.col("source")), clean_key("split"), D.RESERVED_SPLITS)
    rest = issues((~F.coalesce(F.col("passed"), F.lit(False)), "not passed"), *code)
    texts = [c for c, t in rows.dtypes if t == "string" and c not in ("prompt_hash", "task_hash", "reference_structure", "answer_structure")]
    return checked.withColumn("issues", F.concat(own, rest, secrets(F.concat_ws("\n", *texts)))).drop("prompt_hit", "task_hit", "code_hit")


def release(rows: DataFrame, keys: DataFrame, order: str, registry: DataFrame | None = None, folder: str | None = None, version: str = "v1", problems: DataFrame | None = None, strict: bool = False) -> dict[str, DataFrame]:
    """The tables ``issues``, ``novelty`` and ``manifest`` of fingerprinted rows.

    ``problems`` are the issues of the bundle's verification: any is an error at once.  Novelty is
    judged on rows without issues, in order, against the registry's fingerprints; duplicates block
    nothing.  The manifest counts all rows.  With a folder the reports are written (the first
    LISTED blocked rows in order) before an error is raised for blocked rows if ``strict``.
    """
    if problems is not None and not problems.isEmpty():
        raise ValueError(f"the bundle is not verified: {problems.first().issue}")
    checked = Stage(rows.sparkSession, "release").write(row_issues(rows, keys))
    clean = D.novelty_keys(checked.where(F.size("issues") == 0))
    known = D.novelty_keys(registry) if registry is not None else None
    report = novelty_report(novelty(clean, D.EXACT_KEYS, D.NEAR_KEYS, order, known))
    manifest = gate_counts(checked, F.col("issues"), "tier").withColumn("dataset_version", F.lit(version))
    blocked = checked.where(F.size("issues") > 0).select(order, "task_id", "issues")
    if folder:
        facts = manifest.first().asDict() | {"novelty": report.first().asDict()}
        write_bundle({"novelty_report": report, "blocked": first_rows(blocked, order, LISTED)}, folder, facts)
    if strict and not blocked.isEmpty():
        raise ValueError(f"{blocked.count()} rows are blocked")
    return {"issues": exploded(checked, order, F.col("issues")), "novelty": report, "manifest": manifest}
