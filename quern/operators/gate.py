"""Row checks: schema, secrets, and the release gate with reasons per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import is_blank

#: Patterns of content that must not be released, by label; fixed values.
SECRETS = {
    "api key": r"\bsk-[A-Za-z0-9_\-]{16,}",
    "home path": r"/home/\w+",
    "key variable": r"\b[A-Z]+_API_KEY\b",
}
#: Wider patterns for general corpora.
SECRETS_WIDE = SECRETS | {"assignment": r"(?i)(key|token|secret|password)\s*[=:]", "e-mail": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"}


def issues(*checks: tuple[Column, str]) -> Column:
    """Array of the labels whose condition holds (null counts as false), in order."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(label)) for cond, label in checks]))


def secrets(c: Column, patterns: dict[str, str] = SECRETS) -> Column:
    """Labels of the patterns found in a text."""
    return issues(*[(c.rlike(p), label) for label, p in patterns.items()])


def schema_issues(required: list[str], split: Column, splits: tuple[str, ...], origin: Column, forbidden: tuple[str, ...]) -> Column:
    """Violations of a record: blank required fields, split or origin outside the rules."""
    checks = [(is_blank(F.col(c)), f"{c} is blank") for c in required]
    return issues(*checks, (~F.coalesce(split.isin(*splits), F.lit(False)), "split"), (origin.isin(*forbidden), "origin"))


def exploded(rows: DataFrame, key: str, column: Column) -> DataFrame:
    """One row per key and issue."""
    return rows.select(key, F.explode(column).alias("issue"))


def gate_counts(rows: DataFrame, issue: str, tier: str) -> DataFrame:
    """Release facts in one row: rows, blocked rows, tiers of all rows (anything but silver and repair is gold), whether all passed."""
    blocked = F.size(issue) > 0
    return rows.agg(
        F.count("*").alias("rows_total"),
        F.count_if(blocked).alias("blocked_rows"),
        F.count_if(F.coalesce(~F.col(tier).isin("silver", "repair"), F.lit(True))).alias("gold_rows"),
        F.count_if(F.col(tier) == "silver").alias("silver_rows"),
        F.count_if(F.col(tier) == "repair").alias("repair_rows"),
        (F.count_if(blocked) == 0).alias("passed"),
    )
