"""Pass rates and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pass_rates(rows: DataFrame, by: list[str], passed: Column) -> DataFrame:
    """Rows, passes and rate of the whole and of each value of each column, by one grouping-sets shuffle.

    Missing values are named ``unknown``; ``dimension`` is ``all`` or the column.
    """
    named = rows.select(*[F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("unknown")).alias(c) for c in by], F.coalesce(passed, F.lit(False)).alias("_p"))
    sets = [[F.col(c)] for c in by] + [[]]
    out = named.groupingSets(sets, *[F.col(c) for c in by]).agg(F.count("*").alias("n_run"), F.count_if("_p").alias("n_passed"), *[F.grouping(c).alias(f"_g_{c}") for c in by])
    dimension, value = F.lit("all"), F.lit("all")
    for c in reversed(by):
        dimension = F.when(F.col(f"_g_{c}") == 0, c).otherwise(dimension)
        value = F.when(F.col(f"_g_{c}") == 0, F.col(c)).otherwise(value)
    rate = F.when(F.col("n_run") > 0, F.col("n_passed") / F.col("n_run")).otherwise(0.0)
    return out.select(dimension.alias("dimension"), value.alias("value"), "n_run", "n_passed", rate.alias("rate"))


def counts(rows: DataFrame, *by: Column) -> DataFrame:
    """Row counts of each combination."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def category_report(rows: DataFrame, category: Column, key: Column, correct: Column, ran: Column) -> DataFrame:
    """Count, mean correctness and mean run rate per category; without one, the part of the key before the first ``_``."""
    name = F.coalesce(F.nullif(category, F.lit("")), F.split(key, "_")[0], F.lit("unknown"))
    return rows.groupBy(name.alias("category")).agg(F.count("*").alias("n"), F.avg(correct).alias("avg_correct"), F.avg(ran.cast("double")).alias("run_rate"))


def format_report(title: str, rows: list[tuple[str, str, int, int]]) -> str:
    """Plain-text report of ``pass_rates`` rows (dimension, value, run, passed)."""
    lines = [title]
    for dimension, value, run, passed in sorted(rows, key=lambda r: (r[0] != "all", r[0], r[1])):
        name = "total" if dimension == "all" else f"  {dimension} {value}"
        lines.append(f"{name}: {passed}/{run} ({passed / run if run else 0:.1%})")
    return "\n".join(lines)
