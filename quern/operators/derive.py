"""New rows from old ones: variants, evolved tasks, tasks mined from failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.canonical import joined_hash
from quern.functions.keys import first_filled


def failure_class(passed: Column, reason: Column, tail: Column) -> Column:
    """Class of a failure by its reason, and by words in the end of its output."""
    low = F.lower(F.coalesce(tail, F.lit("")))
    compile_class = F.when(low.rlike("mask|bound"), "mask").when(low.contains("stride"), "stride").when(low.rlike("dtype|float"), "dtype").otherwise("compile")
    r = F.lower(F.coalesce(reason, F.lit("")))
    return (
        F.when(F.coalesce(passed, F.lit(False)), "pass")
        .when(r.rlike("syntax|no kernel"), "parse")
        .when(r.contains("api"), "api")
        .when(r.contains("compile"), compile_class)
        .when(r.rlike("timeout|floor"), "performance")
        .otherwise("runtime")
    )


def repeated(rows: DataFrame, n: int, name: str = "variant") -> DataFrame:
    """Every row ``n`` times with ``name`` 0 .. n-1; a generator, no join."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1)))) if n > 0 else rows.withColumn(name, F.lit(0)).limit(0)


def with_values(rows: DataFrame, name: str, values: list[str]) -> DataFrame:
    """Every row once per value of a fixed list; a generator, no join."""
    return rows.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def mined_tasks(failures: DataFrame, key: str, klass: str, family: Column, templates: dict[str, str], n: int = 2) -> DataFrame:
    """``n`` new tasks per failure from the template of its class (``{op}`` is its family; the first template serves other classes)."""
    default = next(iter(templates.values()))
    table = F.create_map(*[F.lit(x) for kv in templates.items() for x in kv])
    template = F.coalesce(F.try_element_at(table, F.col(klass)), F.lit(default))
    out = repeated(failures, n)
    text = F.replace(template, F.lit("{op}"), first_filled(family, F.lit("kernel")))
    prompt = F.when(F.col("variant") == 0, text).otherwise(F.concat(text, F.lit(" Shape variant "), (F.col("variant") + 1).cast("string"), F.lit(".")))
    return out.select(F.concat_ws("_", F.lit("mined"), F.col(key), F.col(klass), F.col("variant").cast("string")).alias("task_id"), F.col(key).alias("parent"), prompt.alias("prompt"))


def evolved_tasks(parents: DataFrame, key: str, prompt: str, operations: dict[str, str], depth: int, seed: str) -> DataFrame:
    """At most ``depth`` distinct operations per parent, chosen by seeded hash, as new tasks with their lineage."""
    ops = F.array(*[F.struct(joined_hash(F.lit(seed), F.col(key), F.lit(o)).alias("h"), F.lit(o).alias("op"), F.lit(t).alias("text")) for o, t in operations.items()])
    chosen = F.slice(F.array_sort(ops), 1, depth) if depth > 0 else F.slice(ops, 1, 0)
    out = parents.select(key, prompt, F.explode(chosen).alias("o"))
    return out.select(
        F.concat_ws("_", F.lit("evolve"), F.col(key), F.col("o.op")).alias("task_id"),
        F.col(key).alias("parent_id"),
        F.col("o.op").alias("operation"),
        F.concat(F.col(prompt), F.lit("\n\nAdditional requirement: "), F.col("o.text")).alias("prompt"),
    )


def filled_from(rows: DataFrame, other: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """Rows whose missing columns are filled from the last row (by ``order``) of the same key in ``other``."""
    last = other.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(order, *columns)).alias("_l"))
    out = rows.join(last, key, "left")
    return out.withColumns({c: first_filled(F.col(c), F.col(f"_l.{c}")) for c in columns}).drop("_l")


def catalogue(*parts: tuple[str, DataFrame]) -> DataFrame:
    """Union of all parts by name, with the name and place of each part."""
    out = None
    for i, (name, df) in enumerate(parts):
        df = df.withColumns({"part": F.lit(name), "part_order": F.lit(i)})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
