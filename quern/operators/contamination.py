"""Training rows against held-out evaluation items: prompt, task metadata and code structure.

Keys of the items are one table ``kind, key`` of distinct hashes (prompt text, task
metadata, structure of reference or broken code), and rows meet it by equality, so a
frequent key is one row in every join.  Null and blank texts give no key and match
nothing; an answer without code counts as contaminated, as it can teach nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.code import structure
from quern.functions.keys import first_filled, is_blank
from quern.functions.text import code_blocks, text_fingerprint
from quern.operators.gate import issues
from quern.operators.novelty import architecture, scoped
from quern.plans.stage import Stage

#: Origins and splits that never enter training; fixed values.
FORBIDDEN_ORIGINS = ("tritonbench", "kernelbench_eval", "private_eval", "yaml")
FORBIDDEN_SPLITS = ("test", "eval")
RESERVED_SPLITS = (*FORBIDDEN_SPLITS, "held_out")
#: Metadata that says what a task asks for.
TASK_FIELDS = ("target_api", "torch_reference", "dtype", "shape_class", "layout")


def _column(rows: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in rows.columns else F.lit(None).cast("string")


def task_hash(rows: DataFrame) -> Column:
    """Hash over a task's family (else category), its fields and its architecture; columns that are missing count as null.

    Every part is written with its length, so no value can pose as two, or as null.
    """
    family = first_filled(_column(rows, "task_family"), _column(rows, "category"))
    arch = architecture(_column(rows, "gpu_architecture"))
    parts = [family, *[_column(rows, c) for c in TASK_FIELDS], arch]
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("~")) for p in parts]), 256)


def prompt_hash(c: Column) -> Column:
    return F.when(~is_blank(c), text_fingerprint(c))


def code_structure(c: Column) -> Column:
    """Structure of code, null for null or blank."""
    return structure(F.when(~is_blank(c), c))


def row_fingerprints(rows: DataFrame) -> DataFrame:
    """Rows with ``architecture, prompt_hash, task_hash, reference_structure, answer_structure``.

    The prompt is that of the task (``task_prompt``) where there is one, since ``prompt`` may be a
    wrapper around it; the reference is ``ground_truth_code``, else ``broken_code``; the
    answer's code is taken from ``response``.
    """
    prompt = first_filled(_column(rows, "task_prompt"), _column(rows, "prompt"))
    reference = first_filled(_column(rows, "ground_truth_code"), _column(rows, "broken_code"))
    return rows.withColumns(
        {
            "architecture": architecture(_column(rows, "gpu_architecture")),
            "prompt_hash": prompt_hash(prompt),
            "task_hash": task_hash(rows),
            "reference_structure": code_structure(reference),
            "answer_structure": code_structure(code_blocks(_column(rows, "response"))),
        }
    )


def novelty_keys(fingerprints: DataFrame) -> DataFrame:
    """Exact keys (prompt and answer within an architecture) and near keys (task and reference) for ``novelty.novelty``."""
    return fingerprints.withColumns({"prompt_key": scoped(F.col("architecture"), F.col("prompt_hash")), "answer_key": scoped(F.col("architecture"), F.col("answer_structure"))})


EXACT_KEYS, NEAR_KEYS = ["prompt_key", "answer_key"], ["task_hash", "reference_structure"]


def item_keys(items: DataFrame, sources: DataFrame | None = None, required: bool = True) -> DataFrame:
    """Distinct ``kind, key`` of evaluation items and of source files (``code``); an error if no prompt is among them and one is required."""
    kinds = [("prompt", prompt_hash(_column(items, "prompt"))), ("task", task_hash(items))]
    kinds += [("structure", code_structure(F.col(c))) for c in ("ground_truth_code", "broken_code") if c in items.columns]
    keys = items.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("key")) for k, c in kinds])).alias("k")).select("k.kind", "k.key")
    if sources is not None:
        keys = keys.unionByName(sources.select(F.lit("structure").alias("kind"), code_structure(F.col("code")).alias("key")))
    keys = Stage(items.sparkSession, "keys").write(keys.where("key is not null").distinct())  # read by several joins
    if required and keys.where("kind = 'prompt'").isEmpty():
        raise ValueError("decontamination needs evaluation items with prompts")
    return keys


def key_counts(keys: DataFrame) -> DataFrame:
    """Number of distinct keys of each kind."""
    return keys.groupBy("kind").agg(F.count("*").alias("n_keys"))


def _hit(rows: DataFrame, column: str, keys: DataFrame, kind: str, name: str) -> DataFrame:
    own = keys.where(F.col("kind") == kind).select(F.col("key").alias(column), F.lit(True).alias(name))
    return rows.join(own, column, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def task_hits(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows (with prompt_hash, task_hash) with the flags ``prompt_hit`` and ``task_hit``."""
    return _hit(_hit(rows, "prompt_hash", keys, "prompt", "prompt_hit"), "task_hash", keys, "task", "task_hit")


def code_hits(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows (with answer_structure) with the flag ``code_hit``; true without code."""
    out = _hit(rows, "answer_structure", keys, "structure", "code_hit")
    return out.withColumn("code_hit", F.col("code_hit") | F.col("answer_structure").isNull())


def task_issues(origin: Column, split: Column, reserved: tuple[str, ...] = FORBIDDEN_SPLITS) -> Column:
    """Why a task may not be trained on: origin, split, prompt or metadata of an evaluation item."""
    return issues(
        (origin.isin(*FORBIDDEN_ORIGINS), "forbidden origin"),
        (split.isin(*reserved), "reserved split"),
        (F.col("prompt_hit"), "prompt of an evaluation item"),
        (F.col("task_hit"), "task of an evaluation item"),
    )


def trainable(origin: Column, split: Column, prompt: Column | None = None) -> Column:
    """Whether a task may enter training, and, given its prompt, whether it may be evolved."""
    ok = ~F.coalesce(origin.isin(*FORBIDDEN_ORIGINS), F.lit(False)) & ~F.coalesce(split.isin(*FORBIDDEN_SPLITS), F.lit(False))
    return ok if prompt is None else ok & F.coalesce(prompt != "", F.lit(False))


def require_trainable(rows: DataFrame, key: str, origin: Column, split: Column) -> DataFrame:
    """The rows; an error that names one if any may not be trained on."""
    bad = rows.where(~trainable(origin, split)).select(key).limit(1).collect()
    if bad:
        raise ValueError(f"{key} {bad[0][0]!r} may not enter training")
    return rows


def decontaminated(rows: DataFrame, keys: DataFrame, origin: Column, split: Column) -> DataFrame:
    """Fingerprinted rows that no key and no rule rejects."""
    checked = code_hits(task_hits(rows, keys), keys)
    kept = checked.where((F.size(task_issues(origin, split)) == 0) & ~F.col("code_hit"))
    return kept.drop("prompt_hit", "task_hit", "code_hit")


def prompt_keys(rows: DataFrame) -> DataFrame:
    """Prompt rows with their exact key (text within an architecture) and near key (task)."""
    return rows.withColumns({"exact_key": scoped(architecture(), prompt_hash(F.col("prompt"))), "near_key": task_hash(rows)})
