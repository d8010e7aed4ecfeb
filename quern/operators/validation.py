"""Results of validation as columns: stages in order, scores, feedback, teachers and devices.

What ran outside (compiler, device, teacher) comes in as columns; here it is only
read.  Missing parts count as not there and never fail a query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.code import UNPARSED, api_issues, cheats
from quern.functions.keys import first_filled
from quern.functions.text import code_blocks, tail

#: Least composite score of a benchmarked answer, and characters of output that feedback quotes; fixed values.
BENCHMARK_FLOOR = 0.25
QUOTED = 1500
#: Stages whose output explains a failure, in the order in which they are asked; fixed values.
OUTPUT_STAGES = ("compile_execute", "syntax", "triton_api", "anti_cheat")


def first_failure(*stages: tuple[str, Column]) -> Column:
    """Reason of the first stage that did not pass; a null stage was not run and is passed over."""
    reasons = [F.when(~ok, F.lit(reason)) for reason, ok in stages]
    return F.coalesce(*reasons) if reasons else F.lit(None).cast("string")


def cascade(rows: DataFrame, response: str, executed: Column, strict: bool = True, adversarial: Column | None = None, composite: Column | None = None) -> DataFrame:
    """Rows with ``code``, ``fail_reason`` (null: passed) and ``passed``.

    Stages, in order: syntax, modern API, (strict) no cheat, execution, (strict) adversarial execution,
    benchmark floor.  The program is analysed once for all static stages.
    """
    code = code_blocks(F.col(response))
    out = rows.withColumn("code", code).withColumn("_cheats", cheats(F.col("code")))
    deprecated = F.size(api_issues(F.col("code")))
    parses = ~F.coalesce(F.array_contains("_cheats", UNPARSED), F.lit(True))
    stages = [("syntax_error", parses), ("triton_api", deprecated == 0)]
    if strict:
        stages.append(("anti_cheat_failed", F.size("_cheats") == 0))
    stages.append(("compile_execute_failed", F.coalesce(executed, F.lit(False))))
    if strict and adversarial is not None:
        stages.append(("adversarial_failed", adversarial))
    if composite is not None:
        stages.append(("benchmark_below_floor", composite >= BENCHMARK_FLOOR))
    reason = first_failure(*stages)
    return out.withColumns({"fail_reason": reason, "passed": reason.isNull()}).drop("_cheats")


def any_stage(rows: DataFrame, stages: str, name: str) -> bool:
    """Whether any row has a result of the stage (``stages`` is a map or a struct)."""
    is_map = rows.schema[stages].dataType.typeName() == "map"
    if not is_map and name not in rows.schema[stages].dataType.names:
        return False
    at = F.try_element_at(F.col(stages), F.lit(name)) if is_map else F.col(f"{stages}.{name}")
    return bool(rows.agg(F.bool_or(at.isNotNull())).first()[0])


def number(c: Column, default: float = 0.0) -> Column:
    """A number that may be missing or no number at all."""
    return F.coalesce(c.cast("string").try_cast("double"), F.lit(default))


def benchmark_score(passed: Column, composite: Column | None = None) -> Column:
    """The composite score of a benchmark; without one 1 if passed, else 0."""
    plain = F.when(F.coalesce(passed, F.lit(False)), 1.0).otherwise(0.0)
    return plain if composite is None else F.coalesce(composite.cast("string").try_cast("double"), plain)


def output_tail(outputs: Column, stages: tuple[str, ...] = OUTPUT_STAGES, length: int = QUOTED) -> Column:
    """End of the first filled output; ``outputs`` maps stages to their output."""
    return tail(F.coalesce(first_filled(*[F.try_element_at(outputs, F.lit(s)) for s in stages]), F.lit("")), length)


def feedback(reason: Column, output: Column) -> Column:
    """What a user turn says after a failed attempt: the reason, and the end of the output if there is any."""
    reason = F.coalesce(F.nullif(reason, F.lit("")), F.lit("unknown"))
    head = F.concat(F.lit("Validation failed: "), reason, F.lit(".\nFind the cause and return the complete corrected program with its test."))
    return F.when(output != "", F.concat(head, F.lit("\n\nEnd of the output:\n"), output)).otherwise(head)


def optimise_request(task: Column, code: Column, speedup: Column, composite: Column) -> Column:
    """What a user turn says after a correct attempt to get a faster one."""
    measured = F.concat_ws(", ", F.concat(F.lit("speedup "), speedup.cast("string")), F.concat(F.lit("composite score "), composite.cast("string")))
    measured = F.coalesce(F.nullif(measured, F.lit("")), F.lit("correct, no measure of speed"))
    return F.concat(F.lit("The program below passed. Measured: "), measured, F.lit(".\nReturn a faster one that is still correct.\n\nTask:\n"), task, F.lit("\n\nProgram:\n```python\n"), code, F.lit("\n```\n"))


def repair_request(response: Column, reason: Column, outputs: Column) -> Column:
    """Prompt that asks for the repair of a failed answer; quotes its program and the output of the first three stages."""
    reason = F.coalesce(reason, F.lit("unknown"))
    return F.concat(F.lit("The program below failed: "), reason, F.lit(".\nEnd of the output:\n"), output_tail(outputs, OUTPUT_STAGES[:3]), F.lit("\n\nReturn the complete corrected program.\n\n```python\n"), code_blocks(response), F.lit("\n```"))


def with_captured_error(prompt: Column, category: Column, broken: Column, passed: Column, output: Column) -> Column:
    """Debugging prompts with the end of what their broken program printed; others, and those whose program passed, as they are."""
    quoted = F.concat(prompt, F.lit("\n\nObserved output:\n```text\n"), tail(output, QUOTED), F.lit("\n```"))
    wanted = (category == "debugging") & (F.coalesce(broken, F.lit("")) != "") & ~F.coalesce(passed, F.lit(True)) & output.isNotNull()
    return F.when(wanted, quoted).otherwise(prompt)


def episode(task: Column, system: Column, provider: Column, turns: Column, accepted: Column, repairs: Column, optimised: Column, improved: Column, speedup: Column) -> Column:
    """Struct of an episode with the number of its assistant turns."""
    attempts = F.coalesce(F.size(F.filter(turns, lambda t: t.role == "assistant")), F.lit(0))
    parts = {"task_prompt": task, "system": system, "provider": provider, "turns": turns, "accepted": accepted, "repairs_used": repairs, "optimize_used": optimised, "optimize_improved": improved, "final_speedup": speedup, "attempt_count": attempts}
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def stamped(rows: DataFrame, column: str = "episode") -> DataFrame:
    """Rows with their episode: the prompt becomes that of the task, ``multi_turn`` is set, and an improved answer is of the tier optimized."""
    improved = F.coalesce(F.col(f"{column}.optimize_improved"), F.lit(False))
    old = F.col("tier") if "tier" in rows.columns else F.lit(None).cast("string")
    return rows.withColumns({"prompt": F.col(f"{column}.task_prompt"), "multi_turn": F.lit(True), "tier": F.when(improved, "optimized").otherwise(old)})


def trusted_ms(ms: Column, method: Column, trusted: tuple[str, ...] = ("monitored_triton_do_bench",)) -> Column:
    """A time that a trusted method measured, else null."""
    return F.when(method.isin(*trusted), ms.cast("string").try_cast("double"))


def flattened(rows: DataFrame, nested: str = "results") -> DataFrame:
    """Rows of one candidate each: those without ``nested`` (an array of structs) as they are, and the elements of the others."""
    plain = rows.where(F.col(nested).isNull()).drop(nested)
    inner = rows.where(F.col(nested).isNotNull()).select(F.explode(nested).alias("r")).where("r is not null").select("r.*")
    return plain.unionByName(inner, allowMissingColumns=True)


def pinned(actual: Column, slug: Column | str) -> Column:
    """Whether a model name is the pinned one or a dated build of it."""
    slug = F.lit(slug) if isinstance(slug, str) else slug
    return (actual == slug) | actual.startswith(F.concat(slug, F.lit("-")))


def logical_model(actual: Column, slugs: list[str]) -> Column:
    """The first of the pinned names that a model name is a build of, else the name itself (the part after the last ``/``)."""
    name = F.element_at(F.split(actual, "/"), -1)
    return F.coalesce(*[F.when(pinned(name, s), F.lit(s)) for s in slugs], name)


def allowed_models(rows: DataFrame, allowed: DataFrame, provider: str = "provider", model: str = "model") -> DataFrame:
    """Rows with ``allowed``: their provider and model stand in the (small) table of allowed pairs, after dated builds are stripped."""
    pairs = allowed.select(F.col(provider).alias("_p"), F.col(model).alias("_m")).distinct()
    hit = rows.select(provider, model).distinct().join(pairs, (F.col(provider) == F.col("_p")) & pinned(F.col(model), F.col("_m")), "left_semi")
    return rows.join(hit.withColumn("_hit", F.lit(True)), [provider, model], "left").withColumn("allowed", F.coalesce("_hit", F.lit(False))).drop("_hit")


#: Devices: the least memory in GB of the larger of two devices of one generation; fixed value.
LARGE_MEMORY = 120.0
ARCHITECTURES = ("blackwell", "hopper_h200", "hopper_h100")


def device_architecture(name: Column, major: Column, memory_gb: Column, newest: tuple[int, ...] = (10, 12)) -> Column:
    """Architecture of a device by its generation, memory and name; null if it is none of them."""
    large = (memory_gb >= LARGE_MEMORY) | F.lower(name).contains("h200")
    return F.when(major.isin(*newest), ARCHITECTURES[0]).when((major == 9) & F.coalesce(large, F.lit(False)), ARCHITECTURES[1]).when(major == 9, ARCHITECTURES[2])


def looked_up(architecture: Column, table: dict, default: object) -> Column:
    """A fact of an architecture from a small table (a label, a capability), or the default."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), architecture), F.lit(default))


#: Kinds of chunks that a source draws on, and how many of each a whole corpus has at least; fixed values.
KINDS = {"api_doc": "api_symbol", "doc_semantics": "semantics", "doc_tutorial": "tutorial"}
LEAST_CHUNKS = {"api_symbol": 50, "semantics": 1, "tutorial": 1}


def kinds_of(sources: list[str]) -> list[str]:
    """Chunk kinds of the wanted sources, for a filter that reaches the scan."""
    return sorted({KINDS[s] for s in sources if s in KINDS})


def missing_kinds(chunks: DataFrame, kind: str, least: dict[str, int] = LEAST_CHUNKS) -> DataFrame:
    """``kind, n, least`` of the kinds of which there are too few."""
    wanted = chunks.sparkSession.createDataFrame(list(least.items()), "kind string, least long")
    n = chunks.groupBy(F.col(kind).alias("kind")).agg(F.count("*").alias("n"))
    return wanted.join(n, "kind", "left").na.fill(0, ["n"]).where("n < least").select("kind", "n", "least")


def require_kinds(chunks: DataFrame, kind: str, least: dict[str, int] = LEAST_CHUNKS) -> DataFrame:
    """The chunks; an error if there are too few of a kind."""
    short = missing_kinds(chunks, kind, least).orderBy("kind").collect()  # at most one row a kind
    if short:
        raise ValueError("incomplete corpus: " + ", ".join(f"{r.kind}={r.n} (at least {r.least})" for r in short))
    return chunks
