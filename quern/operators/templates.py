"""Prompts from chunks, operations and records; the texts are parameters with defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import first_filled, strip
from quern.operators.contamination import require_trainable

#: Characters of context: of a plain chunk, of one with its reference page, and of an explained one; fixed values.
CONTEXT, PAGE_CONTEXT, EXPLAINED = 1500, 4000, 2500
LEAST_PAGE = 80
#: Columns of a prompt record besides prompt and system; fixed values.
RECORD = (
    "task_id", "source", "origin", "split", "category", "target_api", "ground_truth_code", "ground_truth_hint", "broken_code", "mutation_reason",
    "torch_reference", "reference_expr", "shape_class", "doc_chunk_id", "level", "title", "task_family", "prompt_template", "captured_error",
    "captured_failure_class", "parent_id", "evolution_ops", "gpu_architecture",
)
#: Shapes that no block size divides, for variants of an operation; fixed values.
SHAPES = ({"M": 127, "N": 1003, "K": 6143, "B": 3, "D": 1003, "L": 127}, {"M": 255, "N": 511, "K": 1023, "B": 5, "D": 511, "L": 255})

HEADERS = {
    "debugging": "Correct the broken kernel below without changing its algorithm; it runs on {device}.",
    "translation": "Write a fast kernel that does what the reference operation does.",
    "api_usage": "Show the correct use of the interface below on {device}.",
}
OTHER_HEADER = "Write a kernel of production quality for {device}."
SECTIONS = (
    "Design: target {device}; size the grid from the shape; mask loads and stores at borders; accumulate in full precision.",
    "Implementation: one complete program with kernel, launcher and test; no library call in the place of the kernel.",
    "Validation: test tails, several seeds and both precisions, and state the tolerances.",
)


def system_prompt(device: Column) -> Column:
    return F.concat(F.lit("You are an expert in GPU kernels for "), device, F.lit(". Write complete programs with kernel, launcher and test."))


def wrapped(body: Column, device: Column, sections: tuple[str, ...] = SECTIONS) -> Column:
    """A stripped body followed by the sections."""
    return F.concat_ws("\n\n", strip(body), *[F.replace(F.lit(s), F.lit("{device}"), device) for s in sections])


def templated(rows: DataFrame, device: Column, headers: dict[str, str] = HEADERS, other: str = OTHER_HEADER) -> DataFrame:
    """Rows whose prompt has the header of its category (without one: translation) and the sections; ``prompt_template`` names both."""
    category = F.coalesce(F.col("category"), F.lit("translation"))
    table = F.create_map(*[F.lit(x) for kv in headers.items() for x in kv])
    header = F.replace(F.coalesce(F.try_element_at(table, category), F.lit(other)), F.lit("{device}"), device)
    body = F.concat_ws("\n\n", header, strip(F.coalesce("prompt", F.lit(""))))
    return rows.withColumns({"prompt": wrapped(body, device), "prompt_template": F.concat(category, F.lit(":structured-v1"))})


def task_of_section(section: Column, prefix: str = "doc") -> Column:
    """Task id of a section: the section id if it has a known prefix, else with ``prefix``."""
    return F.when(section.rlike("^(api_|sem_|tut_|doc_)"), section).otherwise(F.concat(F.lit(f"{prefix}_"), section))


def pages_for(symbols: DataFrame, symbol: str, *pages: DataFrame, least: int = LEAST_PAGE) -> DataFrame:
    """Symbols with ``page``: the text of the first of the tables ``symbol, page`` that holds one of at least ``least`` characters."""
    out = symbols
    for i, p in enumerate(pages):
        own = p.where(F.length("page") >= least).groupBy(F.col("symbol").alias(symbol)).agg(F.min("page").alias(f"_page{i}"))
        out = out.join(own, symbol, "left")
    found = F.coalesce(*[F.col(f"_page{i}") for i in range(len(pages))]) if pages else F.lit(None).cast("string")
    return out.withColumn("page", found).drop(*[f"_page{i}" for i in range(len(pages))])


def with_pages(chunks: DataFrame) -> DataFrame:
    """Chunks of symbols (``symbol, doc_category, target_api, content, page``) whose content becomes the reference page where there is one; ``enriched`` marks them."""
    head = F.concat(
        F.lit("Category: "), F.coalesce("doc_category", F.lit("language")), F.lit("\nAPI: "), F.coalesce(F.col("target_api"), F.concat(F.lit("tl."), F.col("symbol"))),
        F.lit("\nSymbol: "), F.col("symbol"), F.lit("\n\nReference page:\n"), F.left("page", F.lit(PAGE_CONTEXT)),
    )
    has = F.col("page").isNotNull() & (F.coalesce("symbol", F.lit("")) != "")
    return chunks.withColumns({"content": F.when(has, head).otherwise(F.col("content")), "enriched": has}).drop("page")


def chunk_prompts(chunks: DataFrame, device: Column) -> DataFrame:
    """Prompt rows of chunks ``chunk_kind, section_id, title, target_api, content, enriched``: symbols ask for their use, others for an explanation and a program."""
    kind = F.coalesce("chunk_kind", F.lit("api_symbol"))
    is_api = kind == "api_symbol"
    target = F.coalesce("target_api", F.lit("tl.dot"))
    context = F.left("content", F.when(F.coalesce("enriched", F.lit(False)), PAGE_CONTEXT).otherwise(CONTEXT))
    api = F.concat(F.lit("Write a complete kernel on "), device, F.lit(" that must use `"), target, F.lit("`, with launcher, masks and test.\n\nContext:\n"), context)
    title = F.coalesce("title", F.when(is_api, target).otherwise("Concept"))
    explain = F.concat(F.lit("Read this documentation about "), title, F.lit(", explain its rules, and write a complete program on "), device, F.lit(" that shows them.\n\nDocumentation:\n"), F.left("content", F.lit(EXPLAINED)))
    return chunks.select(
        task_of_section(F.col("section_id")).alias("task_id"),
        F.when(is_api, "api_doc").when(kind == "tutorial", "doc_tutorial").otherwise("doc_semantics").alias("source"),
        F.when(is_api, "kernel_write").otherwise("doc_explain_implement").alias("category"),
        F.when(is_api, target).alias("target_api"),
        title.alias("title"),
        F.when(is_api, api).otherwise(explain).alias("prompt"),
        F.col("section_id").alias("doc_chunk_id"),
    )


def operation_prompts(operations: DataFrame, device: Column, variants: bool = False) -> DataFrame:
    """Translation prompts of operations ``name, code, shapes (map), task_family, shape_class``; with ``variants`` also one for each of SHAPES.

    Variants come from a generator, and name the shape in id and prompt.
    """
    presets = F.array(F.struct(F.lit("").alias("suffix"), F.lit("").alias("hint")), *[F.struct(F.lit("_" + "_".join(str(s[k]) for k in "MNK")).alias("suffix"), F.lit("\n\nUse these dimensions in the test: " + ", ".join(f"{k}={v}" for k, v in sorted(s.items()))).alias("hint")) for s in (SHAPES if variants else ())])
    rows = operations.withColumn("p", F.explode(presets))
    shapes = F.array_join(F.transform(F.array_sort(F.map_keys("shapes")), lambda k: F.concat(k, F.lit(" "), F.element_at("shapes", k))), "; ")
    prompt = F.concat(F.lit("Write a kernel on "), device, F.lit(" that replicates `"), F.col("code"), F.lit("`\nShapes: "), shapes, F.col("p.hint"))
    return rows.select(
        F.concat(F.lit("translate_"), F.lower("name"), F.col("p.suffix")).alias("task_id"),
        *[F.lit(v).alias(c) for c, v in (("source", "torch_op"), ("origin", "torch_op"), ("split", "train"), ("category", "translation"))],
        F.coalesce("task_family", F.lower("name")).alias("task_family"),
        "shape_class",
        prompt.alias("prompt"),
        F.col("code").alias("torch_reference"),
        F.col("code").alias("reference_expr"),
        "shapes",
    )


def finished(rows: DataFrame, architecture: str = "blackwell", system: Column | None = None, keep: tuple[str, ...] = ("shapes",)) -> DataFrame:
    """Prompt records with the columns of RECORD that the rows have, and their defaults.

    The origin defaults to the source, the split to train, the architecture to the one given, the
    reference expression to the reference.  An error if one of them may not be trained on.
    """
    has = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    defaults = {
        "origin": F.coalesce(has("origin"), has("source"), F.lit("unknown")),
        "split": F.coalesce(has("split"), F.lit("train")),
        "gpu_architecture": F.coalesce(has("gpu_architecture"), F.lit(architecture)),
        "reference_expr": first_filled(has("reference_expr"), has("torch_reference")),
    }
    system = F.coalesce(has("system"), system if system is not None else system_prompt(F.lit(architecture)))
    columns = [defaults.get(c, F.col(c) if c in rows.columns else None) for c in RECORD]
    out = rows.select("prompt", system.alias("system"), *[x.alias(c) for c, x in zip(RECORD, columns) if x is not None], *[c for c in keep if c in rows.columns])
    return require_trainable(out, "task_id", F.col("origin"), F.col("split"))


def evaluation_records(rows: DataFrame) -> DataFrame:
    """Records of ``path, record`` (a map of strings) as rows: id and title default to the file's name, family by its fallbacks in lower case with ``_``."""
    at = lambda *names: F.coalesce(*[F.nullif(F.try_element_at("record", F.lit(n)), F.lit("")) for n in names])
    stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
    category = F.coalesce(at("category"), F.lit("kernel_generation"))
    family = F.coalesce(at("task_family", "op"), at("title"), F.when(category != "kernel_generation", category), stem)
    return rows.select(
        F.coalesce(at("id"), stem).alias("task_id"),
        category.alias("category"),
        F.replace(F.lower(strip(family)), F.lit(" "), F.lit("_")).alias("task_family"),
        strip(at("prompt")).alias("prompt"),
        F.coalesce(at("title"), stem).alias("title"),
        F.nullif(F.regexp_extract("path", r"level_?(\d)/[^/]*$", 1), F.lit("")).alias("level"),
        at("input_code").alias("broken_code"),
        at("ground_truth_code", "solution_code", "reference_code").alias("ground_truth_code"),
        *[at(c).alias(c) for c in ("dtype", "shape_class", "layout")],
    )


def held_out(rows: DataFrame, origin: str = "private_eval", split: str = "eval") -> DataFrame:
    """Rows marked as evaluation only."""
    return rows.withColumns({"origin": F.lit(origin), "split": F.lit(split), "source": F.lit(origin)})
