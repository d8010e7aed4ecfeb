"""Queries over fingerprints, decontamination, the release gate, validation results and bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import code as C
from quern.functions.keys import clean_key, first_filled
from quern.operators import bundle, gate, novelty, ranking, release, templates, validation
from quern.operators import contamination as D
from quern.operators.current import current_records
from quern.operators.queries_rows import _ARCH, _BLANK, _FP, _K, _SECRET_SQL
from quern.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _sized(*parts: str) -> str:
    return "sha256(concat_ws('|', " + ", ".join(f"coalesce(length({p}) || ':' || ({p}), '~')" for p in parts) + "))"


def _task_sql(family: str, arch: str, *fields: str) -> str:
    return _sized(family, *fields, "null::varchar", arch)


_TASK = _task_sql("coalesce(nullif(task_family, ''), nullif(category, ''))", _ARCH, "target_api", "torch_reference", "dtype", "shape_class")
_HASH = "case when " + _BLANK.format("{0}") + " then null else " + _FP.format("{0}") + " end"

_ROWS = f"""
cur as (select p.* exclude (task_id), {_K.format('p.task_id')} t from prompts p join (select {_K.format('task_id')} k, max(row_idx) r from prompts where {_K.format('task_id')} is not null group by 1) c on c.r = p.row_idx),
j as (select x.traj_id, x.ingested_at, x.prompt, x.response, x.passed, x.tier, x.provider, x.model, x.system as own_system, x.gateway, {_K.format('x.task_id')} tid, coalesce(nullif({_K.format('x.gpu_architecture')}, ''), {_K.format('c.gpu_architecture')}) gpu_architecture,
  c.prompt task_prompt, c.task_family, c.category, c.target_api, c.torch_reference, c.dtype, c.shape_class, c.origin, c.source, c.split from trajectories x left join cur c on c.t = {_K.format('x.task_id')}),
f as (select *, {_ARCH} a, {_HASH.format("coalesce(nullif(task_prompt, ''), prompt)")} ph, {_TASK} th from j),
ip as (select distinct {_FP.format('prompt')} k from eval_items where not {_BLANK.format('prompt')}),
it as (select distinct {_task_sql("coalesce(nullif(task_family, ''), nullif(category, ''))", "'blackwell'", "null::varchar", "null::varchar", "null::varchar", "null::varchar")} k from eval_items),
h as (select *, coalesce(ph in (select k from ip), false) prompt_hit, coalesce(th in (select k from it), false) task_hit, {_K.format('split')} s from f)
"""
_ISSUES = f"""list_filter([case when coalesce(nullif(origin, ''), source) in ('tritonbench', 'kernelbench_eval', 'private_eval', 'yaml') then 'forbidden origin' end,
 case when s in (RESERVED) then 'reserved split' end, case when prompt_hit then 'prompt of an evaluation item' end, case when task_hit then 'task of an evaluation item' end], lambda i: i is not null)"""


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    """Trajectories with the metadata of the current record of their task."""
    names = ["prompt", "task_family", "category", "target_api", "torch_reference", "dtype", "shape_class", "origin", "source", "split", "gpu_architecture"]
    tasks = current_records(table(spark, sf, "prompts"), "task_id", "row_idx", names).drop("row_idx")
    tasks = tasks.withColumnsRenamed({"prompt": "task_prompt", "gpu_architecture": "task_architecture"})
    rows = table(spark, sf, "trajectories").withColumn("task_id", clean_key("task_id")).drop("semantic_hash")
    rows = rows.join(tasks, "task_id", "left")
    return rows.withColumn("gpu_architecture", F.coalesce(clean_key("gpu_architecture"), clean_key("task_architecture"))).drop("task_architecture")


def _printed(spark: SparkSession, sf: str) -> DataFrame:
    return D.row_fingerprints(_rows(spark, sf))


def _keys(spark: SparkSession, sf: str) -> DataFrame:
    return D.item_keys(table(spark, sf, "eval_items"))


@query(f"with {_ROWS} select traj_id, ingested_at, a as architecture, ph as prompt_hash, th as task_hash from h")
def row_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt and task hashes of every trajectory, with the metadata of its task."""
    return _printed(spark, sf).select("traj_id", "ingested_at", "architecture", "prompt_hash", "task_hash")


@query()
def row_structures(spark: SparkSession, sf: str) -> DataFrame:
    """Structure of the code of every answer."""
    return _printed(spark, sf).select("traj_id", "ingested_at", "answer_structure")


@query(f"with {_ROWS} select 'prompt' as kind, count(*) as n_keys from ip union all select 'task', count(*) from it")
def evaluation_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct prompts and tasks of the evaluation items."""
    return D.key_counts(_keys(spark, sf).where("kind <> 'structure'"))


@query(f"with {_ROWS} select traj_id, ingested_at, prompt_hit, task_hit from h")
def decontam_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Trajectories whose prompt, or whose task, is that of an evaluation item."""
    return D.task_hits(_printed(spark, sf), _keys(spark, sf)).select("traj_id", "ingested_at", "prompt_hit", "task_hit")


@query(f"with {_ROWS}, g as (select traj_id, ingested_at, {_ISSUES.replace('RESERVED', repr(D.FORBIDDEN_SPLITS)[1:-1])} i from h) select traj_id, ingested_at, unnest(i) as issue from g")
def task_issues(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.task_hits(_printed(spark, sf), _keys(spark, sf))
    found = D.task_issues(first_filled(F.col("origin"), F.col("source")), clean_key("split"))
    return rows.select("traj_id", "ingested_at", F.explode(found).alias("issue"))


@query()
def code_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Answers whose code has the structure of an evaluation item's, or that have no code."""
    return D.code_hits(_printed(spark, sf), _keys(spark, sf)).where("code_hit").select("traj_id", "ingested_at")


@query(f"with {_ROWS}, g as (select traj_id, ingested_at, {_ISSUES.replace('RESERVED', repr(D.FORBIDDEN_SPLITS)[1:-1])} i from h) select traj_id, ingested_at from g where len(i) = 0")
def decontam_tasks_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Trajectories whose task may be trained on."""
    rows = D.task_hits(_printed(spark, sf), _keys(spark, sf))
    return rows.where(F.size(D.task_issues(first_filled(F.col("origin"), F.col("source")), clean_key("split"))) == 0).select("traj_id", "ingested_at")


@query()
def decontam_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Trajectories that neither their task nor the structure of their code rules out."""
    rows = D.decontaminated(_printed(spark, sf), _keys(spark, sf), first_filled(F.col("origin"), F.col("source")), clean_key("split"))
    return rows.select("traj_id", "ingested_at")


_TEXTS = "concat_ws(chr(10), tid, prompt, response, provider, model, own_system, gateway, tier, fail_reason, gpu_architecture, response_sha256, task_prompt, task_family, category, target_api, torch_reference, dtype, shape_class, origin, source, split)"
_GATED = f"""with {_ROWS.replace('x.gateway,', 'x.gateway, x.fail_reason, x.response_sha256,')},
g as (select traj_id, ingested_at, tier, list_concat({_ISSUES.replace('RESERVED', repr(D.RESERVED_SPLITS)[1:-1])}, list_filter([case when passed is distinct from true then 'not passed' end,
 {', '.join(f"case when regexp_matches({_TEXTS}, '{p}') then '{n}' end" for n, p in _SECRET_SQL)}], lambda i: i is not null)) i from h)
"""


@query(_GATED + "select traj_id, ingested_at, unnest(i) as issue from g")
def gate_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Issues of every row but those of code structure: see ``release_issues``."""
    rows = release.row_issues(_printed(spark, sf), _keys(spark, sf), structures=False)
    return rows.select("traj_id", "ingested_at", F.explode("issues").alias("issue"))


@query(_GATED + """select count(*) as rows_total, count(*) filter (len(i) > 0) as blocked_rows, count(*) filter (tier is null or tier not in ('silver', 'repair')) as gold_rows,
count(*) filter (tier = 'silver') as silver_rows, count(*) filter (tier = 'repair') as repair_rows, count(*) filter (len(i) > 0) = 0 as passed from g""")
def gate_summary(spark: SparkSession, sf: str) -> DataFrame:
    return gate.gate_counts(release.row_issues(_printed(spark, sf), _keys(spark, sf), structures=False), F.col("issues"), "tier")


@query(_GATED + "select traj_id, ingested_at, i as issues from g where len(i) > 0 order by traj_id, ingested_at limit 50")
def gate_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """The first 50 blocked rows in order, as the gate reports them."""
    rows = release.row_issues(_printed(spark, sf), _keys(spark, sf), structures=False).where(F.size("issues") > 0)
    return rows.orderBy("traj_id", "ingested_at").limit(50).select("traj_id", "ingested_at", "issues")


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of one row per trajectory id, the one ingested first."""
    first = table(spark, sf, "trajectories").groupBy("traj_id").agg(F.min("ingested_at").alias("ingested_at"))
    return _printed(spark, sf).join(first, ["traj_id", "ingested_at"], "left_semi").dropDuplicates(["traj_id"])


@query()
def release_report(spark: SparkSession, sf: str) -> DataFrame:
    """Novelty of the rows that the whole gate leaves, with the manifest's counts."""
    out = release.release(_answers(spark, sf), _keys(spark, sf), "traj_id")
    facts = out["novelty"].first()
    return out["manifest"].withColumns({c: F.lit(facts[c]).cast("long") for c in facts.asDict()})


@query()
def release_issues(spark: SparkSession, sf: str) -> DataFrame:
    return release.release(_answers(spark, sf), _keys(spark, sf), "traj_id")["issues"]


@query()
def answer_novelty(spark: SparkSession, sf: str) -> DataFrame:
    """Answers by id: exact (prompt or code structure within an architecture), near (task) or novel."""
    return novelty.novelty(D.novelty_keys(_answers(spark, sf)), D.EXACT_KEYS, D.NEAR_KEYS, "traj_id")


_FAIL = "coalesce(fail_reason, '')"


@query(f"""select traj_id, ingested_at, case when fail_reason = 'no kernel found' then 'syntax_error' when fail_reason = 'compile error' then 'triton_api' when not coalesce(passed, false) then 'compile_execute_failed'
 when timing_ms is not null and 1 / (1 + timing_ms) < 0.25 then 'benchmark_below_floor' end as first_failure from trajectories""")
def first_failures(spark: SparkSession, sf: str) -> DataFrame:
    """The first stage that recorded results fail: parsing, compiling, running, and a floor on a score of the time."""
    reason = F.coalesce("fail_reason", F.lit(""))
    score = 1 / (1 + F.col("timing_ms"))
    stages = [("syntax_error", reason != "no kernel found"), ("triton_api", reason != "compile error"), ("compile_execute_failed", F.coalesce("passed", F.lit(False))), ("benchmark_below_floor", score >= validation.BENCHMARK_FLOOR)]
    return table(spark, sf, "trajectories").select("traj_id", "ingested_at", validation.first_failure(*stages).alias("first_failure"))


@query()
def validated(spark: SparkSession, sf: str) -> DataFrame:
    """The whole cascade over the programs of all answers, what ran outside being the column ``passed``."""
    rows = table(spark, sf, "trajectories").select("traj_id", "ingested_at", "response", F.col("passed").alias("ran"))
    return validation.cascade(rows, "response", F.col("ran")).select("traj_id", "ingested_at", "fail_reason", "passed")


_SCORE = "100.0 * (case when passed then 1 else 0 end) + 10.0 * (case when coalesce(passed, false) or fail_reason is distinct from 'no kernel found' then 1 else 0 end) + 5.0 * coalesce(1 / (1 + timing_ms), 0) - 0.01 * coalesce(length(response), 0) / 4"


@query(f"""with t as (select {_K.format('task_id')} task_id, traj_id, any_value({_SCORE}) score from trajectories where passed and {_K.format('task_id')} is not null group by 1, 2)
select task_id, arg_min(traj_id, struct_pack(a := -round(score, 6), b := traj_id)) as traj_id from t group by 1""")
def best_by_score(spark: SparkSession, sf: str) -> DataFrame:
    """The passing answer of each task with the highest acceptance score; the lower id wins ties."""
    ok = F.coalesce("passed", F.lit(False))
    compiled = (ok | ~F.col("fail_reason").eqNullSafe("no kernel found")).cast("double")
    score = ranking.score(validation.benchmark_score(F.col("passed")), compiled, 1 / (1 + F.col("timing_ms")), F.length("response") / 4)
    rows = table(spark, sf, "trajectories").where("passed").select(clean_key("task_id").alias("task_id"), "traj_id", F.round(score, 6).alias("score"))
    rows = rows.where("task_id is not null").dropDuplicates(["traj_id"])
    return ranking.best_of_each(rows, "task_id", -F.col("score"), F.col("traj_id"), keep=["traj_id"])


@query(f"""select traj_id, ingested_at, case when o = '' then h else h || chr(10) || chr(10) || 'End of the output:' || chr(10) || o end as feedback from (select *, 'Validation failed: ' || coalesce(nullif(fail_reason, ''), 'unknown') || '.' || chr(10) || 'Find the cause and return the complete corrected program with its test.' h,
 right(coalesce(response, ''), 1500) o from trajectories where passed = false)""")
def feedback_turns(spark: SparkSession, sf: str) -> DataFrame:
    """What a user turn says after each failed answer, its end standing for the output."""
    rows = table(spark, sf, "trajectories").where("passed = false")
    output = validation.output_tail(F.create_map(F.lit("syntax"), F.col("response")))
    return rows.select("traj_id", "ingested_at", validation.feedback(F.col("fail_reason"), output).alias("feedback"))


@query(f"select traj_id, ingested_at, case when model = 'orchid-large' or starts_with(model, 'orchid-large-') then 'orchid-large' when model = 'basalt' or starts_with(model, 'basalt-') then 'basalt' else model end as logical_model from trajectories")
def logical_models(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "trajectories")
    return rows.select("traj_id", "ingested_at", validation.logical_model(F.col("model"), ["orchid-large", "basalt"]).alias("logical_model"))


@query("select traj_id, ingested_at, coalesce((provider = 'orchid' and (model = 'orchid-large' or starts_with(model, 'orchid-large-'))) or (provider = 'basalt' and (model = 'basalt-small' or starts_with(model, 'basalt-small-'))), false) as allowed from trajectories")
def allowed_teachers(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of allowed pairs of provider and model, dated builds included."""
    allowed = spark.createDataFrame([("orchid", "orchid-large"), ("basalt", "basalt-small")], "provider string, model string")
    return validation.allowed_models(table(spark, sf, "trajectories"), allowed).select("traj_id", "ingested_at", "allowed")


@query("""with n as (select origin k, count(*) n from prompts group by 1), w(k, l) as (values ('api_doc', 50), ('doc_tutorial', 1), ('doc_semantics', 1))
select w.k as kind, coalesce(n, 0) as n, l::bigint as least from w left join n on n.k = w.k where coalesce(n, 0) < l""")
def missing_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Builders of which there are fewer prompts than a whole catalogue has."""
    return validation.missing_kinds(table(spark, sf, "prompts"), "origin", {"api_doc": 50, "doc_tutorial": 1, "doc_semantics": 1})


_DEVICE = "coalesce(map {'blackwell': 'Blackwell', 'hopper': 'Hopper'}[lower(gpu_architecture)], 'Blackwell')"


@query(f"""with p as (select row_idx, category, coalesce(prompt, '') p, coalesce(category, 'translation') c, coalesce(map {{'blackwell': 'Blackwell', 'hopper': 'Hopper'}}[{_K.format('gpu_architecture')}], 'Blackwell') d from prompts)
select row_idx, c || ':structured-v1' as prompt_template, sha256(regexp_replace(replace(coalesce(map {{{', '.join(f"'{k}': '{v}'" for k, v in templates.HEADERS.items())}}}[c], '{templates.OTHER_HEADER}'), '{{device}}', d) || chr(10) || chr(10) || regexp_replace(p, '^\\s+|\\s+$', '', 'g'), '^\\s+|\\s+$', '', 'g')
 || {" || ".join(f"chr(10) || chr(10) || replace('{s}', '{{device}}', d)" for s in templates.SECTIONS)}) as prompt_hash from p""")
def templated_prompts(spark: SparkSession, sf: str) -> DataFrame:
    device = validation.looked_up(clean_key("gpu_architecture"), {"blackwell": "Blackwell", "hopper": "Hopper"}, "Blackwell")
    rows = templates.templated(table(spark, sf, "prompts"), device)
    return rows.select("row_idx", "prompt_template", F.sha2("prompt", 256).alias("prompt_hash"))


@query("""with d as (select doc_id, case when source is null then 'api_symbol' when lower(trim(source)) = 'doc_tutorial' then 'tutorial' when lower(trim(source)) = 'api_doc' then 'api_symbol' else 'semantics' end k, section_id s, text t from documents where text is not null and section_id is not null)
select case when regexp_matches(s, '^(api_|sem_|tut_|doc_)') then s else 'doc_' || s end as task_id, s as doc_chunk_id, case k when 'api_symbol' then 'api_doc' when 'tutorial' then 'doc_tutorial' else 'doc_semantics' end as source,
 case k when 'api_symbol' then 'kernel_write' else 'doc_explain_implement' end as category,
 sha256(case k when 'api_symbol' then 'Write a complete kernel on Blackwell that must use `tl.dot`, with launcher, masks and test.' || chr(10) || chr(10) || 'Context:' || chr(10) || left(t, 1500)
  else 'Read this documentation about Concept, explain its rules, and write a complete program on Blackwell that shows them.' || chr(10) || chr(10) || 'Documentation:' || chr(10) || left(t, 2500) end) as prompt_hash from d""")
def chunk_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts from the documents that name a section."""
    source = F.lower(F.trim("source"))
    kind = F.when(F.col("source").isNull() | (source == "api_doc"), "api_symbol").when(source == "doc_tutorial", "tutorial").otherwise("semantics")
    none = F.lit(None).cast("string")
    docs = table(spark, sf, "documents").where("text is not null and section_id is not null")
    chunks = docs.select(kind.alias("chunk_kind"), "section_id", none.alias("title"), none.alias("target_api"), F.col("text").alias("content"), F.lit(False).alias("enriched"))
    return templates.chunk_prompts(chunks, F.lit("Blackwell")).select("task_id", "doc_chunk_id", "source", "category", F.sha2("prompt", 256).alias("prompt_hash"))


@query(f"""select traj_id, ingested_at, sha256('{{"max_tokens":4096,"messages":[' || case when {_BLANK.format('system')} then '' else '{{"content":' || to_json(system)::varchar || ',"role":"system"}},' end || '{{"content":' || to_json(coalesce(prompt, ''))::varchar || ',"role":"user"}}],' ||
 case when model is null then '' else '"model":' || to_json(model)::varchar || ',' end || '"reasoning":{{"effort":"high"}},"temperature":0.5}}') as request_sha256 from trajectories""")
def request_hashes(spark: SparkSession, sf: str) -> DataFrame:
    """Hash of the canonical request of every answer."""
    body = bundle.request_body(F.col("model"), F.col("prompt"), F.col("system"), 4096, 0.5, "high")
    return table(spark, sf, "trajectories").select("traj_id", "ingested_at", bundle.request_hash(body).alias("request_sha256"))


@query("select traj_id, ingested_at, sha256(concat_ws('|', 'sampling', coalesce(task_id, ''), 'run-1', 'stratified-v1')) as sampling_seed, sha256(concat_ws('|', 'evolution', 'run-1', coalesce(task_id, ''), '2', 'stratified-v1')) as evolution_seed from trajectories")
def policy_seeds(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "trajectories")
    return rows.select("traj_id", "ingested_at", bundle.sampling_seed(F.col("task_id"), F.lit("run-1")).alias("sampling_seed"), bundle.evolution_seed(F.lit("run-1"), F.col("task_id"), F.lit(2)).alias("evolution_seed"))


_CHECKED = """select 'passed' as "check", traj_id as "row", 'passed fails' as issue from trajectories where passed is distinct from true union all
select 'response_hash', traj_id, 'response_hash fails' from trajectories where response_sha256 is distinct from sha256(response) or response is null union all
select 'provider', traj_id, 'provider fails' from trajectories where provider is null or provider = ''"""


@query(_CHECKED)
def bundle_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Row checks of the bundle of all answers: passed, recorded hash, provider."""
    rows = table(spark, sf, "trajectories")
    return bundle.row_checks(rows, "traj_id", passed=F.col("passed"), response_hash=F.col("response_sha256") == F.sha2("response", 256), provider=F.col("provider") != "")


@query()
def bundle_seal(spark: SparkSession, sf: str) -> DataFrame:
    """Facts that seal the passing answers."""
    rows = table(spark, sf, "trajectories").dropDuplicates(["traj_id"])
    _, facts = bundle.proved(rows, "traj_id", ["prompt", "response", "provider", "model", "system", "gateway"], F.col("passed"), 0.1)
    return spark.createDataFrame([(facts["sample_count"], facts["raw_sample_count"], facts["merkle_root"])], "sample_count long, raw_sample_count long, merkle_root string")


@query()
def chosen_mutations(spark: SparkSession, sf: str) -> DataFrame:
    """One broken program of every evaluation item that has one, chosen by the hash of its task."""
    rows = table(spark, sf, "eval_items").where("ground_truth_code is not null")
    out = rows.select("item_id", C.chosen_mutation(F.col("task_id"), C.mutations(F.col("ground_truth_code"))).alias("m")).where("m is not null")
    return out.select("item_id", "m.mutation", "m.code", "m.reason")
