"""Queries over prompts, trajectories, evaluation items and documents with the general operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import code as C
from quern.functions import text as X
from quern.functions.canonical import canonical_hash, joined_hash, struct_hash
from quern.functions.keys import clean_key, first_filled, is_blank
from quern.operators import chat, contamination, derive, gate, merkle, novelty, ranking, sampling, sections, summary, verify
from quern.operators.current import current_records
from quern.plans.build import lineage_splits, ordered_splits
from quern.plans.stage import Stage
from quern.sources.files import matching
from quern.sources.tables import table

_K = "nullif(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '')"
_FP = "sha256(regexp_replace(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '\\s+', ' ', 'g'))"
_BLANK = "coalesce(regexp_replace({0}, '\\s+', '', 'g') = '', true)"
_ARCH = f"coalesce({_K.format('gpu_architecture')}, 'blackwell')"
_CODE = (
    "case when len(regexp_extract_all({0}, '(?s)```python\\n(.*?)```', 1)) > 0 then array_to_string(regexp_extract_all({0}, '(?s)```python\\n(.*?)```', 1), chr(10) || chr(10)) "
    "when len(regexp_extract_all({0}, '(?s)```\\n(.*?)```', 1)) > 0 then array_to_string(regexp_extract_all({0}, '(?s)```\\n(.*?)```', 1), chr(10) || chr(10)) else {0} end"
)
QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"select doc_id, {_FP.format('text')} as fingerprint from documents")
def text_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", X.text_fingerprint(F.col("text")).alias("fingerprint"))


@query(f"""with d as (select doc_id, {_FP.format('text')} f from documents)
select doc_id, f as fingerprint from d where f is null or doc_id = (select min(doc_id) from d e where e.f = d.f)""")
def dedupe_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    return novelty.first_of_each(text_fingerprint(spark, sf), "fingerprint", "doc_id")


@query(f"select {_FP.format('text')} as fingerprint, min(doc_id) as first, count(*) as n from documents where text is not null group by 1 having count(*) > 1")
def duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    return novelty.duplicate_groups(text_fingerprint(spark, sf), "fingerprint", "doc_id")


_FIELDS = ["coalesce(nullif(task_family, ''), nullif(category, ''))", "target_api", "torch_reference", "dtype", "shape_class", "null::varchar", _ARCH]
_NOVEL = f"""
with p as (select row_idx, {_ARCH} a, origin, case when {_BLANK.format('prompt')} then null else {_FP.format('prompt')} end f,
  sha256(concat_ws('|', {', '.join(f"coalesce(length({c}) || ':' || ({c}), '~')" for c in _FIELDS)})) s from prompts),
k as (select row_idx, origin, 'e' kind, a || ':' || f key from p where f is not null union all select row_idx, origin, 'n', s from p),
m as (select kind, key, min(case when origin = 'api_doc' then -1 else row_idx end) m from k group by 1, 2),
v as (select k.row_idx, max(case when m.m < k.row_idx then case when kind = 'e' then 2 else 1 end else 0 end) v from k join m using (kind, key) where origin is distinct from 'api_doc' group by 1),
verdict as (select row_idx, case v when 2 then 'exact' when 1 then 'near' else 'novel' end verdict from v)
"""


@query(_NOVEL + "select row_idx, verdict from verdict")
def novelty_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """Delivered prompts against a registry (the records of one builder) and the rows before them."""
    rows = contamination.prompt_keys(table(spark, sf, "prompts")).select("row_idx", "origin", "exact_key", "near_key")
    own = F.coalesce(F.col("origin") != "api_doc", F.lit(True))
    return novelty.novelty(rows.where(own), ["exact_key"], ["near_key"], "row_idx", rows.where(~own))


@query(_NOVEL + "select count(*) as verified_rows, count(*) filter (verdict = 'exact') as exact_rows, count(*) filter (verdict = 'near') as near_rows, count(*) filter (verdict = 'novel') as novel_rows from verdict")
def novelty_report(spark: SparkSession, sf: str) -> DataFrame:
    return novelty.novelty_report(novelty_verdicts(spark, sf))


_SECRET_SQL = [("api key", "\\bsk-[A-Za-z0-9_\\-]{16,}"), ("home path", "/home/\\w+"), ("key variable", "\\b[A-Z]+_API_KEY\\b")]
_WIDE_SQL = [*_SECRET_SQL, ("assignment", "(?i)(key|token|secret|password)\\s*[=:]"), ("e-mail", "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}")]


@query(" union all ".join(f"select doc_id, '{n}' as issue from documents where regexp_matches(text, '{p}')" for n, p in _WIDE_SQL))
def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return gate.exploded(table(spark, sf, "documents"), "doc_id", gate.secrets(F.col("text"), gate.SECRETS_WIDE))


_REQUIRED = ("task_id", "prompt", "source", "origin", "split", "category")
_SPLITS = ("train", "dev")


@query(
    " union all ".join(f"select row_idx, '{c} is blank' as issue from prompts where {_BLANK.format(c)}" for c in _REQUIRED)
    + f" union all select row_idx, 'split' from prompts where coalesce({_K.format('split')} not in ('train', 'dev'), true) union all select row_idx, 'origin' from prompts where coalesce(nullif(origin, ''), source) in ('tritonbench', 'kernelbench_eval', 'private_eval', 'yaml')"
)
def schema_violations(spark: SparkSession, sf: str) -> DataFrame:
    found = gate.schema_issues(list(_REQUIRED), clean_key("split"), _SPLITS, first_filled(F.col("origin"), F.col("source")), contamination.FORBIDDEN_ORIGINS)
    return gate.exploded(table(spark, sf, "prompts"), "row_idx", found)


@query("select row_idx, task_id, origin from prompts where origin in ('api_doc', 'doc_tutorial')")
def filtered_prompts(spark: SparkSession, sf: str) -> DataFrame:
    return matching(table(spark, sf, "prompts"), origin=["api_doc", " doc_tutorial", ""]).select("row_idx", "task_id", "origin")


def _current(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return current_records(table(spark, sf, "prompts"), "task_id", "row_idx", list(columns))


_CUR = f"cur as (select p.*, {_K.format('p.task_id')} t from prompts p join (select {_K.format('task_id')} k, max(row_idx) r from prompts where {_K.format('task_id')} is not null group by 1) c on c.r = p.row_idx)"
_H = "sha256('s1|' || coalesce({0}, ''))"


@query(f"""with {_CUR},
b as (select t, coalesce(nullif(origin, ''), nullif(source, ''), 'unknown') s, coalesce(nullif(task_family, ''), nullif(category, ''), nullif(target_api, ''), 'unknown') f from cur),
h as (select *, {_H.format('t')} k, {_H.format('f')} fk, {_H.format('s')} sk from b),
r as (select *, row_number() over (partition by s, f order by k, t) rk from h),
p as (select *, row_number() over (partition by s order by rk, fk, f) pk from r)
select t as task_id, s as bucket_source, f as bucket_family from p order by (pk > 50)::int, pk, sk, s limit 200""")
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    """200 prompt records over builders and families."""
    rows = _current(spark, sf, "source", "origin", "task_family", "category", "target_api")
    source = sampling.bucket(F.col("origin"), F.col("source"))
    family = sampling.bucket(F.col("task_family"), F.col("category"), F.col("target_api"))
    rows = rows.select("task_id", source.alias("bucket_source"), family.alias("bucket_family"))
    return sampling.stratified_sample(rows, "bucket_source", "bucket_family", "task_id", 200, "s1")


@query("""with h as (select sha256(concat_ws(chr(1), coalesce(task_id, chr(2)), coalesce(prompt, chr(2)))) h from prompts)
select sha256(concat_ws(',', """ + ", ".join(f"sum(('0x' || substr(h, {1 + 8 * i}, 8))::bigint::hugeint)::varchar" for i in range(8)) + ")) as catalogue_hash, count(*) as n_rows from h")
def catalogue_hash(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.catalogue_hash(table(spark, sf, "prompts"), "task_id", "prompt")


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    rows = _current(spark, sf, "parent_id", "torch_reference", "target_api", "task_family", "split")
    rows = Stage(spark, "records").write(rows.withColumns({"parent_id": clean_key("parent_id"), "split": clean_key("split")}))
    return lineage_splits(rows)


_LINEAGE = f"""
with recursive {_CUR},
r as (select t, {_K.format('parent_id')} p, coalesce('family:' || nullif(task_family, ''), 'torch_reference:' || sha256(nullif(torch_reference, '')), 'ancestry:' || {_K.format('parent_id')}, 'api:' || nullif(target_api, ''), 'task:' || t) i, case when {_K.format('split')} in ('eval', 'held_out') then {_K.format('split')} end res from cur),
e as (select t x, 'k' || i y from r union select t, 't' || t from r union select t, 't' || p from r where p is not null),
n as (select distinct a.x x, min(b.x) over (partition by a.y) y from e a join e b using (y)),
adj as (select x, y from n union select y, x from n),
reach as (select x, y from adj union select q.x, d.y from reach q join adj d on d.x = q.y),
comp as (select x t, min(y) c from reach group by 1),
g as (select c, min(res) lo, max(res) hi from comp join r using (t) group by 1),
s as (select t, 'component:' || sha256(c) split_group, coalesce(lo, case when ('0x' || substr(sha256('component:' || sha256(c)), 1, 2))::int < 25 then 'dev' else 'train' end) split, coalesce(lo <> hi, false) conflict from comp join g using (c))
"""


@query(_LINEAGE + "select t as task_id, split_group, split, conflict from s")
def split_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt records by parent and the strongest identity of each; groups with a reserved split keep it."""
    return _assigned(spark, sf)


@query(_LINEAGE + "select t as task_id, split_group, split, conflict, min(t) over (partition by split_group) as first_task_id from s")
def ordered_split_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """The assignment in the order in which it is written: groups by their smallest id."""
    return ordered_splits(_assigned(spark, sf))


@query(_LINEAGE + "select split, count(*) as n from s group by 1")
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return summary.counts(_assigned(spark, sf), F.col("split"))


_UNK = "coalesce(nullif({0}, ''), 'unknown')"


@query(f"""with t as (select {_UNK.format('provider')} provider, {_UNK.format('tier')} tier, coalesce(passed, false) p from trajectories),
u as (select 'all' as dimension, 'all' as value, p from t union all select 'provider', provider, p from t union all select 'tier', tier, p from t)
select dimension, value, count(*) as n_run, count(*) filter (p) as n_passed, count(*) filter (p) / count(*) as rate from u group by 1, 2""")
def pass_rates(spark: SparkSession, sf: str) -> DataFrame:
    return summary.pass_rates(table(spark, sf, "trajectories"), ["provider", "tier"], F.col("passed"))


@query(f"""with {_CUR}, p as (select t, category, origin from cur), x as (select coalesce(p.category, 'unknown') category, coalesce(p.origin, 'unknown') origin, coalesce(passed, false) ok from trajectories j left join p on p.t = {_K.format('j.task_id')}),
u as (select 'all' as dimension, 'all' as value, ok from x union all select 'category', category, ok from x union all select 'origin', origin, ok from x)
select dimension, value, count(*) as n_run, count(*) filter (ok) as n_passed, count(*) filter (ok) / count(*) as rate from u group by 1, 2""")
def bundle_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Pass rates of trajectories by category and builder of their prompt."""
    prompts = _current(spark, sf, "category", "origin").drop("row_idx")
    rows = table(spark, sf, "trajectories").select(clean_key("task_id").alias("task_id"), "passed").join(prompts, "task_id", "left")
    return summary.pass_rates(rows, ["category", "origin"], F.col("passed"))


@query("""select coalesce(nullif(category, ''), split_part(task_id, '_', 1), 'unknown') as category, count(*) as n, avg(bench_tier::double) as avg_correct, avg(case when ground_truth_code is null then 0.0 else 1.0 end) as run_rate from eval_items group by 1""")
def category_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "eval_items")
    return summary.category_report(rows, F.col("category"), F.col("task_id"), F.col("bench_tier").cast("double"), F.col("ground_truth_code").isNotNull())


@query("""with t as (select provider, timing_ms from trajectories where timing_ms is not null),
r as (select provider, count(*) n, list(timing_ms order by timing_ms) l from t group by 1)
select provider, n, (l[(n - 1) // 2 + 1] + l[n // 2 + 1]) / 2 as median_ms, l[floor(0.95 * (n - 1))::bigint + 1] as p95_ms, l[1] as min_ms, l[n] as max_ms from r""")
def timing_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.timing_summary(table(spark, sf, "trajectories"), "provider", "timing_ms")


_PASS = f"t as (select {_K.format('task_id')} task_id, traj_id, any_value(provider) provider, any_value(timing_ms) ms, any_value(response) r from trajectories where passed and {_K.format('task_id')} is not null group by 1, 2)"


def _passing(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "trajectories").where("passed").select(clean_key("task_id").alias("task_id"), "traj_id", "provider", "timing_ms", "response")
    return rows.where("task_id is not null").dropDuplicates(["traj_id"])


@query(f"with {_PASS} select task_id, arg_min(traj_id, struct_pack(a := coalesce(nullif(ms, 0), 'infinity'::double), b := traj_id)) as traj_id from t group by 1")
def best_of_n(spark: SparkSession, sf: str) -> DataFrame:
    """The fastest passing answer of each task."""
    t = F.coalesce(F.nullif(F.col("timing_ms"), F.lit(0.0)), F.lit(float("inf")))
    return ranking.best_of_each(_passing(spark, sf), "task_id", t, F.col("traj_id"), keep=["traj_id"])


@query(f"""with {_PASS}, o as (select *, row_number() over (partition by task_id order by coalesce(nullif(ms, 0), 'infinity'::double), traj_id) k from t)
select l.task_id, w.traj_id as winner, l.traj_id as loser, w.ms as winner_ms, l.ms as loser_ms, (l.ms - w.ms) / l.ms as speedup from o l join o w on w.task_id = l.task_id and w.k = 1
where l.k > 1 and l.ms > 0 and w.ms is not null and trim(l.r) <> '' and trim(w.r) <> '' and (l.ms - w.ms) / l.ms >= 0.03""")
def preference_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.preference_pairs(_passing(spark, sf), "task_id", "traj_id", "timing_ms", "response").drop("chosen", "rejected")


_CLASS = """case when coalesce(passed, false) then 'pass' when regexp_matches(lower(coalesce(fail_reason, '')), 'syntax|no kernel') then 'parse' when lower(fail_reason) like '%api%' then 'api'
 when lower(fail_reason) like '%compile%' then case when regexp_matches(lower(coalesce(right(response, 200), '')), 'mask|bound') then 'mask' when lower(right(response, 200)) like '%stride%' then 'stride' when regexp_matches(lower(coalesce(right(response, 200), '')), 'dtype|float') then 'dtype' else 'compile' end
 when regexp_matches(lower(coalesce(fail_reason, '')), 'timeout|floor') then 'performance' else 'runtime' end"""


@query(f"select traj_id, {_CLASS} as failure_class from trajectories")
def failure_classes(spark: SparkSession, sf: str) -> DataFrame:
    klass = derive.failure_class(F.col("passed"), F.col("fail_reason"), X.tail(F.col("response"), 200))
    return table(spark, sf, "trajectories").select("traj_id", klass.alias("failure_class"))


TEMPLATES = {
    "compile": "Write a kernel for {op} that compiles, with explicit masks.",
    "mask": "Write a kernel for {op} whose length is no multiple of the block size.",
    "stride": "Write a kernel for {op} on a strided tensor.",
    "dtype": "Write a kernel for {op} in half precision with full-precision sums.",
    "performance": "Speed up a correct kernel for {op}.",
}
_TEMPLATE = "case c " + " ".join(f"when '{k}' then '{v}'" for k, v in TEMPLATES.items()) + f" else '{TEMPLATES['compile']}' end"


@query(f"""with {_CUR}, t as (select traj_id, {_K.format('task_id')} k, {_CLASS} c from trajectories), f as (select distinct k, c, coalesce(nullif(cur.task_family, ''), 'kernel') op from t join cur on cur.t = k where c <> 'pass' and coalesce(coalesce(nullif(origin, ''), source) not in ('tritonbench', 'kernelbench_eval', 'private_eval', 'yaml'), true) and coalesce({_K.format('split')} not in ('test', 'eval'), true)),
v as (select *, unnest([0, 1]) v from f)
select concat_ws('_', 'mined', k, c, v) as task_id, k as parent, replace({_TEMPLATE}, '{{op}}', op) || case v when 0 then '' else ' Shape variant ' || (v + 1) || '.' end as prompt from v""")
def mined_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Two new tasks for every failing class of a prompt record that may be trained on."""
    klass = derive.failure_class(F.col("passed"), F.col("fail_reason"), X.tail(F.col("response"), 200))
    failures = table(spark, sf, "trajectories").select(clean_key("task_id").alias("task_id"), klass.alias("klass")).where("klass <> 'pass'").distinct()
    parents = _current(spark, sf, "task_family", "origin", "source", "split").where(contamination.trainable(first_filled(F.col("origin"), F.col("source")), clean_key("split")))
    failures = failures.join(parents.select("task_id", "task_family"), "task_id")
    return derive.mined_tasks(failures, "task_id", "klass", F.col("task_family"), TEMPLATES)


OPERATIONS = {
    "tail": "Handle lengths that are no power of two.",
    "stride": "Inputs are strided.",
    "half": "Inputs are in half precision, sums are not.",
    "fusion": "Fuse a residual addition.",
    "tuning": "Offer three configurations.",
}


@query(f"""with {_CUR}, o as (select t, prompt, unnest([{', '.join(f"struct_pack(h := sha256('e1|' || t || '|{k}'), op := '{k}', tx := '{v}')" for k, v in OPERATIONS.items())}]) x from cur where not {_BLANK.format('prompt')}),
r as (select *, row_number() over (partition by t order by x.h) k from o)
select concat_ws('_', 'evolve', t, x.op) as task_id, t as parent_id, x.op as operation, prompt || chr(10) || chr(10) || 'Additional requirement: ' || x.tx as prompt from r where k <= 2""")
def evolved_tasks(spark: SparkSession, sf: str) -> DataFrame:
    rows = _current(spark, sf, "prompt").where(~is_blank(F.col("prompt")))
    return derive.evolved_tasks(rows, "task_id", "prompt", OPERATIONS, 2, "e1")


def _html_sql() -> str:
    entities = "map {" + ", ".join("'{}': '{}'".format(k, v.replace("'", "''")) for k, v in X.ENTITIES.items()) + "}"
    token = f"case when regexp_matches(t, '{X._LINE_END}') then chr(10) when regexp_matches(t, '(?s)^<.+>$') then ' ' when t like '&%' and length(t) > 2 then coalesce({entities}[t], t) else t end"
    text = f"array_to_string(list_transform(regexp_extract_all(text, '{X.TOKEN}'), lambda t: {token}), '')"
    lines = f"array_to_string(list_transform(string_split({text}, chr(10)), lambda l: regexp_replace(regexp_replace(l, '[ \\t]+$', ''), '[ \\t]{{2,}}', ' ', 'g')), chr(10))"
    return f"select doc_id, sha256(regexp_replace(regexp_replace({lines}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')) as text_hash from documents"


@query(_html_sql())
def html_to_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.sha2(X.html_to_text(F.col("text")), 256).alias("text_hash"))


@query("select row_idx, left(regexp_replace(regexp_replace(lower(coalesce(source, '') || ' ' || coalesce(category, '')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 64) as slug from prompts")
def slugs(spark: SparkSession, sf: str) -> DataFrame:
    joined = F.concat(F.coalesce("source", F.lit("")), F.lit(" "), F.coalesce("category", F.lit("")))
    return table(spark, sf, "prompts").select("row_idx", X.slug(joined).alias("slug"))


@query(f"select traj_id, sha256({_CODE.format('response')}) as code_hash from trajectories")
def code_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "trajectories").select("traj_id", F.sha2(X.code_blocks(F.col("response")), 256).alias("code_hash"))


_PROSE = "regexp_replace(regexp_split_to_array(response, '```[a-z]*\\n')[1], '^\\s+|\\s+$', '', 'g')"


@query(f"select traj_id, {_PROSE} as prose from trajectories where response like '%```%' and length({_PROSE}) >= 32")
def prose_before_code(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "trajectories").select("traj_id", X.prose_before_code(F.col("response")).alias("prose")).where("prose is not null")


@query("select row_idx, array_to_string(regexp_extract_all(torch_reference, '([A-Za-z_][A-Za-z0-9_]*)', 1), ' ') as names from prompts where torch_reference is not null")
def shape_names(spark: SparkSession, sf: str) -> DataFrame:
    """Identifiers of the reference expression of each prompt."""
    return table(spark, sf, "prompts").where("torch_reference is not null").select("row_idx", F.array_join(X.identifiers(F.col("torch_reference")), " ").alias("names"))


_LINES = "l as (select doc_id, unnest(string_split(text, chr(10))) line, unnest(range(len(string_split(text, chr(10))))) n from documents)"
_HEADS = f"""with {_LINES},
m as (select *, coalesce(regexp_matches(lead(line) over w, '^[-=]{{3,}}$'), false) and regexp_replace(line, '^\\s+|\\s+$', '', 'g') <> '' and not regexp_matches(line, '^[-=]{{3,}}$') h from l window w as (partition by doc_id order by n)),
s as (select *, coalesce(lag(h) over w, false) rule, last_value(case when h then n end ignore nulls) over w hn, last_value(case when h then regexp_replace(line, '^\\s+|\\s+$', '', 'g') end ignore nulls) over w title from m window w as (partition by doc_id order by n)),
b as (select doc_id, hn, title, regexp_replace(string_agg(line, chr(10) order by n), '^\\s+|\\s+$', '', 'g') content from s where hn is not null and not h and not rule group by 1, 2, 3)
"""


@query(_HEADS + """select doc_id, 'sem_' || coalesce(nullif(left(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 64), ''), 'section') as section_id, title, content from b where length(content) >= 80""")
def underlined_sections(spark: SparkSession, sf: str) -> DataFrame:
    return sections.underlined_sections(table(spark, sf, "documents"), "doc_id", "text")


@query(f"""with {_LINES}, m as (select *, sum(case when n > 0 and regexp_matches(line, '^###?\\s') then 1 else 0 end) over (partition by doc_id order by n) section from l),
b as (select doc_id, section::int section, regexp_replace(string_agg(line, chr(10) order by n), '^\\s+|\\s+$', '', 'g') content from m group by 1, 2)
select doc_id, section, left(string_split(content, chr(10))[1], 120) as title, content from b where length(content) >= 100""")
def markdown_sections(spark: SparkSession, sf: str) -> DataFrame:
    return sections.markdown_sections(table(spark, sf, "documents"), "doc_id", "text")


@query()
def tutorial_cells(spark: SparkSession, sf: str) -> DataFrame:
    return sections.tutorial_cells(table(spark, sf, "documents"), "doc_id", "text", 20)


@query()
def listed_symbols(spark: SparkSession, sf: str) -> DataFrame:
    return sections.listed_symbols(table(spark, sf, "documents"), "doc_id", "text")


_SFT = f"t as (select traj_id, any_value(system) s, any_value(prompt) p, any_value(response) r from trajectories where coalesce(passed, true) and not {_BLANK.format('response')} group by 1)"


@query(f"""with {_SFT}, m as (select traj_id, 0 a, 'system' as role, s as content from t where not {_BLANK.format('s')} union all select traj_id, 1, 'user', p from t union all select traj_id, 2, 'assistant', r from t)
select traj_id, (row_number() over (partition by traj_id order by a) - 1)::int as position, role, content from m""")
def sft_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Chat messages of all answers that did not fail."""
    rows = table(spark, sf, "trajectories").where(F.coalesce(F.col("passed"), F.lit(True)) & ~is_blank(F.col("response"))).dropDuplicates(["traj_id"])
    return chat.chat_rows(rows, "traj_id", chat.messages(F.col("prompt"), F.col("response"), F.col("system")))


_SIDE = "prompt, response, provider, model, semantic_hash, gateway, response_sha256"


@query(f"""with l as (select distinct {_SIDE} from trajectories where passed), r as (select distinct {_SIDE} from trajectories where tier in ('gold', 'silver'))
select *, 'left' as side from (from l except from r) union all select *, 'right' from (from r except from l)""")
def consistency(spark: SparkSession, sf: str) -> DataFrame:
    """Passing trajectories against those of the two upper tiers, both ways, nulls equal: the repairs come out."""
    rows = table(spark, sf, "trajectories")
    return verify.both_ways(rows.where("passed"), rows.where("tier in ('gold', 'silver')"), _SIDE.split(", "))


@query("select traj_id, response_sha256 as committed, sha256(response) as recomputed from trajectories where response_sha256 is null or response is null or response_sha256 <> sha256(response)")
def wrong_hashes(spark: SparkSession, sf: str) -> DataFrame:
    """Trajectories whose recorded answer hash is not that of the answer."""
    return verify.wrong_hashes(table(spark, sf, "trajectories"), "traj_id", F.col("response_sha256"), F.sha2("response", 256))


@query(f"""with p as (select distinct {_K.format('task_ids_path')} path, rows_total from registry_snapshots where task_ids_path is not null),
c as (select {_K.format('task_ids_path')} path, count(distinct {_K.format('task_id')}) n from accepted_task_ids group by 1)
select p.path, rows_total as expected, coalesce(n, 0) as actual, coalesce(n, 0) = rows_total as agrees from p left join c using (path)""")
def registry_pins(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted-id lists against the row totals that the snapshots name."""
    pins = table(spark, sf, "registry_snapshots").select(clean_key("task_ids_path").alias("path"), F.col("rows_total").alias("expected")).where("path is not null").distinct()
    lists = table(spark, sf, "accepted_task_ids").select(clean_key("task_ids_path").alias("path"), clean_key("task_id").alias("t"))
    actual = lists.where("path is not null and t is not null").distinct().groupBy("path").agg(F.count("*").alias("actual"))
    return verify.against_pins(actual, pins, "path")


@query(f"with {_CUR} select t as task_id from cur where t not in (select {_K.format('task_id')} from trajectories where {_K.format('task_id')} is not null)")
def unanswered(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt records without any answer: what a resumed run has left to do."""
    done = table(spark, sf, "trajectories").select(clean_key("task_id").alias("task_id")).where("task_id is not null").distinct()
    return _current(spark, sf).join(done, "task_id", "left_anti").select("task_id")


@query(f"""with {_CUR}, f as (select {_K.format('task_id')} t, arg_max(semantic_hash, fp_id) h from accepted_fingerprints where {_K.format('task_id')} is not null group by 1)
select cur.t as task_id, coalesce(nullif(cur.gpu_architecture, ''), nullif(a.gpu_architecture, '')) as gpu_architecture from cur left join (select {_K.format('task_id')} t, arg_max(coalesce(gpu_architecture, ''), fp_id) gpu_architecture from accepted_fingerprints group by 1) a on a.t = cur.t""")
def backfilled(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt records whose missing architecture is filled from the accepted row of their id."""
    rows = _current(spark, sf, "gpu_architecture").drop("row_idx")
    accepted = table(spark, sf, "accepted_fingerprints").select(clean_key("task_id").alias("task_id"), "fp_id", F.coalesce("gpu_architecture", F.lit("")).alias("gpu_architecture"))
    return derive.filled_from(rows, accepted, "task_id", ["gpu_architecture"], "fp_id")


_BUILDERS = {"doc": ("api_doc", "doc_tutorial", "doc_semantics"), "mutation": ("mutation",), "torch_op": ("torch_op",), "mined": ("mined",), "evolved": ("self_evolution",)}


@query(" union all ".join(f"select row_idx, task_id, '{p}' as part, {i} as part_order from prompts where origin in ({', '.join(map(repr, o))})" for i, (p, o) in enumerate(_BUILDERS.items())) + " union all select item_id, task_id, 'eval', 5 from eval_items")
def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts of the five builders in their order, and the evaluation items after them."""
    prompts = table(spark, sf, "prompts")
    parts = [(p, prompts.where(F.col("origin").isin(*o)).select("row_idx", "task_id")) for p, o in _BUILDERS.items()]
    return derive.catalogue(*parts, ("eval", table(spark, sf, "eval_items").select(F.col("item_id").alias("row_idx"), "task_id")))


@query("select item_id, p as provider from eval_items, (values ('orchid'), ('basalt'), ('saffron')) v(p)")
def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every evaluation item once per teacher."""
    return derive.with_values(table(spark, sf, "eval_items").select("item_id"), "provider", ["orchid", "basalt", "saffron"])


@query(f"select {_K.format('task_id')} as task_id from accepted_task_ids where {_K.format('task_id')} is not null intersect select {_K.format('task_id')} from accepted_fingerprints")
def accepted_and_listed(spark: SparkSession, sf: str) -> DataFrame:
    own = table(spark, sf, "accepted_task_ids").select(clean_key("task_id").alias("task_id")).where("task_id is not null")
    return own.intersect(table(spark, sf, "accepted_fingerprints").select(clean_key("task_id").alias("task_id")))


@query(f"select {_K.format('task_id')} as task_id from prompts where {_K.format('task_id')} is not null union select {_K.format('task_id')} from accepted_fingerprints where {_K.format('task_id')} is not null")
def known_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of all records and of all accepted rows, once each."""
    ids = [table(spark, sf, t).select(clean_key("task_id").alias("task_id")) for t in ("prompts", "accepted_fingerprints")]
    return ids[0].unionByName(ids[1]).where("task_id is not null").distinct()


@query(f"select {_K.format('task_id')} as task_id from accepted_task_ids where {_K.format('task_id')} is not null except select {_K.format('task_id')} from accepted_fingerprints")
def listed_only(spark: SparkSession, sf: str) -> DataFrame:
    own = table(spark, sf, "accepted_task_ids").select(clean_key("task_id").alias("task_id")).where("task_id is not null")
    return own.exceptAll(own.limit(0)).distinct().subtract(table(spark, sf, "accepted_fingerprints").select(clean_key("task_id").alias("task_id")))


def _leaves(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("hash"))
    return merkle.dense_positions(rows, "doc_id", ["hash"])


@query("""with l as (select row_number() over (order by doc_id) - 1 pos, sha256(coalesce(text, '')) h from documents), p as (select pos // 2 pos, max(case when pos % 2 = 0 then h end) a, max(case when pos % 2 = 1 then h end) b from l group by 1)
select pos, sha256(unhex(a || coalesce(b, a))) as hash from p""")
def merkle_level(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.level(_leaves(spark, sf))


@query("""with recursive l as (select row_number() over (order by doc_id) - 1 pos, sha256(coalesce(text, '')) h from documents),
t as (select 0 lv, list(h order by pos) hs from l union all
      select lv + 1, list_transform(range(1, len(hs) + 1, 2), lambda i: sha256(unhex(hs[i] || coalesce(hs[i + 1], hs[i])))) from t where len(hs) > 1)
select hs[1] as root, (select count(*) from l) as n_leaves from t where len(hs) = 1""")
def merkle_root(spark: SparkSession, sf: str) -> DataFrame:
    leaves = _leaves(spark, sf)
    return spark.createDataFrame([(merkle.merkle_root(leaves), leaves.count())], "root string, n_leaves long")


_LEAF = "sha256('{' || " + " || ',' || ".join(f"'\"{c}\":' || coalesce(to_json({c})::varchar, 'null')" for c in sorted(("prompt", "response", "provider", "model", "system", "gateway", "response_sha256"))) + " || '}')"


@query(f"select traj_id, {_LEAF} as leaf, {_LEAF} as canonical_leaf from trajectories")
def leaf_hashes(spark: SparkSession, sf: str) -> DataFrame:
    """Content hash of every trajectory over its fields, and over their canonical JSON."""
    columns = ["prompt", "response", "provider", "model", "system", "gateway", "response_sha256"]
    rows = table(spark, sf, "trajectories")
    return rows.select("traj_id", struct_hash(*columns).alias("leaf"), canonical_hash(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).alias("canonical_leaf"))


@query("select traj_id, sha256(concat_ws('|', 'run-1', coalesce(task_id, ''), coalesce(model, ''))) as seed from trajectories")
def derived_seeds(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "trajectories").select("traj_id", joined_hash(F.lit("run-1"), F.col("task_id"), F.col("model")).alias("seed"))


def _codes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "trajectories").where(~is_blank(F.col("response"))).select("traj_id", X.code_blocks(F.col("response")).alias("code"))


@query()
def code_structures(spark: SparkSession, sf: str) -> DataFrame:
    return _codes(spark, sf).select("traj_id", C.analysis(F.col("code")).alias("a")).select("traj_id", "a.structure", "a.parses")


@query()
def code_cheats(spark: SparkSession, sf: str) -> DataFrame:
    return _codes(spark, sf).select("traj_id", F.explode(C.cheats(F.col("code"))).alias("issue"))


@query()
def code_mutations(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "eval_items").where("ground_truth_code is not null")
    out = rows.select("item_id", F.explode(C.mutations(F.col("ground_truth_code"))).alias("m"))
    return out.select("item_id", "m.mutation", "m.code", "m.reason")


@query("""select traj_id, unnest(list_filter([case when contains(c, 'tl.make_block_ptr') then 'deprecated tl.make_block_ptr' end, case when contains(c, 'tl.advance') then 'deprecated tl.advance' end,
case when not contains(c, '@triton.jit') then 'missing @triton.jit' end, case when not contains(c, 'tl.program_id') then 'missing tl.program_id' end], lambda i: i is not null)) as issue
from (select traj_id, """ + _CODE.format("response") + f" c from trajectories where not {_BLANK.format('response')})")
def api_issues(spark: SparkSession, sf: str) -> DataFrame:
    return gate.exploded(_codes(spark, sf), "traj_id", C.api_issues(F.col("code")))


@query("select traj_id, ((case when contains(response, '@triton.autotune') then 1.0::double else 0 end) + (case when regexp_matches(response, 'BLOCK_[MNK]\\s*[=:]\\s*\\d+') then 1 else 0 end) + (case when contains(response, 'grid') then 1 else 0 end) + (case when regexp_matches(lower(response), 'blackwell|sm_?120') then 1 else 0 end)) / 4 as score from trajectories where response is not null")
def structure_scores(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "trajectories").where("response is not null").select("traj_id", C.structure_score(F.col("response")).alias("score"))
