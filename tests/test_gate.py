from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quern.functions import code as C
from quern.functions import text as X
from quern.operators import bundle, novelty, release, templates, validation
from quern.operators import contamination as D

KERNEL = "import triton\nimport triton.language as tl\n\n@triton.jit\ndef add(x, n: tl.constexpr):\n    a = tl.load(x, mask=x < n, other=0.0)\n    tl.store(x, a + 1, mask=x < n)\n"
ROW = "row_idx long, task_id string, prompt string, task_prompt string, response string, task_family string, category string, target_api string, torch_reference string, dtype string, shape_class string, layout string, origin string, source string, split string, gpu_architecture string, passed boolean, tier string"
NAMES = [f.split()[0] for f in ROW.split(", ")]


def rows_of(spark, *data):
    return spark.createDataFrame([tuple(d.get(n) for n in NAMES) for d in data], ROW)


def fenced(code):
    return f"Here it is.\n```python\n{code}```\n"


def items(spark):
    data = [("Write a Softmax", KERNEL, "softmax", None), (None, " ", None, "norm"), ("  ", None, "softmax", None)]
    return spark.createDataFrame(data, "prompt string, ground_truth_code string, task_family string, category string")


def test_structure_keeps_annotations_of_arguments():
    assert C.structure_hash("def f(x: int): return x") != C.structure_hash("def f(x: str): return x")
    assert C.structure_hash("def f(x: int): return x") == C.structure_hash("def g(y: int): return y")
    assert C.structure_hash("y = 1") == C.structure_hash("z = 1") != C.structure_hash("z = 2")
    assert C.structure_hash("tl.load(p)") != C.structure_hash("torch.load(p)")


def test_task_hash_tells_nulls_values_and_fields_apart(spark):
    base = {"task_family": "f", "target_api": "a"}
    others = [{**base, "dtype": "~"}, {**base, "layout": "l"}, {"task_family": "f", "torch_reference": "a"}, {**base, "gpu_architecture": "hopper"}, {"task_family": "f|1:a"}, base]
    same = [{**base, "gpu_architecture": " Blackwell "}, {"category": "f", "task_family": "", "target_api": "a"}]
    rows = rows_of(spark, *others, *same)
    got = [r.h for r in rows.select(D.task_hash(rows).alias("h")).collect()]
    assert len(set(got[:6])) == 6 and set(got[6:]) == {got[5]}


def test_item_keys_and_hits(spark):
    keys = D.item_keys(items(spark))
    assert {r.kind: r.n_keys for r in D.key_counts(keys).collect()} == {"prompt": 1, "task": 2, "structure": 1}
    renamed = KERNEL.replace("def add", "def plus").replace("a = ", "b = ").replace("a + 1", "b + 1")
    data = [
        {"row_idx": 0, "prompt": "x", "task_prompt": " write a\nSOFTMAX ", "response": fenced("y = 1\n")},
        {"row_idx": 1, "task_family": "softmax", "response": fenced(renamed)},
        {"row_idx": 2, "category": "norm", "response": " "},
        {"row_idx": 3, "prompt": "write a softmax", "task_prompt": "other", "response": fenced("z = 2\n"), "origin": "yaml"},
        {"row_idx": 4, "prompt": "new", "task_family": "q", "response": fenced("z = 3\n"), "split": "test"},
        {"row_idx": 5, "prompt": "new", "task_family": "q", "response": fenced("z = 3\n"), "split": "train"},
        {"row_idx": 6},
    ]
    rows = D.row_fingerprints(rows_of(spark, *data))
    got = {r.row_idx: (r.prompt_hit, r.task_hit, r.code_hit) for r in D.code_hits(D.task_hits(rows, keys), keys).collect()}
    assert got == {0: (True, False, False), 1: (False, True, True), 2: (False, True, True), 3: (False, False, False), 4: (False, False, False), 5: (False, False, False), 6: (False, False, True)}
    kept = D.decontaminated(rows, keys, F.col("origin"), F.col("split"))
    assert [r.row_idx for r in kept.collect()] == [5]
    empty = items(spark).limit(0)
    assert D.item_keys(empty, required=False).count() == 0
    with pytest.raises(ValueError):
        D.item_keys(empty)
    with pytest.raises(ValueError):
        D.require_trainable(rows, "row_idx", F.col("origin"), F.col("split"))


def test_novelty_by_four_keys(spark):
    data = [
        {"row_idx": 0, "prompt": "p", "task_family": "f", "response": fenced(KERNEL)},
        {"row_idx": 1, "prompt": "other", "task_family": "g", "response": fenced(KERNEL.replace("a", "a"))},
        {"row_idx": 2, "prompt": "third", "task_family": "f", "response": fenced("x = 5\n")},
        {"row_idx": 3, "prompt": "P ", "task_family": "h", "response": fenced("x = 6\n"), "gpu_architecture": "hopper"},
        {"row_idx": 4, "prompt": "q", "task_family": "i"},
        {"row_idx": 5, "prompt": "known", "task_family": "k"},
    ]
    known = D.novelty_keys(D.row_fingerprints(rows_of(spark, {"prompt": "known", "task_family": "z"})))
    keyed = D.novelty_keys(D.row_fingerprints(rows_of(spark, *data)))
    got = {r.row_idx: r.verdict for r in novelty.novelty(keyed, D.EXACT_KEYS, D.NEAR_KEYS, "row_idx", known).collect()}
    assert got == {0: "novel", 1: "exact", 2: "near", 3: "novel", 4: "novel", 5: "exact"}


def test_release(spark, tmp_path):
    keys = D.item_keys(items(spark))
    good = {"prompt": "a", "task_family": "a", "response": fenced("x = 1\n"), "passed": True, "tier": "gold"}
    data = [{"row_idx": 0, **good}, {"row_idx": 1, **good}, {"row_idx": 2, **good, "passed": None, "tier": "repair"}, {"row_idx": 3, **good, "split": " Held_Out"}]
    data += [{"row_idx": 4, **good, "category": "the key sk-" + "a" * 20}, {"row_idx": 5, **good, "response": fenced(KERNEL), "tier": "silver"}]
    rows = D.row_fingerprints(rows_of(spark, *data))
    out = release.release(rows, keys, "row_idx", folder=f"file://{tmp_path}/gate", version="v7")
    assert {(r.row_idx, r.issue) for r in out["issues"].collect()} == {(2, "not passed"), (3, "reserved split"), (4, "api key"), (5, "code of an evaluation item, or none")}
    facts = out["manifest"].first()
    assert (facts.rows_total, facts.blocked_rows, facts.gold_rows, facts.silver_rows, facts.repair_rows, facts.passed) == (6, 4, 4, 1, 1, False)
    report = out["novelty"].first()
    assert (report.verified_rows, report.exact_rows, report.novel_rows) == (2, 1, 1)  # blocked rows are not judged
    written = json.loads((tmp_path / "gate/manifest.json").read_text())
    assert written["dataset_version"] == "v7" and written["novelty"]["novel_rows"] == 1
    assert spark.read.json(f"file://{tmp_path}/gate/blocked").count() == 4
    with pytest.raises(ValueError, match="4 rows are blocked"):
        release.release(rows, keys, "row_idx", strict=True)
    with pytest.raises(ValueError, match="not verified"):
        release.release(rows, keys, "row_idx", problems=spark.createDataFrame([("c", 1, "bad")], "check string, row long, issue string"))
    empty = release.release(rows.limit(0), keys, "row_idx", strict=True)
    assert empty["manifest"].first().passed and empty["issues"].count() == 0


def test_cascade_and_stages(spark):
    ok = KERNEL + "\ndef launch(x):\n    i = tl.program_id(0)\n    add[(1,)](x, 3)\n"
    data = [("a", fenced("def ("), True), ("b", fenced("x = 1\n"), True), ("c", fenced(ok + "    torch.matmul(x, x)\n"), True), ("d", fenced(ok), False), ("e", fenced(ok), None), ("f", fenced(ok), True), ("g", None, True)]
    rows = spark.createDataFrame(data, "k string, response string, ran boolean")
    strict = {r.k: r.fail_reason for r in validation.cascade(rows, "response", F.col("ran")).collect()}
    assert strict["a"] == "syntax_error" and strict["b"] == "triton_api" and strict["d"] == strict["e"] == "compile_execute_failed" and strict["f"] is None and strict["g"] == "syntax_error"
    low = {r.k: r.fail_reason for r in validation.cascade(rows, "response", F.col("ran"), composite=F.lit(0.2)).collect()}
    assert low["f"] == "benchmark_below_floor" and low["d"] == "compile_execute_failed"
    stages = spark.createDataFrame([({"syntax": "x"},), ({"ir": None},), (None,)], "s map<string,string>")
    assert validation.any_stage(stages, "s", "syntax") and not validation.any_stage(stages, "s", "ir") and not validation.any_stage(stages, "s", "none")


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_scalars(spark):
    outputs = F.create_map(F.lit("syntax"), F.lit("s" * 2000), F.lit("compile_execute"), F.lit(""))
    got = one(
        spark,
        validation.number(F.lit("2.5")), validation.number(F.lit("x")), validation.number(F.lit(None).cast("string")),
        F.length(validation.output_tail(outputs)), validation.feedback(F.lit(None).cast("string"), F.lit("")),
        validation.pinned(F.lit("m-2025"), "m"), validation.pinned(F.lit("mm"), "m"), validation.logical_model(F.lit("x/m-1"), ["m"]),
        validation.device_architecture(F.lit("GPU H200"), F.lit(9), F.lit(80.0)), validation.device_architecture(F.lit("g"), F.lit(9), F.lit(80.0)), validation.device_architecture(F.lit("g"), F.lit(12), F.lit(1.0)), validation.device_architecture(F.lit("g"), F.lit(8), F.lit(1.0)),
        validation.benchmark_score(F.lit(True)), validation.benchmark_score(F.lit(True), F.lit("0.5")),
        validation.trusted_ms(F.lit(3.0), F.lit("monitored_triton_do_bench")), validation.trusted_ms(F.lit(3.0), F.lit("print")),
    )
    assert tuple(got)[:4] == (2.5, 0.0, 0.0, 1500) and got[4].startswith("Validation failed: unknown.") and "output" not in got[4]
    assert tuple(got)[5:] == (True, False, "m", "hopper_h200", "hopper_h100", "blackwell", None, 1.0, 0.5, 3.0, None)
    assert validation.kinds_of(["api_doc", "mutation", "doc_tutorial"]) == ["api_symbol", "tutorial"]
    chunks = spark.createDataFrame([("a",), ("a",), (None,)], "kind string")
    assert [tuple(r) for r in validation.missing_kinds(chunks, "kind", {"a": 2, "b": 1}).collect()] == [("b", 0, 1)]
    with pytest.raises(ValueError, match="b=0"):
        validation.require_kinds(chunks, "kind", {"a": 2, "b": 1})
    assert validation.require_kinds(chunks, "kind", {"a": 2}) is chunks


def test_texts_of_turns(spark):
    outputs = F.create_map(F.lit("syntax"), F.lit("line 3"))
    got = one(
        spark,
        validation.repair_request(F.lit(fenced("x = 1\n")), F.lit("syntax_error"), outputs),
        validation.optimise_request(F.lit("task"), F.lit("code"), F.lit(1.5), F.lit(None).cast("double")),
        validation.with_captured_error(F.lit("p"), F.lit("debugging"), F.lit("b"), F.lit(False), F.lit("err")),
        validation.with_captured_error(F.lit("p"), F.lit("optimization"), F.lit("b"), F.lit(False), F.lit("err")),
        validation.with_captured_error(F.lit("p"), F.lit("debugging"), F.lit("b"), F.lit(True), F.lit("err")),
    )
    assert "syntax_error" in got[0] and "line 3" in got[0] and "x = 1" in got[0] and "speedup 1.5" in got[1] and "composite" not in got[1]
    assert "err" in got[2] and got[3] == got[4] == "p"


def test_episode_and_flattened(spark):
    turns = F.array(F.struct(F.lit("assistant").alias("role"), F.lit("a").alias("content")), F.struct(F.lit("user").alias("role"), F.lit("b").alias("content")))
    made = validation.episode(F.lit("task"), F.lit(None).cast("string"), F.lit("p"), turns, F.lit(True), F.lit(0), F.lit(True), F.col("id") == 0, F.lit(1.2))
    rows = validation.stamped(spark.range(2).select("id", F.lit("wrapper").alias("prompt"), F.lit("gold").alias("tier"), made.alias("episode")))
    got = {r.id: (r.prompt, r.tier, r.multi_turn, r.episode.attempt_count) for r in rows.collect()}
    assert got == {0: ("task", "optimized", True, 1), 1: ("task", "gold", True, 1)}
    data = [("a", 1.0, None), ("x", None, [("b", 2.0), None, ("c", None)]), ("y", None, [])]
    flat = validation.flattened(spark.createDataFrame(data, "task string, ms double, results array<struct<task:string,ms:double>>"))
    assert {tuple(r) for r in flat.collect()} == {("a", 1.0), ("b", 2.0), ("c", None)}


def test_allowed_models(spark):
    rows = spark.createDataFrame([(1, "p", "m-2"), (2, "p", "n"), (3, "q", "m"), (4, None, "m")], "i int, provider string, model string")
    allowed = spark.createDataFrame([("p", "m"), ("p", "m")], "provider string, model string")
    assert {r.i: r.allowed for r in validation.allowed_models(rows, allowed).collect()} == {1: True, 2: False, 3: False, 4: False}


def test_templates(spark):
    chunks = spark.createDataFrame([("api_symbol", "dot", "Dot", "tl.dot", "c" * 5000, "dot", "Ops"), ("tutorial", "tut_x", "T", None, "d" * 5000, None, None), (None, "sem_y", None, None, "e", "gone", None)], "chunk_kind string, section_id string, title string, target_api string, content string, symbol string, doc_category string")
    short = spark.createDataFrame([("dot", "too short")], "symbol string, page string")
    page = spark.createDataFrame([("dot", "P" * 6000), ("dot", "Q" * 100)], "symbol string, page string")
    rows = templates.with_pages(templates.pages_for(chunks, "symbol", short, page))
    got = {r.task_id: r for r in templates.chunk_prompts(rows, F.lit("D")).collect()}
    assert set(got) == {"doc_dot", "tut_x", "sem_y"}
    assert got["doc_dot"].source == "api_doc" and "Category: Ops" in got["doc_dot"].prompt and got["doc_dot"].prompt.count("P") > 3000
    assert got["tut_x"].source == "doc_tutorial" and got["tut_x"].prompt.count("d" * 2500) == 1 and "d" * 2501 not in got["tut_x"].prompt
    ops = spark.createDataFrame([("Soft", "torch.softmax(x)", {"x": "(M, N)"}, None, "c")], "name string, code string, shapes map<string,string>, task_family string, shape_class string")
    made = {r.task_id: r for r in templates.operation_prompts(ops, F.lit("D"), variants=True).collect()}
    assert set(made) == {"translate_soft", "translate_soft_127_1003_6143", "translate_soft_255_511_1023"} and "M=127" in made["translate_soft_127_1003_6143"].prompt
    done = templates.finished(templates.operation_prompts(ops, F.lit("D")).drop("origin", "split")).first()
    assert done.origin == "torch_op" and done.split == "train" and done.gpu_architecture == "blackwell" and done.shapes == {"x": "(M, N)"} and "blackwell" in done.system
    with pytest.raises(ValueError):
        templates.finished(templates.operation_prompts(ops, F.lit("D")).withColumn("split", F.lit("test")))
    told = {r.category: r for r in templates.templated(spark.createDataFrame([("debugging", " x "), (None, None), ("z", "y")], "category string, prompt string"), F.lit("DEV")).collect()}
    assert told["debugging"].prompt.startswith("Correct") and "DEV" in told["z"].prompt and told[None].prompt_template == "translation:structured-v1"


def test_evaluation_records(spark):
    data = [("f:/a/level2/x.yaml", {"prompt": " p ", "title": "My Op", "category": "debugging", "solution_code": "s"}), ("f:/a/bugfix/y.yaml", {"id": "Z", "prompt": "q", "op": "Soft Max", "ground_truth_code": "", "reference_code": "r"}), ("z.yaml", {"prompt": "q"})]
    got = {r.task_id: r for r in templates.held_out(templates.evaluation_records(spark.createDataFrame(data, "path string, record map<string,string>"))).collect()}
    assert (got["x"].task_family, got["x"].level, got["x"].ground_truth_code, got["x"].prompt) == ("my_op", "2", "s", "p")
    assert (got["Z"].task_family, got["Z"].ground_truth_code, got["Z"].level, got["Z"].category) == ("soft_max", "r", None, "kernel_generation")
    assert got["z"].task_family == "z" and got["z"].split == "eval" and got["z"].origin == "private_eval"


def test_requests_and_rebinding(spark):
    rows = spark.createDataFrame([(1, "wrapper", "s\"é\n", "m"), (2, None, " ", None)], "i int, prompt string, system string, model string").withColumn("request_sha256", F.lit("old"))
    body = bundle.request_body(F.col("model"), F.col("prompt"), F.col("system"), 10, 0.5, "high")
    got = {r.i: r.b for r in rows.select("i", body.alias("b")).collect()}
    want = {"model": "m", "max_tokens": 10, "temperature": 0.5, "reasoning": {"effort": "high"}, "messages": [{"role": "system", "content": "s\"é\n"}, {"role": "user", "content": "wrapper"}]}
    assert got[1] == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(got[2])["messages"] == [{"role": "user", "content": ""}]
    again = {r.i: r for r in bundle.rebound(rows, F.lit("task"), body).collect()}
    want["messages"][1]["content"] = "task"
    assert again[1].request_sha256 == hashlib.sha256(json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    assert again[1].prior_request_sha256 == "old" and again[1].prompt == "task"


def test_bundle_checks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, None, None)], "i long, v string, ok boolean")
    found = bundle.row_checks(rows, "i", ok=F.col("ok"), v=F.col("v") != "b")
    assert {(r.check, r.row) for r in found.collect()} == {("ok", 2), ("ok", 3), ("v", 2), ("v", 3)}
    kept, facts = bundle.proved(rows, "i", ["v"], F.col("ok"), 0.3)
    assert kept.count() == 1 and facts["sample_count"] == 1 and facts["raw_sample_count"] == 3
    assert bundle.fact_checks(spark, facts, dict(facts)).isEmpty() and bundle.fact_checks(spark, facts, facts | {"merkle_root": "x"}).count() == 1
    with pytest.raises(ValueError):
        bundle.proved(rows, "i", ["v"], F.col("ok"), 0.5)
    with pytest.raises(ValueError):
        bundle.proved(rows.limit(0), "i", ["v"], F.col("ok"))
    (tmp_path / "rows").mkdir()
    lost = bundle.missing_artefacts(spark, f"file://{tmp_path}", ("rows", "manifest.json"))
    assert [r.issue for r in lost.collect()] == ["missing manifest.json"]
    other = bundle.inconsistent(rows, spark.createDataFrame([(9, None), (8, "zz")], "i long, v string"), ["v"], "i")
    assert [r.row for r in other.collect()] == [8]
    issues, ok = bundle.verified(found, lost, other)
    assert not ok and issues.count() == 6 and bundle.verified(found.limit(0))[1]


def test_page_with_entities_and_nesting(spark):
    page = "<HEADER a='1'>top</header><p>a &lt;b&gt; &amp;lt; &#65;&#x42; &nope; &</p>\n\n\n<div>x   y</div><br/>z<!-- <p>no</p> --><script>if (a < b) {}</script> 1 < 2 &eacute;"
    got = spark.createDataFrame([(page,), (None,), ("",), ("plain",)], "v string").select(X.html_to_text(F.col("v")).alias("t")).collect()
    assert got[0].t == "a <b> &lt; AB &nope; &\n\n x y\n\nz 1 < 2 é" and [r.t for r in got[1:]] == [None, "", "plain"]


def test_chosen_mutation(spark):
    code = KERNEL + "\n@triton.autotune(configs=[], key=[])\ndef k(x):\n    return tl.zeros((1,), dtype=tl.float32).to(tl.float32)\n"
    rows = spark.createDataFrame([(str(i), code) for i in range(30)] + [("n", "x = 1"), ("z", None)], "k string, c string")
    got = {r.k: r.m for r in rows.select("k", C.chosen_mutation(F.col("k"), C.mutations(F.col("c"))).alias("m")).collect()}
    assert got["n"] is None and got["z"] is None and {got[str(i)].mutation for i in range(30)} == set(C.MUTATIONS)
    names = list(C.MUTATIONS)
    for i in range(30):
        assert got[str(i)].mutation == names[int(hashlib.sha256(str(i).encode()).hexdigest()[:12], 16) % 3]
    only = KERNEL  # masks only: whatever the hash asks for, that one
    assert C.mutate(only)[0]["mutation"] == "boundary_mask" and len(C.mutate(only)) == 1 and "mask" not in C.mutate(only)[0]["code"]


def test_build_of_a_prompt_file(spark, tmp_path):
    from quern.plans.build import build_prompts, lineage_splits, ordered_splits, run_seed

    cols = "task_id string, prompt string, origin string, task_family string, category string, parent_id string, split string"
    doc = spark.createDataFrame([(f"d{i}", f"p{i}", "api_doc", f"f{i % 7}", "c", None, None) for i in range(40)], cols)
    mined = spark.createDataFrame([(f"m{i}", f"q{i}", "mined", None, "c", f"d{i}", "held_out" if i == 0 else None) for i in range(20)], cols)
    seed = run_seed()
    assert len(seed) == 64 and seed != run_seed()
    facts = build_prompts({"mined": mined, "doc": doc}, f"file://{tmp_path}/a", seed, limit=30)
    again = build_prompts({"doc": doc.orderBy(F.desc("task_id")), "mined": mined}, f"file://{tmp_path}/b", seed, limit=30)
    other = build_prompts({"doc": doc, "mined": mined}, f"file://{tmp_path}/c", "another", limit=30)
    assert facts == again and facts["rows"] == 30 and other["sampling_seed"] != facts["sampling_seed"] and other["catalogue_sha256"] == facts["catalogue_sha256"]
    rows = {p: {r.task_id for r in spark.read.json(f"file://{tmp_path}/{p}/prompts").collect()} for p in "abc"}
    assert rows["a"] == rows["b"] != rows["c"]
    assert json.loads((tmp_path / "a/manifest.json").read_text())["by_part"] == facts["by_part"]
    assert build_prompts({"doc": doc}, f"file://{tmp_path}/d", seed, limit=99)["rows"] == 40
    with pytest.raises(ValueError):
        build_prompts({"none": doc}, f"file://{tmp_path}/e", seed)
    whole = doc.unionByName(mined)
    got = {r.task_id: r for r in lineage_splits(whole).collect()}
    assert got["m0"].split == got["d0"].split == got["d7"].split == got["m7"].split == "held_out"  # m0 and d0 by the parent, d7 by the family
    assert got["d1"].split_group == got["m1"].split_group == got["d8"].split_group != got["d2"].split_group
    order = [r.first_task_id for r in ordered_splits(lineage_splits(whole)).collect()]
    assert order == sorted(order)
    clash = spark.createDataFrame([("a", "p", "o", "f", "c", None, "eval"), ("b", "p", "o", "f", "c", None, "held_out")], cols)
    assert all(r.conflict for r in lineage_splits(clash).collect())
    with pytest.raises(ValueError):
        lineage_splits(clash, strict=True)


def test_functions_in_sql(spark):
    from quern.functions.sql import register

    assert "code_structure" in register(spark, {"length_of": (len, "int")})
    got = spark.sql("select code_parses('x = 1') a, code_parses('def (') b, code_parses(cast(null as string)) c, code_structure('x = 1') = code_structure('y = 1') d, canonical_json('{\"b\": 1, \"a\": 2}') e, length_of('abc') f").first()
    assert tuple(got) == (True, False, None, True, '{"a":2,"b":1}', 3)
