from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quern.functions import code as C
from quern.functions import text as X
from quern.functions.canonical import canonical, canonical_hash
from quern.functions.keys import clean_key, first_filled
from quern.operators import chat, derive, gate, lineage_split, merkle, novelty, ranking, sampling, sections, summary, verify

KERNEL = '''import torch
import triton
import triton.language as tl

@triton.autotune(configs=[], key=["n"])
@triton.jit
def add(x, y, n, BLOCK: tl.constexpr):
    i = tl.program_id(0) * BLOCK + tl.arange(0, BLOCK)
    a = tl.load(x + i, mask=i < n, other=0.0).to(tl.float32)
    s = tl.zeros((BLOCK,), dtype=tl.float32)
    tl.store(y + i, a + s, mask=i < n)

def launch(x, y):
    add[(1,)](x, y, x.numel(), BLOCK=64)
'''


def column(spark, values, c, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(c).collect()]


def test_keys_and_fallback(spark):
    assert column(spark, [" A\t", " ", "", None], clean_key("v")) == ["a", None, None, None]
    assert column(spark, ["", None, "x"], first_filled(F.col("v"), F.lit(""), F.lit("d"))) == ["d", "d", "x"]


def test_text_fingerprint_like_python(spark):
    texts = ["  A  b\n\nC ", "", "é É", "x" * 100_000, None]
    want = [None if t is None else hashlib.sha256(re.sub(r"\s+", " ", t.strip().lower()).encode()).hexdigest() for t in texts]
    assert column(spark, texts, X.text_fingerprint(F.col("v"))) == want


def test_slug_and_identifiers(spark):
    assert column(spark, ["Hello, World!", "--", None, "A" * 70], X.slug(F.col("v"))) == ["hello_world", "section", "section", "a" * 64]
    assert column(spark, ["f(M, N_1, M)"], X.identifiers(F.col("v"))) == [["f", "M", "N_1"]]


def test_code_blocks(spark):
    got = column(spark, ["t\n```python\na\n```\n```python\nb\n```", "```\nc\n```", "plain", None], X.code_blocks(F.col("v")))
    assert got == ["a\n\n\nb\n", "c\n", "plain", None]


def test_html(spark):
    html = "<html><head><style>x{}</style></head><body><!-- c --><p>A &amp; B</p><br/>c<ul><li>d</li></ul><script>1</script></body>"
    text = column(spark, [html, None, ""], X.html_to_text(F.col("v")))
    assert re.sub(r"\s+", " ", text[0]).strip() == "A & B c d" and text[1] is None and text[2] == ""


def test_reasoning(spark):
    parts = '[{"type":"reasoning.text","text":" because the mask is needed here "},{"type":"reasoning.encrypted","text":"zz"},{"type":"reasoning.summary","summary":"short sum"}]'
    got = column(spark, [parts, "  ", "too shor", "short", '{"a": 1}', None], X.plain_reasoning(F.col("v")))
    assert got == ["because the mask is needed here\n\nshort sum", None, "too shor", None, None, None]


def test_structures():
    renamed = KERNEL.replace("def add", "def plus").replace("add[", "plus[").replace("a +", "q +").replace("a =", "q =")
    assert C.structure_hash(KERNEL) == C.structure_hash(renamed) != C.structure_hash(KERNEL.replace("a + s", "a * s"))
    assert C.structure_hash("def (").startswith("unparsed:")


@pytest.mark.parametrize(
    "code, part",
    [
        ("def (", "does not parse"),
        ("x = 1", "no kernel"),
        (KERNEL.split("def launch")[0], "no kernel launch"),
        (KERNEL + "    return torch.matmul(x, y)\n", "launch: fallback torch.matmul"),
        (KERNEL + "    return helper(x)\n\ndef helper(x):\n    return torch.softmax(x, 0)\n", "helper: fallback torch.softmax"),
        (KERNEL + "    try:\n        pass\n    except Exception:\n        pass\n", "launch: try block"),
        (KERNEL + "triton.testing.do_bench = None\n", "reassigns do_bench"),
        (KERNEL + "with torch.cuda.stream(s):\n    pass\n", "stream: torch.cuda.stream"),
    ],
)
def test_cheats(code, part):
    assert part in C.cheat_issues(code)


def test_no_cheat_and_self_test_allowed():
    assert C.cheat_issues(KERNEL + "\nprint(torch.matmul(a, b))\n") == []


def test_mutations_and_seed():
    got = {m["mutation"]: m["code"] for m in C.mutate(KERNEL)}
    assert set(got) == {"boundary_mask", "accumulator_precision", "tuning"}
    assert "mask=" not in got["boundary_mask"] and "float32" not in got["accumulator_precision"] and "autotune" not in got["tuning"]
    assert C.mutate("x = 1") == [] and C.mutate("def (") == []
    assert C.with_seed("torch.manual_seed(3)") == "torch.manual_seed(_external_seed)\n" and C.with_seed("def (") is None


def test_code_columns_with_nulls(spark):
    assert column(spark, [KERNEL, "def (", None], C.syntax_ok(F.col("v"))) == [True, False, None]
    assert column(spark, [None, "x = 1"], C.cheats(F.col("v"))) == [None, ["no kernel"]]


def test_canonical(spark):
    assert canonical('{"b": 1, "a": "é"}') == '{"a":"é","b":1}' and canonical("{") is None and canonical(None) is None
    want = hashlib.sha256(b'{"a":2,"b":1}').hexdigest()
    assert column(spark, ['{"b":1,"a":2}', None], canonical_hash(F.col("v"))) == [want, None]


def test_novelty_against_fold(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "e1", "e2", "e3", "e4"]), rng.choice([None, "n1", "n2"])) for i in range(40)]
    known = [(0, "e4", "n9")]
    exact, near, want = {"e4"}, {"n9"}, {}
    for i, e, n in rows:
        want[i] = "exact" if e in exact else "near" if n in near else "novel"
        exact |= {e} - {None}
        near |= {n} - {None}
    df = spark.createDataFrame(rows, "i long, e string, n string")
    got = novelty.novelty(df, ["e"], ["n"], "i", spark.createDataFrame(known, "i long, e string, n string"))
    assert {r.i: r.verdict for r in got.collect()} == want
    assert novelty.novelty(df.limit(0), ["e"], ["n"], "i").count() == 0


def test_first_of_each_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "i long, k string")
    assert sorted(r.i for r in novelty.first_of_each(df, "k", "i").collect()) == [1, 3, 4]


def test_secrets(spark):
    got = column(spark, ["mask-based task-level", "sk-" + "a" * 20, "see /home/me/x", None], gate.secrets(F.col("v")))
    assert got == [[], ["api key"], ["home path"], []]


def sample_rows(spark):
    rows = [(f"a{i}", "api", f"f{i % 4}") for i in range(20)] + [(f"m{i}", "mut", f"f{i % 6}") for i in range(15)] + [(f"t{i}", "op", f"f{i}") for i in range(17)]
    return spark.createDataFrame(rows, "id string, s string, f string")


def test_sample_covers_caps_and_replays(spark):
    rows = sample_rows(spark)
    once = [tuple(r) for r in sampling.stratified_sample(rows, "s", "f", "id", 12, "x").collect()]
    assert once == [tuple(r) for r in sampling.stratified_sample(rows, "s", "f", "id", 12, "x").collect()] and len(set(once)) == 12
    by = {s: sum(r[1] == s for r in once) for s in ("api", "mut", "op")}
    assert all(by.values()) and len({r[2] for r in once if r[1] == "api"}) == min(4, by["api"])
    assert {r[0] for r in once} != {r[0] for r in sampling.stratified_sample(rows, "s", "f", "id", 12, "y").collect()}
    capped = sampling.stratified_sample(rows, "s", "f", "id", 20, "x", 0.5).collect()
    assert max(sum(r.s == s for r in capped) for s in by) <= 10
    assert sampling.stratified_sample(rows, "s", "f", "id", 50, "x", 0.1).count() == 50  # the cap gives way
    assert sampling.stratified_sample(rows, "s", "f", "id", 0, "x").count() == 0


def test_catalogue_hash_ignores_order(spark):
    a = spark.createDataFrame([("1", "x"), ("2", None)], "i string, p string")
    b = spark.createDataFrame([("2", None), ("1", "x")], "i string, p string")
    assert sampling.catalogue_hash(a, "i", "p").collect() == sampling.catalogue_hash(b, "i", "p").collect() != sampling.catalogue_hash(a.limit(1), "i", "p").collect()


def test_components_and_lineage_split(spark):
    links = spark.createDataFrame([(f"r{i}", f"k{i // 2}") for i in range(20)] + [("r3", "k5"), ("r1", "k1")], "row string, key string")
    got = {r.row: r.component for r in lineage_split.components(links).collect()}
    assert got["r0"] == got["r1"] == got["r2"] == got["r3"] == got["r10"] == got["r11"] == "r0" and got["r4"] == "r4"
    rows = spark.createDataFrame([("a", "g", None), ("b", "g", "eval"), ("c", "h", None), ("d", "k", "eval"), ("e", "k", "held_out")], "id string, g string, res string")
    out = {r.id: r for r in lineage_split.assign_by_lineage(rows, "id", "g", "res").collect()}
    assert out["a"].split == out["b"].split == "eval" and out["c"].split in ("train", "dev") and out["d"].conflict and not out["a"].conflict


def test_preference_pairs(spark):
    rows = spark.createDataFrame([("t", 1, 8.0, "a"), ("t", 2, 10.0, "b"), ("t", 3, None, "c"), ("t", 4, 0.0, "d"), ("t", 5, 8.1, "e"), ("u", 6, 5.0, "f"), ("v", 7, 5.0, "g"), ("v", 8, 7.0, " ")], "g string, k long, ms double, r string")
    got = [(r.g, r.winner, r.loser, round(r.speedup, 3)) for r in ranking.preference_pairs(rows, "g", "k", "ms", "r").collect()]
    assert got == [("t", 1, 2, 0.2)]
    assert ranking.preference_pairs(rows, "g", "k", "ms", "r", 0.5).count() == 0


def test_timing_summary(spark):
    values = [5.0, 1.0, 4.0, 2.0, 2.0]
    r = ranking.timing_summary(spark.createDataFrame([("a", v) for v in values] + [("b", None)], "g string, ms double"), "g", "ms").collect()
    assert [tuple(x) for x in r] == [("a", 5, 2.0, sorted(values)[int(0.95 * 4)], 1.0, 5.0)]


def test_score_and_tier(spark):
    df = spark.createDataFrame([(True, False, 0, 0.6), (True, False, 0, None), (True, False, 1, 0.9), (True, True, 1, 0.1), (None, True, 0, 1.0)], "p boolean, i boolean, r int, c double")
    assert [r[0] for r in df.select(ranking.tier(*[F.col(c) for c in "pirc"])).collect()] == ["gold", "silver", "repair", "optimized", "reject"]
    assert df.select(ranking.score(F.lit(1.0), F.lit(1.0), F.lit(None).cast("double"), F.lit(100))).first()[0] == 109.0


def test_pass_rates_and_report(spark):
    df = spark.createDataFrame([("a", None, True), ("a", "x", None), ("", "x", False)], "s string, c string, p boolean")
    rows = [tuple(r) for r in summary.pass_rates(df, ["s", "c"], F.col("p")).collect()]
    assert ("all", "all", 3, 1, 1 / 3) in rows and ("s", "unknown", 1, 0, 0.0) in rows and ("c", "x", 2, 0, 0.0) in rows
    assert "total: 1/3 (33.3%)" in summary.format_report("t", [r[:4] for r in rows])


def root(leaves):
    if not leaves:
        return merkle.EMPTY
    while len(leaves) > 1:
        leaves = [merkle.parent(leaves[i], leaves[min(i + 1, len(leaves) - 1)]) for i in range(0, len(leaves), 2)]
    return leaves[0]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 33, 4097, 9000])
def test_merkle_root(spark, n):
    leaves = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
    df = spark.createDataFrame(list(enumerate(leaves)), "pos long, hash string")
    assert merkle.merkle_root(df) == root(leaves)


def test_dense_positions(spark):
    df = spark.range(0, 1000, 3).repartition(7).select("id", (F.col("id") * 2).alias("v"))
    got = merkle.dense_positions(df, "id", ["v"]).orderBy("pos").collect()
    assert [(r.pos, r.id, r.v) for r in got] == [(i, 3 * i, 6 * i) for i in range(334)]


def test_verify(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "i long, s string")
    b = spark.createDataFrame([(1, None), (3, "y")], "i long, s string")
    assert sorted((r.i, r.side) for r in verify.both_ways(a, b, ["i", "s"]).collect()) == [(2, "left"), (3, "right")]
    with pytest.raises(ValueError):
        verify.unique_or_raise(a, "i")
    with pytest.raises(ValueError):
        verify.zipped(a, b, "i")
    reports = spark.createDataFrame([(0,), (9,)], "at long")
    assert [r.found for r in verify.positional(reports, "at", spark.createDataFrame([(0, "r")], "p long, c string"), "p", ["c"]).orderBy("at").collect()] == [True, False]


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, t string")


def test_sections(spark):
    long = "word " * 30
    md = f"intro {long}\n## One\n{long}\n### Two\nshort\n## Three\n{long}"
    assert [(r.section, r.title.split()[0]) for r in sections.markdown_sections(docs(spark, md, None), "id", "t").orderBy("section").collect()] == [(0, "intro"), (1, "##"), (3, "##")]
    rst = f"Title A\n=======\n{long}\n\nB\n---\ntiny\n\nC c\n-----\n{long}\nend"
    got = sections.underlined_sections(docs(spark, rst, "", None), "id", "t").orderBy("title").collect()
    assert [(r.section_id, r.title, r.content) for r in got] == [("sem_c_c", "C c", long + "\nend"), ("sem_title_a", "Title A", long.strip())]


def test_symbols_cells_and_directives(spark):
    rst = "Math\n----\n\n.. autosummary::\n    :toctree: gen\n\n    exp\n    log\n\nText exp\nOther\n-----\n.. autosummary::\n    exp\n    max\n    Bad-name\n"
    got = sections.listed_symbols(docs(spark, rst), "id", "t").orderBy("symbol").collect()
    assert [(r.symbol, r.category) for r in got] == [("exp", "Math"), ("log", "Math"), ("max", "Other")]
    line = "# " + "prose " * 10
    tut = f'"""Intro {"x" * 90}\nmore"""\n# %%\n# == Head ==\n{line}\n{line}\ncode()\n# after\n# %%\n# short\n'
    cells = sections.tutorial_cells(docs(spark, tut), "id", "t").orderBy("cell").collect()
    assert [(r.cell, r.title[:5]) for r in cells] == [(0, "Intro"), (1, "Head")] and "after" not in cells[1].content
    page = ".. currentmodule:: x\n.. autofunction::\n   :opt: 1\n\nKept line\n\n\n\nEnd"
    assert column(spark, [page], sections.without_directives(F.col("v"))) == ["Kept line\n\nEnd"]


def test_chat(spark):
    df = spark.createDataFrame([(1, "p", "r", " ", [("user", "u"), ("tool", "z"), ("assistant", "a"), ("user", " ")]), (2, "p", "r", "s", None)], "i long, p string, r string, s string, t array<struct<role:string,content:string>>")
    rows = chat.chat_rows(df, "i", chat.messages(F.col("p"), F.col("r"), F.col("s"), F.col("t"))).orderBy("i", "position").collect()
    assert [(r.i, r.role, r.content) for r in rows] == [(1, "user", "u"), (1, "assistant", "a"), (2, "system", "s"), (2, "user", "p"), (2, "assistant", "r")]
    assert [r[0] for r in df.select(chat.assistant_turns(F.col("t"))).collect()] == [1, 0]


def test_derive(spark):
    df = spark.createDataFrame([("k", "mask", "softmax"), ("l", "odd", None)], "id string, c string, f string")
    out = derive.mined_tasks(df, "id", "c", F.col("f"), {"compile": "C {op}", "mask": "M {op}"}).orderBy("task_id").collect()
    assert [(r.task_id, r.prompt) for r in out] == [("mined_k_mask_0", "M softmax"), ("mined_k_mask_1", "M softmax Shape variant 2."), ("mined_l_odd_0", "C kernel"), ("mined_l_odd_1", "C kernel Shape variant 2.")]
    ev = derive.evolved_tasks(df, "id", "c", {"a": "A", "b": "B", "d": "D"}, 2, "s").collect()
    assert len(ev) == 4 and len({r.task_id for r in ev}) == 4 and derive.evolved_tasks(df, "id", "c", {"a": "A"}, 0, "s").count() == 0
    other = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new")], "id string, n int, f string")
    assert {r.id: r.f for r in derive.filled_from(df.withColumn("f", F.lit("")), other, "id", ["f"], "n").collect()} == {"k": "new", "l": None}
    klass = derive.failure_class(F.lit(False), F.lit("compile error"), F.col("v"))
    assert column(spark, ["out of BOUNDS", "bad stride", "dtype", "x", None], klass) == ["mask", "stride", "dtype", "compile", "compile"]
