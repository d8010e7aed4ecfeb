from __future__ import annotations

import random

from quern.operators.current import current_records
from quern.operators.hierarchy import descendants, resolve_hierarchy


def brute(parents: dict[str, str | None]) -> dict[str, tuple[str, int]]:
    out = {}
    for start in parents:
        x, seen = start, []
        while x not in seen and parents.get(x) in parents:
            seen.append(x)
            x = parents[x]
        if x in seen:
            cycle = seen[seen.index(x) :]
            out[start] = (min(cycle), -1)
        else:
            out[start] = (x, len(seen))
    return out


def resolved(spark, parents, **kw):
    return resolve_hierarchy(spark.createDataFrame(list(parents.items()), "node string, parent string"), **kw)


def test_random_forests_with_cycles(spark):
    rng = random.Random(5)
    names = [f"n{i:03d}" for i in range(120)]
    parents = {n: rng.choice([None, "absent", *names, *names, *names]) for n in names}
    got = {r.node: (r.root, r.depth) for r in resolved(spark, parents).collect()}
    assert got == brute(parents)


def test_deep_chain_paths_and_descendants(spark):
    chain = {f"c{i:04d}": f"c{i - 1:04d}" if i else None for i in range(200)}
    out = resolved(spark.sparkContext and spark, chain, with_path=True)
    rows = {r.node: r for r in out.collect()}
    assert rows["c0199"].depth == 199 and rows["c0199"].root == "c0000"
    assert rows["c0199"].path == sorted(chain)
    assert descendants(out).count() == 199 * 200 // 2


def test_star_self_loop_and_cycle_tail(spark):
    parents = {"hub": None} | {f"x{i}": "hub" for i in range(50)} | {"me": "me", "a": "b", "b": "c", "c": "a", "t": "a", "u": "t"}
    got = {r.node: (r.root, r.depth, r.linked) for r in resolved(spark, parents).collect()}
    assert got["hub"] == ("hub", 0, False) and got["x7"] == ("hub", 1, True)
    assert got["me"] == ("me", -1, True) and got["u"] == ("a", -1, True) and got["b"] == ("a", -1, True)


def test_cyclic_nodes_have_no_path_and_no_descendants(spark):
    out = resolved(spark, {"a": "b", "b": "a", "r": None, "s": "r"}, with_path=True)
    assert {r.node: r.path for r in out.collect()} == {"a": None, "b": None, "r": ["r"], "s": ["r", "s"]}
    assert [tuple(r) for r in descendants(out).collect()] == [("r", "s", 1)]


def test_empty(spark):
    assert resolve_hierarchy(spark.createDataFrame([], "node string, parent string")).count() == 0


def test_current_records_clean_ties_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, " A ", "x", "p"), (2, "a", None, "q"), (3, "\t", "z", "r"), (4, None, "z", "s")], "row_idx long, task_id string, parent_id string, _k string")
    got = current_records(df, "task_id", "row_idx", ["parent_id"]).collect()
    assert [tuple(r) for r in got] == [("a", 2, None)]
