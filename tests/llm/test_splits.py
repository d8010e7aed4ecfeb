from __future__ import annotations

import random

import pytest

from quern.llm.splits import assign_splits, hash_to_min, record_groups


def union(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    low = {}
    for x in up:
        low[find(x)] = min(low.get(find(x), x), x)
    return {x: low[find(x)] for x in up}


@pytest.mark.parametrize("n, m", [(60, 30), (200, 190), (40, 200)])
def test_components_like_union_find(spark, n, m):
    rng = random.Random(n + m)
    pairs = [(f"{rng.randrange(n):03d}", f"{rng.randrange(n):03d}") for _ in range(m)] + [("zz", "zz")]
    got = {r.node: r.component for r in hash_to_min(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert got == union(pairs)


def test_long_chain_and_star(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(150)]
    star = [("hub", f"s{i}") for i in range(300)]
    got = {r.node: r.component for r in hash_to_min(spark.createDataFrame(chain + star, "a string, b string")).collect()}
    assert {got[x] for p in chain for x in p} == {"c000"} and {got[x] for p in star for x in p} == {"hub"}


SCHEMA = "id string, parent string, source string, component string, v int"


def test_groups(spark):
    rows = [("a", None, "S", "x", 1), ("b", "a", None, "x", 1), ("c", "gone", None, "x", 1), ("d", "gone", None, "x", 1), ("e", None, "S", "x", 1), ("f", None, None, "x", 1), ("s", None, "a", "x", 1)]
    got = {r.id: r.group_key for r in record_groups(spark.createDataFrame(rows, SCHEMA), "id", "parent", "source").collect()}
    assert got == {"a": "a", "b": "a", "e": "a", "c": "c", "d": "c", "f": "f", "s": "s"}
    assert record_groups(spark.createDataFrame([], SCHEMA), "id", "parent", "source").count() == 0


def targets(spark, **shares):
    return spark.createDataFrame(list(shares.items()), "split_name string, target_share double")


def test_shares_hold_with_large_groups_and_are_stable(spark):
    groups = [(f"r{i}", "big" if i < 1200 else "mid" if i < 1600 else f"g{i}") for i in range(4000)]
    df = spark.createDataFrame(groups, "id string, group_key string")
    t = targets(spark, train=0.8, validation=0.1, test=0.1)
    got = {r.id: (r.group_key, r.split_name) for r in assign_splits(df, t, "id").collect()}
    for split, share in (("train", 0.8), ("validation", 0.1), ("test", 0.1)):
        assert abs(sum(s == split for _, s in got.values()) / 4000 - share) < 0.02
    assert len({g: s for g, s in got.values()}) == len({(g, s) for g, s in got.values()})
    again = {r.id: (r.group_key, r.split_name) for r in assign_splits(df.repartition(3), t, "id").collect()}
    assert again == got


def test_targets_are_checked_and_normalised(spark):
    df = spark.createDataFrame([(f"r{i}", f"g{i}") for i in range(300)], "id string, group_key string")
    with pytest.raises(ValueError):
        assign_splits(df, spark.createDataFrame([("a", None), (None, 1.0), ("b", -1.0)], "split_name string, target_share double"), "id")
    assert {r.split_name for r in assign_splits(df, targets(spark, only=7.0), "id").collect()} == {"only"}
    assert assign_splits(df.limit(0), targets(spark, a=1.0), "id").count() == 0
