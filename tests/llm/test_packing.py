from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from quern.llm.packing import pack, plan_packing
from quern.llm.tokens import VOCABULARY, token_sizes


def contents(plan):
    out = []
    for pattern, n in plan.patterns:
        assert sum(s * q for s, q in pattern) <= plan.capacity
        out += [pattern] * n
    return out


def best(sizes, c):
    """Least number of containers, by exhaustive search."""
    sizes = sorted(sizes, reverse=True)
    least = math.ceil(sum(sizes) / c)
    result = len(sizes)

    def go(i, bins):
        nonlocal result
        if len(bins) >= result:
            return
        if i == len(sizes):
            result = len(bins)
            return
        tried = set()
        for k, room in enumerate(bins):
            if room >= sizes[i] and room not in tried:
                tried.add(room)
                go(i + 1, [*bins[:k], room - sizes[i], *bins[k + 1 :]])
        go(i + 1, [*bins, c - sizes[i]])

    go(0, [])
    assert result >= least
    return result


@pytest.mark.parametrize("seed", range(60))
def test_plan_holds_all_items_and_is_close_to_best(seed):
    rng = random.Random(seed)
    c = rng.choice([10, 17, 30])
    sizes = [rng.randint(1, c) for _ in range(rng.randint(1, 10))]
    plan = plan_packing(dict(Counter(sizes)), c)
    held = Counter()
    for pattern in contents(plan):
        for s, q in pattern:
            held[s] += q
    assert held == Counter(sizes)
    assert plan.containers <= best(sizes, c) + 1


@pytest.mark.parametrize("seed", range(40))
def test_reduction_alone_keeps_the_optimum(seed):
    from quern.llm.packing import Plan, _reduce

    for step in range(50):
        rng = random.Random(1000 * seed + step)
        c = rng.randint(5, 40)
        sizes = [rng.randint(1, c) for _ in range(rng.randint(1, 8))]
        count, plan = dict(Counter(sizes)), Plan(c)
        _reduce(count, plan)
        rest = [s for s, n in count.items() for _ in range(n)]
        assert plan.containers + (best(rest, c) if rest else 0) == best(sizes, c)


def test_pair_that_needs_a_size_without_a_spare_copy():
    assert plan_packing({6: 1, 5: 1, 1: 1}, 13).containers == 1


def test_too_large_capacities(spark):
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(1, 5)], "doc long, tokens long"), spark.createDataFrame([("a", 1 << 40)], "spec_name string, capacity_tokens long"))


def test_large_histogram_is_packed_tightly():
    rng = random.Random(1)
    h = Counter(min(512, int(rng.lognormvariate(4.5, 0.8)) + 1) for _ in range(200_000))
    plan = plan_packing(dict(h), 512)
    total = sum(s * n for s, n in h.items())
    assert plan.containers <= 1.005 * math.ceil(total / 512) and plan.fixed > 0


def check(spark, sizes, specs):
    df = spark.createDataFrame(sizes, "doc long, tokens long")
    out, _ = pack(df, spark.createDataFrame(specs, "spec_name string, capacity_tokens long"))
    fill, pieces = defaultdict(int), defaultdict(list)
    for r in out.collect():
        fill[r.spec_name, r.container] += r.tokens
        pieces[r.spec_name, r.doc].append((r.first_token, r.tokens, r.piece))
    for name, c in specs:
        if not name or not c or c < 1:
            assert not any(s == name for s, _ in fill)
            continue
        assert max((v for (s, _), v in fill.items() if s == name), default=0) <= c
        numbers = sorted(k for s, k in fill if s == name)
        assert numbers == list(range(len(numbers)))
        for doc, n in sizes:
            got = sorted(pieces[name, doc])
            assert sum(t for _, t, _ in got) == n and [p for *_, p in got] == list(range(len(got)))
            assert [a for a, *_ in got] == [i * c for i in range(len(got))] and (len(got) == 1 or n > c)


def test_items_above_capacity_and_hot_size(spark):
    rng = random.Random(2)
    sizes = [(i, 7 if i % 3 == 0 else rng.randint(1, 90)) for i in range(900)] + [(1000, 64), (1001, 65), (1002, 640), (1003, 1)]
    check(spark, sizes, [("a", 64), ("b", 8), ("c", 500), ("none", None), ("zero", 0)])


def test_empty(spark):
    check(spark, [], [("a", 64)])
    check(spark, [(1, 5)], [])


def test_token_sizes(spark):
    docs = spark.createDataFrame([(1, "hello world", "a", 1), (2, None, "a", 1), (3, " \n", "b", 1), (4, "<|endoftext|>", None, 1), (None, "x", "a", 1), (5, "ab " * 50_000, "b", 1)], "doc long, text string, source string, tokens int")
    got = {r.doc: r.tokens for r in token_sizes(docs.drop("source"), VOCABULARY).collect()}
    assert set(got) == {1, 4, 5} and got[1] == 2 and got[4] > 1 and got[5] >= 50_000
    assert {(r.doc, r.source) for r in token_sizes(docs).collect()} == {(1, "a"), (4, None), (5, "b")}
