from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.llm import mixing
from quern.llm.mixing import deviations, mix, pfair_slots


@pytest.mark.parametrize("seed", range(30))
def test_schedule_is_fair(seed):
    """Every source is within one block of its weight of what is delivered, after any slot."""
    rng = random.Random(seed)
    block = 100
    tokens = {f"s{i}": rng.choice([rng.randint(1, 300), rng.randint(1, 20_000), block * rng.randint(1, 90)]) for i in range(rng.randint(1, 12))}
    slots = pfair_slots(tokens, block)
    order = sorted((t, s, i) for s, mine in slots.items() for i, t in enumerate(mine))
    assert [t for t, *_ in order] == list(range(len(order)))
    whole, given, done = sum(tokens.values()), Counter(), 0
    assert all(len(mine) == -(-tokens[s] // block) and mine == sorted(mine) for s, mine in slots.items())
    for _, s, i in order:
        size = min(block, tokens[s] - i * block)
        given[s] += size
        done += size
        assert max(abs(given[x] - tokens[x] / whole * done) for x in tokens) < block
    assert given == Counter(tokens)


SIZES = "doc long, source string, tokens long, copy int, slot int"


def corpus(spark, n=3000):
    rng = random.Random(1)
    names = ["a"] * 5 + ["b"] * 3 + ["c", "d"]
    rows = [(i, rng.choice([" A" if i % 50 == 0 else None, None]) or rng.choice(names), int(rng.lognormvariate(5, 1)) + 1, 0, 0) for i in range(n)]
    return rows, spark.createDataFrame(rows, SIZES)


def targets(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, target_share double, max_repeats int")


def test_shares_repeats_and_order(spark):
    rows, df = corpus(spark)
    out, report = mix(df, targets(spark, ("a", 0.4, 1), ("B ", 0.3, 2), ("c", 0.3, 3), ("none", 0.1, 9), ("d", None, 2), (None, 0.5, 2)), block=200)
    got, facts = out.collect(), {r.source: r for r in report.collect()}
    assert set(facts) == {"a", "b", "c", "none", "d"} and facts["none"].tokens == 0 and facts["d"].tokens == 0
    for s, share in (("a", 0.4), ("b", 0.3), ("c", 0.3)):
        assert abs(facts[s].actual_share - share) < 0.003
    size = {r[0]: r[2] for r in rows}
    parts = {}
    for r in got:
        parts.setdefault((r.source, r.doc, r.copy), []).append((r.first_token, r.tokens))
    for (_, doc, _), ps in parts.items():
        ps.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(ps, ps[1:])) and ps[0][0] == 0 and sum(n for _, n in ps) == size[doc]
    uses = Counter((s, d) for s, d, _ in parts)
    limit = {"a": 1, "b": 2, "c": 3}
    assert all(n <= limit[s] for (s, _), n in uses.items()) and max(n for (s, _), n in uses.items() if s == "c") == 3
    assert {s: sum(n for (x, _), n in uses.items() if x == s) for s in limit} == {s: facts[s].uses for s in limit}
    slots = Counter()
    for r in got:
        slots[r.slot] += r.tokens
    assert max(slots.values()) == 200 and len({(r.slot, r.source) for r in got}) == len(slots)
    assert max(r.most_tokens for r in deviations(out).collect()) < 200


def test_scarce_source_bounds_the_mix(spark):
    rows = [(i, "a", 10, 0, 0) for i in range(1000)] + [(5000 + i, "b", 10, 0, 0) for i in range(10)]
    out, report = mix(spark.createDataFrame(rows, SIZES), targets(spark, ("a", 0.5, 1), ("b", 0.5, 2)), block=50)
    assert {r.source: r.tokens for r in report.collect()} == {"a": 200, "b": 200}


def test_empty(spark):
    empty = spark.createDataFrame([], SIZES)
    out, report = mix(empty, targets(spark, ("a", 0.5, 1)))
    assert out.count() == 0 and report.first().actual_share == 0
    out, report = mix(empty, targets(spark))
    assert out.count() == report.count() == 0


def test_choice_and_order_do_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    """The same rows whether the input is held in few buckets or, as a larger one, in many."""
    _, df = corpus(spark)
    names = targets(spark, ("a", 0.4, 1), ("b", 0.3, 2), ("c", 0.3, 3))
    found = []
    for held in (200_000, 100, 7):
        monkeypatch.setattr(mixing, "DOCS_PER_BUCKET", held)
        out, report = mix(df, names, block=200)
        found.append((sorted(map(tuple, out.collect())), sorted(map(tuple, report.collect()))))
    assert found[0] == found[1] == found[2]


def test_blocks_keep_their_size_in_a_long_mix(spark):
    """600,000 blocks: every slot has one block, every source is within one block of its weight."""
    rows = [(i, "ab"[i % 2], 2000, 0, 0) for i in range(300)]
    out, report = mix(spark.createDataFrame(rows, SIZES), targets(spark, ("a", 0.5, 1), ("b", 0.5, 1)), block=1)
    per_slot = out.groupBy("slot").agg(F.sum("tokens").alias("tokens"))
    assert tuple(per_slot.agg(F.count("*"), F.min("slot"), F.max("slot"), F.max("tokens")).first()) == (600_000, 0, 599_999, 1)
    assert out.select("source", "doc", "copy", "first_token").distinct().count() == 600_000
    assert {r.source: r.tokens for r in report.collect()} == {"a": 300_000, "b": 300_000}
    assert {r.source: r.most_tokens for r in deviations(out).collect()} == {"a": 0.5, "b": 0.5}


def test_deviations_over_stretches(spark, monkeypatch):
    """Summed by stretches or at once, as counted by hand."""
    rng = random.Random(3)
    rows = [(t, rng.choice("abbccc"), rng.randint(1, 9)) for t in range(300)]
    whole, shares = sum(n for *_, n in rows), Counter()
    for _, s, n in rows:
        shares[s] += n
    most, given, done = dict.fromkeys(shares, 0.0), Counter(), 0
    for _, s, n in rows:
        given[s] += n
        done += n
        most = {x: max(most[x], abs(given[x] - shares[x] / whole * done)) for x in most}
    for stretch in (1 << 19, 64, 1):
        monkeypatch.setattr(mixing, "STRETCH", stretch)
        got = deviations(spark.createDataFrame(rows, "slot long, source string, tokens int"))
        assert {r.source: r.most_tokens for r in got.collect()} == pytest.approx(most)
