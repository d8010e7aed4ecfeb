from __future__ import annotations

import random
import re

import pytest

from quern.llm import suffix_automaton as sa

WORD = re.compile("[a-z0-9_]+")


def words(t):
    return WORD.findall((t or "").lower())


def brute(item, text, n):
    a, b = words(item), words(text)
    runs = {tuple(a[i : i + n]) for i in range(len(a) - n + 1)}
    return any(tuple(b[i : i + n]) in runs for i in range(len(b) - n + 1))


def test_random_small_alphabet(spark):
    rng = random.Random(2)
    make = lambda k: " ".join(rng.choice("abc") for _ in range(rng.randint(0, k)))
    items = [(i, make(20), make(15)) for i in range(15)]
    docs = [(i, make(40), rng.choice([None, "", make(60)])) for i in range(150)]
    leaks = sa.find_leaks(spark.createDataFrame(docs, "doc long, p string, r string"), ["p", "r"], spark.createDataFrame(items, "item long, q string, c string"), ["q", "c"], min_words=5)
    got = {(r.item, r.doc) for r in sa.leaked_items(leaks).collect()}
    want = {(i, d) for i, q, c in items for d, p, r in docs if any(brute(x, y, 5) for x in (q, c) for y in (p, r))}
    assert len(want) > 100 and got == want


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(3)
    make = lambda k: " ".join(rng.choice("abcd") for _ in range(k))
    items = spark.createDataFrame([(i, make(12)) for i in range(20)], "item long, q string")
    docs = spark.createDataFrame([(i, make(50)) for i in range(60)], "doc long, t string")
    once = {tuple(r) for r in sa.leaked_items(sa.find_leaks(docs, ["t"], items, ["q"], 4)).collect()}
    monkeypatch.setattr(sa, "MAX_WORDS", 60)
    assert {tuple(r) for r in sa.leaked_items(sa.find_leaks(docs, ["t"], items, ["q"], 4)).collect()} == once


def test_cleaning_removes_spans_or_drops(spark):
    item = "the quick brown fox jumps over the lazy dog and runs far away home"
    docs = [(1, "Before, " + item.title() + ". After it come many other words that are not in any item at all, really none of them."), (2, item), (3, "nothing here"), (4, None)]
    out = sa.find_leaks(spark.createDataFrame(docs, "doc long, t string"), ["t"], spark.createDataFrame([(9, item), (8, None)], "item long, q string"), ["q"], with_clean=True)
    rows = {r.doc: r for r in out.collect()}
    assert set(rows) == {1, 2} and rows[1].items == [9] and rows[1].covered == 14 and not rows[1].dropped and rows[2].dropped
    assert rows[1].cleaned.startswith("Before, . After it come")


def test_no_items(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc long, t string")
    for items in ([], [(1, None)], [(1, "too short")]):
        assert sa.find_leaks(docs, ["t"], spark.createDataFrame(items, "item long, q string"), ["q"]).count() == 0


@pytest.mark.parametrize("n", [1, 3])
def test_match_lengths(n):
    auto = sa.Automaton([(1, ["a b c d a b c x"]), (2, ["b c d q"])], n)
    from quern.llm import flatwords as fw

    (w,) = fw.pieces(["z b c d a b c y b c d q a"], 1 << 62)
    spans, items, longest = auto.spans(w.hashes.tolist())
    assert longest == 6 and items == {1, 2} and spans[0][0] == 1


def test_cleaned_texts_over_blocks(spark, monkeypatch):
    """Two blocks of items cover 30 % of a text each: together they drop it, or both are cut out of a longer one."""
    monkeypatch.setattr(sa, "MAX_WORDS", 1)
    x, y = ([f"{c}{i}" for i in range(15)] for c in "xy")
    own = [f"o{i}" for i in range(90)]
    items = spark.createDataFrame([(1, " ".join(x)), (2, " ".join(y))], "item long, p string")
    texts = [(1, " ".join(x + own[:20] + y)), (2, " ".join(own[:40] + x + own[40:80] + y + own[80:]))]
    got = {r.doc: r for r in sa.cleaned_texts(spark.createDataFrame(texts, "doc long, t string"), ["t"], items, ["p"], 12).collect()}
    assert got[1].covered == got[2].covered == 30 and got[1].dropped and got[1].cleaned is None
    assert not got[2].dropped and got[2].spans == 2 and got[2].cleaned.split() == own
