from __future__ import annotations

import random
import re

import numpy as np
import pytest

from quern.llm import flatwords as fw
from quern.llm.likeness import edit_similarity, pair_likeness, text_keys

WORD = re.compile("[a-z0-9_]+")
ODD = ["", None, "...", "A b_1 C9", "naïve Σ İstanbul Kelvin", "x" * 5000, "​a​b", "a\n\nb\tc", "é", "🙂 ok", "_ __ 1"]


def words(t):
    return WORD.findall((t or "").lower())


def one(texts):
    (w,) = fw.pieces(texts, 1 << 62)
    return w


@pytest.mark.parametrize("size", [1, 50, 1 << 20])
def test_words_like_regex(size):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("aBc_ 1.é\n") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    i = 0
    seen = {}
    for w in fw.pieces(texts, size):
        for k in range(w.n):
            want = words(texts[w.first + k])
            at = slice(w.starts[k], w.starts[k] + w.counts[k])
            got = [w.data[b:e].decode("utf-8").lower().replace("K", "k") for b, e in zip(w.begin[at], w.end[at])]
            assert got == want
            for h, x in zip(w.hashes[at].tolist(), want):
                assert seen.setdefault(x, h) == h
            i += 1
    assert i == len(texts) and len(set(seen.values())) == len(seen)


def test_grams_stay_within_texts():
    w = one(["a b c d", "a b", "b c d"])
    h, text, pos = fw.grams(w, 3)
    assert text.tolist() == [0, 0, 2] and pos.tolist() == [0, 1, 0] and h[1] == h[2] != h[0]
    assert len(fw.grams(one(["a"]), 3)[0]) == 0 and list(fw.pieces([])) == []


def test_text_keys():
    a, b = text_keys(one(["a b", "A, b!", "b a", "", "ab"]))
    assert a[0] == a[1] and b[0] == b[1] and len({*zip(a.tolist(), b.tolist())}) == 4


def brute_like(x, y, k=3):
    a, b = ({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for w in (words(x), words(y)))
    return len(a & b) / max(1, len(a | b))


def brute_edit(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return 1 - d[-1] / max(len(a), len(b), 1)


def edited(rng, base, n):
    out = list(base)
    for _ in range(n):
        i = rng.randrange(len(out) + 1)
        out[i : i + rng.randint(0, 1)] = [rng.choice("pqrstuv")] * rng.randint(0, 2)
    return out


def test_likeness_and_alignment_like_brute_force():
    rng = random.Random(4)
    pairs = []
    for _ in range(300):
        base = [rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 60))]
        pairs.append((" ".join(base), " ".join(edited(rng, base, rng.randint(0, 6)))))
    x, y = one([p[0] for p in pairs]), one([p[1] for p in pairs])
    assert np.allclose(pair_likeness(x, y, 3), [brute_like(*p) for p in pairs])
    assert np.allclose(edit_similarity(x, y, 32), [brute_edit(words(a), words(b)) for a, b in pairs])


def test_alignment_outside_the_band():
    x, y = one(["a " * 100, "a b"]), one(["a", "a c"])
    got = edit_similarity(x, y, 8)
    assert np.isnan(got[0]) and got[1] == 0.5
