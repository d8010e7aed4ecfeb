from __future__ import annotations

import random
import re
from itertools import combinations


from quern.llm import flatwords as fw
from quern.llm.buckets import bucket_pairs
from quern.llm.chunks import chunk_sums, cross_overlaps, expand_across, record_overlaps
from quern.llm.likeness import expand_pairs
from quern.llm.order_minhash import near_duplicates, similar_classes

WORD = re.compile("[a-z0-9_]+")


def like(x, y):
    a, b = ({tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (WORD.findall((t or "").lower()) for t in (x, y)))
    return len(a & b) / max(1, len(a | b))


def corpus(seed, groups=40, most=8, length=120):
    """Texts in groups of small edits, copies among them; every group also shares a long boilerplate beginning."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(5))
    plate = [word() for _ in range(30)]
    out = []
    for _ in range(groups):
        base = plate + [word() for _ in range(rng.randint(5, length))]
        for _ in range(rng.randint(1, most)):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5, 9])):
                t[rng.randrange(len(t))] = word()
            out.append(" ".join(t))
    rng.shuffle(out)
    return out


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc long, text string, mask string, t1 int").drop("mask")
    pairs, members = near_duplicates(df.select("doc", "text"))
    return pairs, members, {(r.x, r.y) for r in expand_pairs(pairs.where("likeness >= 0.6"), members).collect()}


def test_near_duplicates_like_brute_force(spark):
    texts = corpus(1) + ["a b c d e", "a b c d f", "x", "", None, "  ", "Q r S", "q, r. s"]
    rows = [(i, t, "m", 1) for i, t in enumerate(texts)] + [(0, texts[0], "m", 1)]
    want = {(i, j) for i, j in combinations(range(len(texts)), 2) if like(texts[i], texts[j]) >= 0.6}
    pairs, members, got = found(spark, rows)
    assert len(want) > 100 and got == want
    assert classes_of(spark, rows) == brute_classes(texts, want)


def brute_classes(texts, links):
    """doc -> (smallest id of its component, others with the same words), of texts with a 3-word run."""
    low = {i: i for i, t in enumerate(texts) if len(WORD.findall((t or "").lower())) >= 3}
    while True:
        new = dict(low)
        for i, j in links:
            new[i] = new[j] = min(new[i], new[j])
        if new == low:
            break
        low = new
    words = [tuple(WORD.findall((t or "").lower())) for t in texts]
    return {i: (c, words.count(words[i]) - 1) for i, c in low.items()}


def classes_of(spark, rows):
    df = spark.createDataFrame([r[:2] for r in rows], "doc long, text string")
    return {r.doc: (r.class_id, r.copies) for r in similar_classes(df).collect()}


def test_chain_of_a_large_family(spark):
    """Each text is like its neighbours only, all share the first 40 words with unrelated texts: one class by a chain."""
    rng = random.Random(21)
    line = [f"c{i}" for i in range(400)]
    shared = [f"s{i}" for i in range(40)]
    texts = [" ".join(shared + line[i : i + 160]) for i in range(0, 240, 12)]
    texts += [" ".join(shared + [f"w{rng.randrange(10**6)}" for _ in range(160)]) for _ in range(60)]
    want = {(i, j) for i, j in combinations(range(len(texts)), 2) if like(texts[i], texts[j]) >= 0.6}
    assert len(want) < 20 * 19 / 2
    assert classes_of(spark, list(enumerate(texts))) == brute_classes(texts, want)


def test_families_of_any_size_lose_no_link(spark):
    """Families around the bound of a bucket, at several lengths and numbers of edits."""
    rng = random.Random(22)
    rows = []
    for size, edits, length in ((50, 6, 150), (80, 5, 120), (95, 6, 150), (105, 7, 150), (125, 15, 300)):
        base = [f"b{rng.randrange(10**9)}" for _ in range(length)]
        for _ in range(size):
            t = list(base)
            for at in rng.sample(range(length), edits):
                t[at] = f"w{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(t), "m", 1))
    want = {(i, j) for (i, a, *_), (j, b, *_) in combinations(rows, 2) if like(a, b) >= 0.6}
    assert len(want) > 1000 and found(spark, rows)[2] == want
    assert classes_of(spark, rows) == brute_classes([t for _, t, *_ in rows], want)


def test_large_group_goes_the_hot_way(spark):
    texts = corpus(2, groups=1, most=1, length=150)
    rng = random.Random(3)
    base = texts[0].split()
    rows = []
    for i in range(160):
        t = list(base)
        for _ in range(rng.randint(0, 7)):
            t[rng.randrange(len(t))] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(t), "m", 1))
    want = {(i, j) for (i, a, *_), (j, b, *_) in combinations(rows, 2) if like(a, b) >= 0.6}
    got = found(spark, rows)[2]
    assert len(want) > 5000 and got == want


def test_large_group_at_the_bound(spark):
    rng = random.Random(9)
    base = [f"b{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(220):
        t = list(base)
        for at in rng.sample(range(150), 6):
            t[at] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(t), "m", 1))
    want = {(i, j) for (i, a, *_), (j, b, *_) in combinations(rows, 2) if like(a, b) >= 0.6}
    got = found(spark, rows)[2]
    assert len(want) > 10_000 and got == want


def test_longer_versions_of_a_large_group(spark):
    """A longer version shares with the group frequent sketches only, which are less than a fifth of its own."""
    rng = random.Random(12)
    core = [f"c{i}" for i in range(120)]
    texts = []
    for _ in range(60):
        t = list(core)
        t[rng.randrange(120)] = f"w{rng.randrange(10**6)}"
        texts.append(t)
    for _ in range(60):
        texts.append(core + [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(70, 78))])
    rows = [(i, " ".join(t), "m", 1) for i, t in enumerate(texts)]
    want = {(i, j) for (i, a, *_), (j, b, *_) in combinations(rows, 2) if like(a, b) >= 0.6}
    assert len(want) > 2000 and found(spark, rows)[2] == want


def test_repeated_and_reordered_texts(spark):
    rng = random.Random(13)
    texts = []
    for i in range(60):
        lines = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) for _ in range(12)]
        moved = rng.sample(lines, len(lines))
        texts += [" ".join(lines), " ".join(lines * (3 + i % 3)), " ".join(moved)]
    rows = [(i, t, "m", 1) for i, t in enumerate(texts)]
    want = {(i, j) for (i, a, *_), (j, b, *_) in combinations(rows, 2) if like(a, b) >= 0.6}
    assert len(want) > 170 and found(spark, rows)[2] == want


def test_empty(spark):
    pairs, members, got = found(spark, [(1, None, "m", 1), (2, " ", "m", 1)])
    assert got == set() and members.count() == 0 and classes_of(spark, [(1, None), (2, " ")]) == {}


def test_bucket_pairs_bound_and_masks(spark):
    rows = [(7, d, 3, 1) for d in range(10)] + [(8, d, 1 if d % 2 else 2, 2) for d in range(4)] + [(9, d, 3, 1) for d in (1, 2)]
    keys = spark.createDataFrame(rows, "key long, doc long, mask byte, weight int")
    for cold in (2, 5, 48):
        want = {}
        for k in (7, 8, 9):
            of = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
            for x, y in combinations(of, 2) if len(of) <= cold else ():
                if (x[2] & 1 and y[2] & 2) or (x[2] & 2 and y[2] & 1):
                    want.setdefault((x[1], y[1]), []).append(x[3])
        got = {(r.a, r.b): (r.shared, r.weight) for r in bucket_pairs(keys, cold).collect()}
        assert got == {p: (len(w), sum(w)) for p, w in want.items()}


def test_record_overlaps_like_brute_force(spark):
    texts = corpus(7, groups=30, length=60) + ["", None, "one", "one"]
    rng = random.Random(8)
    rows = [(i, t, rng.choice([1, 2])) for i, t in enumerate(texts)]
    rows[-2:] = [(rows[-2][0], "one", 1), (rows[-1][0], "one", 2)]
    of = {}
    for i, t, m in rows:
        for w in fw.pieces([t]):
            of[i] = list(zip(*chunk_sums(w, 0)))
    held = {m: {d for i, _, k in rows if k == m for _, d, _ in of[i]} for m in (1, 2)}
    want = {i: sum(n for _, d, n in of[i] if d in held[3 - m]) for i, _, m in rows}
    got = {r.doc: r for r in record_overlaps(spark.createDataFrame(rows + [(9999, "x", None)], "doc long, text string, mask byte")).collect()}
    assert {i: r.shared for i, r in got.items()} == want and sum(map(bool, want.values())) > 20
    assert all(r.overlap == (r.shared / r.words if r.words else 0) for r in got.values())


def test_cross_overlaps_like_brute_force(spark):
    texts = corpus(5, groups=60, length=60) + ["one two three four", "one two three four", "one two three five", None, ""]
    rng = random.Random(6)
    rows = [(i, t, rng.choice([1, 1, 2])) for i, t in enumerate(texts)]
    n = len(texts)
    rows[n - 5], rows[n - 4], rows[n - 3] = (n - 5, texts[n - 5], 1), (n - 4, texts[n - 4], 2), (n - 3, texts[n - 3], 2)
    pairs, members = cross_overlaps(spark.createDataFrame(rows, "doc long, text string, mask byte"))
    got = {(r.train_doc, r.eval_doc) for r in expand_across(pairs, members).collect()}
    want = {(i, j) for i, a, m in rows if m == 1 for j, b, k in rows if k == 2 and like(a, b) >= 0.6}
    assert len(want) > 50 and got == want


def test_cross_overlaps_of_a_template(spark):
    """Fixed parts of 13 words make frequent chunks that cover only about a third of each text."""
    rng = random.Random(11)
    fixed = [f"f{i}" for i in range(126)]
    rows = []
    for i in range(120):
        t = list(fixed)
        t[13::14] = [f"s{rng.randrange(10**6)}" for _ in t[13::14]]
        rows.append((i, " ".join(t), 1 + i % 2))
    want = {(i, j) for i, a, m in rows if m == 1 for j, b, k in rows if k == 2 and like(a, b) >= 0.6}
    pairs, members = cross_overlaps(spark.createDataFrame(rows, "doc long, text string, mask byte"))
    assert len(want) == 3600 and {(r.train_doc, r.eval_doc) for r in expand_across(pairs, members).collect()} == want


def test_cross_overlaps_empty(spark):
    pairs, members = cross_overlaps(spark.createDataFrame([], "doc long, text string, mask byte"))
    assert pairs.count() == 0 and expand_across(pairs, members).count() == 0
