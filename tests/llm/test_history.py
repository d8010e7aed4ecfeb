from __future__ import annotations

import random

import pytest

from quern.llm.history import HistoryIndex, matches, record_keys, submit

COLUMNS = "fp_id long, task_id string, gpu_architecture string, prompt_hash string, semantic_hash string, reference_ast_hash string, assistant_ast_hash string, band string, minwise int"


def h(n):
    return None if n is None else f"{n:064x}"


def row(i, task=None, arch=None, p=None, s=None, r=None, a=None):
    return (i, task, arch, *(x if isinstance(x, str) else h(x) for x in (p, s, r, a)), "clash", 0)


def rows(spark, *data):
    return spark.createDataFrame(list(data), COLUMNS)


def keys(r):
    arch = (r[2] or "").strip().lower() or "blackwell"
    out = {("p", arch, r[3]), ("a", arch, r[6]), ("s", r[4]), ("r", r[5]), ("t", (r[1] or "").strip().lower() or None)}
    return {k for k in out if k[-1]}


def random_rows(seed, n, start):
    rng = random.Random(seed)
    pick = lambda m: rng.choice([None, *range(m)])
    return [row(start + i, rng.choice([None, " ", f"T{rng.randrange(60)} "]), rng.choice([None, "", "Hopper", "blackwell "]), pick(40), pick(90), pick(90), pick(40)) for i in range(n)]


def test_against_fold_and_batch_by_batch(spark):
    known, batch = random_rows(1, 30, 0), random_rows(2, 90, 100)
    seen = set().union(*map(keys, known))
    want = {}
    for r in batch:
        want[r[0]] = not keys(r) & seen
        seen |= keys(r)
    once, steps = HistoryIndex(spark), HistoryIndex(spark)
    for index in (once, steps):
        index.append(record_keys(rows(spark, *known), "fp_id"))
    assert {r.id: r.is_new for r in submit(once, rows(spark, *batch)).collect()} == want
    got = {}
    for s in range(0, 90, 30):
        got |= {r.id: r.is_new for r in submit(steps, rows(spark, *batch[s : s + 30])).collect()}
    assert got == want


def test_spellings_of_hashes_and_repeated_rows(spark):
    digits = "ab" * 32
    index = HistoryIndex(spark)
    index.append(record_keys(rows(spark, row(1, p=" SHA256:" + digits.upper() + "\n")), "fp_id"))
    batch = rows(spark, row(5, p=digits), row(6, arch="hopper", p=digits), row(7, p="abc"), row(8), row(9, task="x"), row(9, task=" X"), row(10, task="x"))
    assert {r.id: r.is_new for r in submit(index, batch).collect()} == {5: False, 6: True, 7: True, 8: True, 9: True, 10: False}
    assert {r.id: r.is_new for r in submit(index, rows(spark, row(11, arch="Hopper", p=digits))).collect()} == {11: False}


def test_equal_digits_in_other_columns_do_not_match(spark):
    index = HistoryIndex(spark)
    index.append(record_keys(rows(spark, row(1, s=7)), "fp_id"))
    assert submit(index, rows(spark, row(2, r=7))).first().is_new


def test_empty(spark):
    index = HistoryIndex(spark)
    empty = spark.createDataFrame([], COLUMNS)
    assert submit(index, empty).count() == 0
    assert submit(index, rows(spark, row(1, task="a"))).first().is_new
    assert not submit(index, rows(spark, row(2, task="a"))).first().is_new


def test_signatures_and_matches(spark):
    index = HistoryIndex(spark)
    index.append(record_keys(rows(spark, row(4, "t4", None, 1, 2, 3, 4), row(5, None, None, 1, 9)), "fp_id"))
    batch = rows(spark, row(10, "t4", None, 1, 2, 3, 4), row(11, "t9", None, 1, 8), row(12, None, "hopper", 1), row(13))
    got = {r.id: (r.match_id, r.shared, r.similarity) for r in matches(index, batch).collect()}
    assert got == {10: (4, 5, 1.0), 11: (4, 1, 1 / 6)} or got == {10: (4, 5, 1.0), 11: (4, 1, 1 / 5)}
    assert matches(HistoryIndex(spark), batch).count() == 0


def test_another_session_opens_the_index(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    index = HistoryIndex(spark, path, rows_per_bucket=20)
    known = random_rows(3, 60, 0)
    for s in range(0, 60, 20):
        index.append(record_keys(rows(spark, *known[s : s + 20]), "fp_id"))
    other = spark.newSession()
    opened = HistoryIndex(other, path)
    assert opened.generations == index.generations and 1 <= len(opened.generations) < 3  # similar sizes were merged
    assert opened.generations[0]["buckets"] > 2
    opened.vacuum()
    assert len(list((tmp_path / "index").glob("generation-*"))) == len(opened.generations)
    batch = random_rows(4, 40, 100)
    seen = set().union(*map(keys, known))
    want = {}
    for r in batch:
        want[r[0]] = not keys(r) & seen
        seen |= keys(r)
    assert {r.id: r.is_new for r in submit(opened, rows(other, *batch)).collect()} == want
    assert not any(r.is_new for r in submit(HistoryIndex(spark, path), rows(spark, *[b for b in batch if keys(b)])).collect())
    with pytest.raises(FileExistsError):  # the first object does not know of the other session's append
        index.append(record_keys(rows(spark, row(999, task="z")), "fp_id"))


def test_probe_reads_only_the_buckets_of_the_batch(spark):
    index = HistoryIndex(spark, rows_per_bucket=1)
    index.append(record_keys(rows(spark, *random_rows(5, 60, 0), row(99, task="T1")), "fp_id"))
    one = record_keys(rows(spark, row(1, task="T1")), "fp_id").select("band", "minwise", "check")
    plan = index.probe(one)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert index.probe(one).count() == 1


def test_near_copies_by_sets_of_features(spark):
    """Records of 40 features in 24 bands; copies with some exchanged are found and their similarity estimated."""
    rng = random.Random(6)
    n = 24
    base = [[f"f{rng.randrange(10**9)}" for _ in range(40)] for _ in range(30)]
    cols = "fp_id long, " + ", ".join(f"b{i} array<string>" for i in range(n))
    bands = tuple((f"b{i}", False) for i in range(n))
    frame = lambda data: spark.createDataFrame([(i, *([f] * n)) for i, f in data], cols)
    index = HistoryIndex(spark)
    index.append(record_keys(frame(list(enumerate(base))), "fp_id", bands))
    near = [(100 + i, f[:37] + [f"n{i}.{j}" for j in range(3)]) for i, f in enumerate(base)]  # likeness 37 / 43
    far = [(200, [f"x{j}" for j in range(40)]), (201, []), (202, None)]
    got = {r.id: (r.match_id, r.similarity) for r in matches(index, frame(near + far), bands=bands).collect()}
    assert {i: m for i, (m, _) in got.items()} == {100 + i: i for i in range(30)}
    assert abs(sum(s for _, s in got.values()) / 30 - 37 / 43) < 0.06
    exact = matches(index, frame([(300, base[0])]), least=0.99, bands=bands).collect()
    assert [(r.match_id, r.similarity) for r in exact] == [(0, 1.0)]
