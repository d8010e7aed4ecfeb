from __future__ import annotations

import random

import pytest

from quern.llm import toxicity as T
from quern.llm.toxicity import Lexicon, plain, score_documents, train_chain, wordings

LEX = Lexicon()


@pytest.mark.parametrize(
    "text, seed",
    [("idiot", "idiot"), ("IDIOT", "idiot"), ("i d i o t", "idiot"), ("i.d.i.o.t", "idiot"), ("id​iot", "idiot"), ("іdіоt", "idiot"), ("idddiiiot", "idiot"), ("idiots", "idiot"), ("1d10t", "idiot"),
     ("crétin", "cretin"), ("m0r0n", "moron"), ("w*rthless", "worthles"), ("parsaite", "parasite"), ("brianless", "brainles"), ("disgu$ting", "disgusting"), ("Ⓘdiot", "idiot"), ("dirtbagg", "dirtbag"), ("uselessdirtbag", "dirtbag")],
)
def test_spellings(text, seed):
    ((word,),) = wordings(text)
    assert LEX.find(word) == seed


@pytest.mark.parametrize("word", ["mask", "kernel", "block", "table", "index", "offset", "launch", "tile_row", "x1", "float32", "die", "you"])
def test_ordinary_words_are_no_seeds(word):
    assert LEX.find(word) is None


def test_plain_and_wordings():
    assert plain("ÀB ﬁ") == "ab fi" and wordings("") == [] and wordings("Stop! go.\nnow 12") == [["stop"], ["go"], ["now"]]


def labelled(seed, n=400):
    """Documents of made-up technical wordings; some hold an insulting or threatening one, some a harmless harsh one."""
    rng = random.Random(seed)
    noun = lambda: rng.choice(["kernel", "tile", "mask", "buffer", "row", "index", "warp"])
    insult = lambda: rng.choice(["idiot", "moron", "loser", "dimwit", "parasite", "bastard"])
    bad = [lambda: f"you are a {insult()}", lambda: f"shut up, {insult()}", lambda: f"what a pathetic {insult()} you are", lambda: f"I will break your {rng.choice(['neck', 'face', 'arm', 'nose'])}", lambda: f"nobody likes you, {insult()}"]
    harsh = [lambda: f"a naked pointer to the {noun()}", lambda: f"kill the {noun()} process", lambda: f"the parasite load of the {noun()}", lambda: f"this {noun()} is a dirty hack", lambda: f"a stupid copy of the {noun()}"]
    out = []
    for i in range(n):
        parts = [f"The {noun()} loads the {noun()} before the {noun()}" for _ in range(rng.randint(2, 6))]
        y = int(rng.random() < 0.3)
        if y:
            parts.insert(rng.randrange(len(parts)), rng.choice(bad)())
        if rng.random() < 0.3:
            parts.insert(rng.randrange(len(parts)), rng.choice(harsh)())
        out.append((i, ". ".join(parts) + ".", y))
    return out


def test_held_out_accuracy_with_wrong_labels():
    rng = random.Random(1)
    train = [(i, t, 1 - y if rng.random() < 0.05 else y) for i, t, y in labelled(1)]
    chain = train_chain(train)
    test = labelled(2)
    got = chain.score_many([t for _, t, _ in test])[:, -1] >= T.THRESHOLD
    tp = sum(g and y for g, (*_, y) in zip(got, test))
    assert tp / max(1, got.sum()) > 0.93 and tp / sum(y for *_, y in test) > 0.9
    obscured = ["The tile loads. you are an i d i o t", "sHuT uP, mоrоn", "what a pathetic l0ser you are"]
    assert (chain.score_many(obscured)[:, -1] >= T.THRESHOLD).all()


def test_batches_and_single_wordings_agree():
    chain = train_chain(labelled(1))
    texts = [t for _, t, _ in labelled(3, 50)]
    whole = chain.score_many(texts)
    assert abs(whole - [chain.score_many([t])[0] for t in texts]).max() < 1e-9


def test_without_usable_labels_seeds_decide():
    for docs in ([], [(1, "the kernel loads", 0)], [(1, "you moron", 1)]):
        chain = train_chain(docs)
        assert chain.score_many([None, "", "  ", "the kernel loads", "a moron test", "a naked pointer for you"])[:, -1].max() < 0.5
        got = chain.score_many(["you are a m0ron", "The tile loads. i will strangle you"])
        assert (got[:, -1] >= 0.5).all() and got[0, 0] >= 0.5 and got[1, 1] >= 0.5 and got[0, 1] < 0.5


def test_labels_alone_teach_wordings():
    """Without a single seed word, most of the wordings that the labels show often are found."""
    none = dict.fromkeys(T.SEEDS, "")
    chain = train_chain(labelled(1, 1500), none)
    test = labelled(2)
    got = chain.score_many([t for _, t, _ in test])[:, -1] >= T.THRESHOLD
    tp = sum(g and y for g, (*_, y) in zip(got, test))
    assert tp / max(1, got.sum()) > 0.9 and tp / sum(y for *_, y in test) > 0.7
    assert not (train_chain([(i, "x y z", i % 2) for i in range(20)], none).score_many(["x y z", "you"])[:, -1] >= T.THRESHOLD).any()


def test_documents(spark):
    rows = labelled(1, 200)
    texts = [(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (902, "you are a moron " + "x " * 50_000), (903, "you are a moron.\n" + "The kernel loads the tile. " * 20_000)]
    docs = spark.createDataFrame([(i, t, 0, "z", 1) for i, t in texts], "doc long, text string, label int, v string, y int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(1, None), (2, 1), (2, 0), (12345, 1)], "doc long, label int")
    got = {r.doc: r for r in score_documents(docs, labels).collect()}
    assert len(got) == 204 and got[900].abusive < 1e-9 and got[901].abusive < 1e-9 and got[903].abusive > 0.5
    assert score_documents(docs.limit(0), labels.limit(0)).count() == 0
