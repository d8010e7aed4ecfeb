"""Abusive, hateful or sexual content, by a classifier chain.

*Spelling.*  Texts are brought to a plain form: compatibility forms, look-alike
letters of other scripts, accents, invisible characters and case are undone;
letters set apart by blanks or marks are joined.  Words that still differ from a
seed word by repeated, masked, swapped, lost or added letters are read as that
seed word, unless they are common words of the corpus.

*Wordings.*  A document is judged by its wordings (sentences and lines), each by
its words, word pairs and the categories of its seed words.  Words that are rare
in the labelled documents count as one word (``~``), as names would.

*Chain.*  insult -> threat -> hate -> sexual -> abusive.  Each link is a linear
(logistic) model over the features and the logits of all links before it; those
are out-of-fold predictions in training.  The review gives one label per
document, so the labels of wordings are weak (multiple-instance learning): the
wordings of documents judged harmless are harmless; in documents judged abusive those
are abusive that hold a seed word, or the features that speak most for the document
(features that stand in abusive documents too often for chance), and once a first
chain is fitted, those with such a feature that it finds likely.  Categories are those
of the seeds, and for wordings without seeds those that the first chain finds.  Labels
that it contradicts strongly are left out, as some judgements are wrong.  The
threshold is moved where out-of-fold scores of the judged documents ask for it.

*Bounds.*  The model is fitted on the driver on at most MAX_LABELLED labelled documents
(smallest hashes of the id) and MAX_WORDINGS distinct wordings; scoring covers
every document and its whole text.

Defined cases: null and blank texts score 0; null judgements are ignored; a
document with as many judgements for as against is not used; without any usable
judgement of both kinds, or without any sign of abuse in the documents judged so, the
seed words alone decide, next to a word that addresses or names people.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LABELLED = 20_000
MAX_WORDINGS = 15_000
FOLDS = 3
RATE = 0.15
L2 = 2e-5
STEPS = 60
COMMON = 5  # documents of the labelled sample in which a word must stand to count as common
THRESHOLD = 0.5
#: How much more likely than chance, in logarithms, the documents of a feature that speaks for abuse must be, and the log odds that a wording needs.
SURE = 3.0
EVIDENCE = 2.0
#: By how much another threshold must be better (in F1) to replace 0.
GAIN = 0.02
BALANCE = 0.35  # weight of all abusive wordings over that of all others

CATEGORIES = ("insult", "threat", "hate", "sexual", "abusive")
#: Seed words in plain spelling; fixed values.
SEEDS = {
    "insult": """idiot moron imbecile cretin halfwit dimwit dumbass jackass asshole bastard dirtbag scumbag loser clown
        parasite maggot pig trash filth scum stupid brainless worthless pathetic useless disgusting miserable filthy ugly
        rotten dumb bitch whore retard fool lunatic wretch shit crap idiota imbecil estupido cabron mierda inutil maldito pendejo
        gilipollas connard salaud salope abruti merde imbecile gueule arschloch trottel vollidiot miststuck dreckskerl
        wichser depp damlich damlicher damliche dumm dummer dumme elender elende callate fresse hurensohn stronzo coglione cretino""",
    "threat": """kill hurt beat smash break neck bleed murder stab strangle shoot burn regret suffer beg verrecke
        krepier umbringen crever creve mueras muere matar""",
    "hate": """vermin cockroach cockroaches subhuman animals immigrant immigrants foreign foreigner foreigners refugee refugees
        women wipe exterminate deport inferior filth untermensch auslander etrangers extranjeros""",
    "sexual": """naked nude nudes sex sexy porn fuck fucking breasts undress undressed moaned fondled stripper strippers hardcore
        erotic screw grope groped lick licked caressed dirty horny blowjob nackt ficken desnuda nue baiser""",
}
#: Words that address or name people; fixed values.
PEOPLE = set("i me my you your yours yourself du dich dir dein deine tu toi ton ta te eres tus usted she her he his him they people family families women men everyone nobody someone team".split())

#: Technical senses of seed words, as pairs of neighbours; fixed values.
TECHNICAL = {
    tuple(x.split())
    for x in (
        "naked pointer, dumb terminal, dumb pointer, dumb copy, pig latin, breast imaging, breast cancer, ugly hack, dirty hack, dirty trick, dirty bit, "
        "dirty page, dirty read, dirty write, dirty flag, dirty cache, parasitic load, parasitic capacitance, idiot proof, kill process, kill job, "
        "kill thread, kill signal, kill switch, sex column, sex attribute, sex chromosome, trash can, burn in, burn rate, beat rate, break point, break even, "
        "screw thread, nude colour, shit storm, crap out, animals dataset, smash stack"
    ).split(", ")
}

_LOOKALIKE = str.maketrans("авеёіјкмнорстухѕԁһӏɡαβεικνορτυχıøłđ", "abeeijkmhopctyxsdhlgabeiknoptuxiold")
_PLAIN = {c: None for c in range(0x110000) if unicodedata.category(chr(c)) in ("Cf", "Mn")} | _LOOKALIKE | {ord("ß"): "ss"}
_APART = re.compile(r"(?<![^\W\d_])[^\W\d_](?:[ *.\-_#|/+~][^\W\d_]){2,}(?![^\W\d_])")
_SEP = re.compile(r"[ *.\-_#|/+~]")
_WORDING = re.compile(r"[.!?]+(?=\s|$)|\n+")
_WORD = re.compile(r"[0-9@$*#!]*[a-z][a-z0-9_@$*#!]*")
_LEET = str.maketrans("013457@$!", "oieastasi")
_RUN = re.compile(r"(.)\1+")


def plain(text: str) -> str:
    """The text in plain lower-case letters."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).lower().translate(_PLAIN)
    else:
        text = text.lower()
    return _APART.sub(lambda m: _SEP.sub("", m.group()), text)


def wordings(text: str) -> list[list[str]]:
    """The words of every wording of a text."""
    return [w for w in map(_WORD.findall, _WORDING.split(plain(text))) if w]


def _squeeze(word: str) -> str:
    return _RUN.sub(r"\1", word)


class Lexicon:
    """Seed words by any spelling."""

    def __init__(self, seeds: dict[str, str] = SEEDS):
        self.categories: dict[str, tuple[str, ...]] = {}
        for c, words in seeds.items():
            for w in words.split():
                w = _squeeze(w)
                self.categories[w] = (*self.categories.get(w, ()), c) if c not in self.categories.get(w, ()) else self.categories[w]
        self.near: dict[str, set[str]] = {}
        self.by_length: dict[int, list[str]] = {}
        for w in self.categories:
            self.by_length.setdefault(len(w), []).append(w)
            if len(w) >= 5:
                for d in self._shorter(w):
                    self.near.setdefault(d, set()).add(w)
        self.find = lru_cache(maxsize=200_000)(self._find)

    @staticmethod
    def _shorter(w: str) -> set[str]:
        return {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}

    def exact(self, word: str) -> str | None:
        """The seed word if only letters are repeated or a plural is formed."""
        w = _squeeze(word)
        if w in self.categories:
            return w
        return w[:-1] if w[-1:] == "s" and w[:-1] in self.categories else None

    def _find(self, word: str) -> str | None:
        """The seed word that is meant, however spelled."""
        if (hit := self.exact(word)) or len(word) < 4:
            return hit
        word = word.strip("*#@!")
        if len(word) < 4:
            return self.exact(word) if word else None
        if not word.isalpha():
            if hit := self.exact(word.translate(_LEET)):
                return hit
            masked = re.sub(r"[*#@$!0-9_]", "?", word)
            if "?" in masked and masked.count("?") * 2 <= len(masked):
                for m in (masked, _squeeze(masked.replace("?", "\0")).replace("\0", "?"), masked[:-1] if masked.endswith("s") else masked):
                    for seed in self.by_length.get(len(m), ()):
                        if all(a in ("?", b) for a, b in zip(m, seed)):
                            return seed
                if masked.count("?") == sum(c in "_0123456789" for c in word):
                    return None  # an identifier
            elif "_" in word:
                return None  # an identifier
            word = re.sub(r"[^a-z]", "", word.translate(_LEET))
        w = _squeeze(word)
        if len(w) < 4:
            return None
        for i in range(1, len(w) - 3):  # words run together
            if (i < 2 or w[:i] in self.categories) and w[i:] in self.categories:
                return w[i:]
        for form in (w, w[:-1]) if w.endswith("s") else (w,):
            for d in self._shorter(form):
                for seed in self.near.get(d, ()):
                    if self._close(form, seed):
                        return seed
        return None

    @staticmethod
    def _close(a: str, b: str) -> bool:
        """At most one letter added, lost or swapped with the next, or, in long words, exchanged."""
        if a == b:
            return True
        if len(a) == len(b):
            diff = [i for i, (x, y) in enumerate(zip(a, b)) if x != y]
            return (len(diff) == 1 and len(a) > 7) or (len(diff) == 2 and diff[1] == diff[0] + 1 and a[diff[0]] == b[diff[1]] and a[diff[1]] == b[diff[0]])
        if abs(len(a) - len(b)) != 1:
            return False
        if len(a) > len(b):
            a, b = b, a
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(index: np.ndarray, starts: np.ndarray, extra: np.ndarray, y: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression over sparse 0/1 features (rows of ``index``) and dense ``extra`` columns, by Adam on all rows."""
    steps, l2 = STEPS, L2
    counts = np.diff(np.append(starts, len(index)))
    w, v = np.zeros(n), np.zeros(extra.shape[1])
    m1, m2 = np.zeros(n + len(v)), np.zeros(n + len(v))
    total = weight.sum()
    for t in range(1, steps + 1):
        z = np.add.reduceat(w[index], starts) + extra @ v
        err = (_sigmoid(z) - y) * weight / total
        g = np.concatenate((np.bincount(index, np.repeat(err, counts), n) + l2 * w, extra.T @ err + l2 * v))
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        step = RATE * (1 - (t - 1) / steps) * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-9)
        w, v = w - step[:n], v - step[n:]
    return w, v


class Chain:
    """Fitted chain: features by name, and per link its weights and those of the links before."""

    def __init__(self, common: set[str], seeds: dict[str, str] = SEEDS):
        self.common, self.seed_words = common, seeds
        self.lexicon = Lexicon(seeds)
        self.harmless: set[str] = set()
        self.features: dict[str, int] = {"": 0}
        self.weights = np.zeros((1, len(CATEGORIES)))
        self.before = [np.zeros(c) for c in range(len(CATEGORIES))]
        self.compile()

    def read(self, words: list[str], fuzzy: bool = True) -> tuple[str, ...]:
        """Words as the model sees them: seeds in plain spelling, rare words as ``~``."""
        out = []
        for w in words:
            if w in self.common:
                out.append(self.lexicon.exact(w) or w)
            elif w in PEOPLE:
                out.append(w)
            else:
                out.append((self.lexicon.find(w) if fuzzy else self.lexicon.exact(w)) or "~")
        for i, pair in enumerate(zip(words, words[1:])):
            if pair in TECHNICAL:
                out[i] = out[i + 1] = "".join(("=", pair[0]))
        return tuple(out)

    def names(self, read: tuple[str, ...]) -> list[str]:
        """Feature names of a wording, with repeats."""
        out = ["", *read, *(f"{a} {b}" for a, b in zip(read, read[1:]))]
        kinds = [self.kind(w) for w in read]
        out += [f"{a} {b}" for a, b, x, y in zip(kinds, kinds[1:], read, read[1:]) if a != x or b != y]
        hits = self.seeds(read)
        if sum(a != x for a, x in zip(kinds, read)) > 1:
            out.append("#several")
        people = any(w in PEOPLE for w in read)
        out += [f"#{c}" for c in sorted(hits)]
        if hits:
            out.append(f"#any {'people' if people else 'nobody'}")
        if people:
            out.append("#people")
        return out

    def kind(self, word: str) -> str:
        """The first category of a seed word in place of the word; other words as they are."""
        return f"<{self.lexicon.categories[word][0]}>" if word in self.lexicon.categories and word not in self.harmless else word

    def seeds(self, read: tuple[str, ...]) -> set[str]:
        """Categories of the seed words that are not common in harmless documents."""
        return {c for w in read if w not in self.harmless for c in self.lexicon.categories.get(w, ())}

    def logits(self, read: tuple[str, ...]) -> np.ndarray:
        """Logits of all links."""
        got = self._cache.get(read)
        if got is None:
            at = [i for i in map(self.features.get, self.names(read)) if i is not None]
            got = self._chain(self.weights[at].sum(0)[None])[0]
            if len(self._cache) > 100_000:
                self._cache.clear()
            self._cache[read] = got
        return got

    def _chain(self, z: np.ndarray) -> np.ndarray:
        """Logits of all links from the sums of their feature weights (rows: wordings)."""
        for c in range(1, z.shape[1]):
            z[:, c] += np.clip(z[:, :c], -8, 8) @ self.before[c]
        return z

    def compile(self) -> None:
        """Lookup tables for scoring many wordings at once."""
        self._cache: dict[tuple, np.ndarray] = {}
        words = sorted({w for f in self.features if f and f[0] != "#" for w in f.split(" ")} - {"~"})
        words = sorted({*words, *(w for w in self.lexicon.categories if self.kind(w) in words)})
        token = {w: i + 1 for i, w in enumerate(words)}
        self._size = len(words) + 1
        self._token: dict[str, int] = {}
        for w in {*self.common, *PEOPLE, *self.lexicon.categories}:
            read = self.read([w], False)[0]
            if read in token:
                self._token[w] = token[read]
        unit = np.zeros((self._size, len(CATEGORIES)))
        pairs: dict[int, int] = {}
        token["~"] = 0
        for f, i in self.features.items():
            if f and f[0] != "#":
                a, _, b = f.partition(" ")
                if b:
                    pairs[token[a] * self._size + token[b]] = i
                else:
                    unit[token[a]] = self.weights[i]
        self._unit = unit
        self._pair_keys = np.array(sorted(pairs) or [-1], np.int64)
        self._pair_weights = np.array([self.weights[pairs[k]] for k in sorted(pairs)] or [np.zeros(len(CATEGORIES))])
        kinds = sorted(c for c in CATEGORIES[:-1])
        self._flags = np.zeros((self._size, len(kinds) + 1), bool)  # seed categories, people
        for w, i in token.items():
            for c in self.seeds((w,)):
                self._flags[i, kinds.index(c)] = True
            self._flags[i, -1] = w in PEOPLE
        self._kind = np.arange(self._size)
        for w, i in token.items():
            if (k := self.kind(w)) != w:
                self._kind[i] = token.get(k, 0)
        zero = np.zeros(len(CATEGORIES))
        weight = lambda f: self.weights[self.features[f]] if f in self.features else zero
        self._flag_weights = np.array([*(weight(f"#{c}") for c in kinds), weight("#people")])
        self._with, self._without, self._base = weight("#any people"), weight("#any nobody"), weight("")
        self._several = weight("#several")

    def score_many(self, texts: list[str | None]) -> np.ndarray:
        """Largest probability over the wordings of each text, per category; the last is the score."""
        best = np.full((len(texts), len(CATEGORIES)), -30.0)
        for s in range(0, len(texts), 500):
            owner: list[int] = []
            found: list[list[str]] = []
            for i in range(s, min(s + 500, len(texts))):
                if texts[i]:
                    ws = wordings(texts[i])
                    found += ws
                    owner += [i] * len(ws)
            if not found:
                continue
            flat = [w for ws in found for w in ws]
            ids = np.fromiter(map(self._token.get, flat, [0] * len(flat)), np.int64, len(flat))
            starts = np.concatenate(([0], np.cumsum([len(ws) for ws in found])[:-1]))
            z = np.add.reduceat(self._unit[ids], starts) + self._base
            text = np.repeat(np.arange(len(found)), np.diff(np.append(starts, len(ids))))
            same = text[1:] == text[:-1]
            kinds = self._kind[ids]
            seed = kinds != ids
            for x, ok in ((ids, same), (kinds, same & (seed[1:] | seed[:-1]))):
                pair = np.flatnonzero(ok)
                key = x[pair] * self._size + x[pair + 1]
                at = np.minimum(np.searchsorted(self._pair_keys, key), len(self._pair_keys) - 1)
                hit = np.flatnonzero(self._pair_keys[at] == key)
                for c in range(len(CATEGORIES)):
                    z[:, c] += np.bincount(text[pair[hit]], self._pair_weights[at[hit], c], len(found))
            z += (np.add.reduceat(seed.astype(np.int64), starts) > 1)[:, None] * self._several
            flags = np.logical_or.reduceat(self._flags[ids], starts)
            z += flags @ self._flag_weights
            seeded, people = flags[:, :-1].any(1), flags[:, -1]
            z += np.where((seeded & people)[:, None], self._with, 0) + np.where((seeded & ~people)[:, None], self._without, 0)
            z = self._chain(z)
            # Wordings with people, seeds or words that may be seeds are read again, in any spelling.
            unknown = {flat[j] for j in np.flatnonzero(ids == 0)}
            meant = {w for w in unknown if ("_" not in w or not w.isidentifier()) and self.lexicon.find(w)}
            again = seeded | people
            if meant:
                again |= np.logical_or.reduceat(np.fromiter((w in meant for w in flat), bool, len(flat)), starts)
            for j in np.flatnonzero(again):
                z[j] = self.logits(self.read(found[j]))
            np.maximum.at(best, np.array(owner), z)
        return _sigmoid(best)

    def fit(self, rows: list[tuple[tuple[str, ...], int, int]], targets: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Fit all links on wordings (read, label, fold); returns out-of-fold logits."""
        lists = []
        counts: Counter = Counter()
        names = [self.names(r[0]) for r in rows]
        for x in names:
            counts.update(set(x))
        self.features = {"": 0}
        for x in sorted(counts):
            if x and counts[x] >= 2:
                self.features[x] = len(self.features)
        for x in names:
            lists.append(np.array(sorted(i for i in map(self.features.get, x) if i is not None), np.int64))
        fold = np.array([r[2] for r in rows])
        before = np.zeros((len(rows), len(CATEGORIES)))
        links = []
        for c in range(len(CATEGORIES)):
            y = targets[:, c]
            for f in range(FOLDS):
                train, test = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                if not len(test) or not len(train):
                    continue
                w, v = fit_linear(*_rows(lists, train), np.clip(before[train, :c], -8, 8), y[train], weight[train], len(self.features))
                before[test, c] = np.add.reduceat(w[_rows(lists, test)[0]], _rows(lists, test)[1]) + np.clip(before[test, :c], -8, 8) @ v
            links.append(fit_linear(*_rows(lists, np.arange(len(rows))), np.clip(before[:, :c], -8, 8), y, weight, len(self.features)))
        self.weights = np.stack([w for w, _ in links], 1)
        self.before = [v for _, v in links]
        self.compile()
        return before

    def shift(self, by: float) -> None:
        """Lower the logits of the last link."""
        self.weights[0, -1] -= by
        self.compile()

    def by_seeds(self) -> Chain:
        """Without labels: a seed word next to a word that addresses or names people is abusive, of the categories of the seed."""
        self.features = {"": 0, "#any people": 1} | {f"#{c}": i + 2 for i, c in enumerate(CATEGORIES[:-1])}
        self.weights = np.zeros((len(self.features), len(CATEGORIES)))
        self.weights[0] = -4
        self.weights[1] = 2
        self.weights[1, -1] = 6
        for i in range(len(CATEGORIES) - 1):
            self.weights[i + 2, i] = 4
        self.compile()
        return self

    def __getstate__(self) -> dict:
        return {k: getattr(self, k) for k in ("common", "seed_words", "harmless", "features", "weights", "before")}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["common"], state["seed_words"])
        self.__dict__.update(state)
        self.compile()


def _rows(lists: list[np.ndarray], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    picked = [lists[i] for i in at]
    sizes = np.array([len(x) for x in picked])
    return np.concatenate(picked), np.concatenate(([0], np.cumsum(sizes)[:-1]))


def train_chain(documents: Iterable[tuple[int, str, int]], seeds: dict[str, str] = SEEDS) -> Chain:
    """Chain fitted on labelled documents ``(id, text, label 0 or 1)``."""
    docs = sorted(((i, wordings(t), y) for i, t, y in documents if t), key=lambda d: d[0])
    seen: Counter = Counter()
    for _, ws, y in docs:
        seen.update({w for words in ws for w in words})
    least = min(COMMON, max(2, len(docs) // 40))
    chain = Chain({w for w, n in seen.items() if n >= least}, seeds)
    # Seed words that stand about as often in harmless documents are no seeds here (another language's or a technical word).
    n_docs = [max(1, sum(y == k for *_, y in docs)) for k in (0, 1)]
    share: dict[str, list[float]] = {}
    for _, ws, y in docs:
        for w in {h for words in ws for w in words if (h := chain.lexicon.exact(w))}:
            share.setdefault(w, [0.0, 0.0])[y] += 1 / n_docs[y]
    chain.harmless = {w for w, (no, yes) in share.items() if no * n_docs[0] >= 3 and yes < 4 * no}
    if not all(any(y == k for *_, y in docs) for k in (0, 1)):
        return chain.by_seeds()
    merged: dict[tuple, list] = {}
    for i, ws, y in docs:
        fold = int(np.uint64(i * 0x9E3779B97F4A7C15 % (1 << 64)) >> np.uint64(40)) % FOLDS
        reads = [chain.read(words) for words in ws]
        for r in reads:
            m = merged.setdefault(r, [0, 0, fold, False])
            m[y] += 1
    cats = {r: chain.seeds(r) for r in merged}
    signs = _signs(chain, docs)
    witness: set[tuple] = set()  # in each document judged abusive, the wordings that speak most for it
    for _, ws, y in docs:
        if y:
            told = {r: _evidence(chain, r, signs) for r in map(chain.read, ws)}
            witness.update(r for r, e in told.items() if e >= EVIDENCE and e >= 0.7 * max(told.values()))
    rows, kind = [], []
    for n, (r, m) in enumerate(sorted(merged.items(), key=lambda x: (x[0] not in witness, not cats[x[0]], not any(w in PEOPLE for w in x[0]), hash_of(x[0])))):
        if n >= MAX_WORDINGS:
            break
        rows.append((r, 0, m[2]))
        kind.append((m[0], m[1], bool(cats[r]), r in witness))
    no, yes, seeded, seen_to = (np.array(x) for x in zip(*kind))
    strong = np.array([bool(cats.get(r[0])) and any(w in PEOPLE for w in r[0]) for r in rows])
    only_yes = (yes > 0) & (no == 0)
    told = seeded | seen_to
    signed = np.array([_evidence(chain, r[0], signs) > 0 for r in rows])
    label = ((yes / np.maximum(no + yes, 1) > 0.5) & told).astype(float)
    if not label.any():
        return chain.by_seeds()
    use = ~(only_yes & ~told)  # other wordings of abusive documents: not known yet
    kinds = np.array([[c in cats.get(r[0], ()) for c in CATEGORIES[:-1]] for r in rows], float)
    for stage in range(3):
        targets = np.column_stack([label[:, None] * kinds, label])
        at = np.flatnonzero(use)
        weight = np.sqrt(1.0 + no + yes)[at]
        weight *= np.where(label[at] > 0, max(1.0, BALANCE * weight[label[at] == 0].sum() / max(weight[label[at] > 0].sum(), 1e-9)), 1.0)
        oof = chain.fit([rows[i] for i in at], targets[at], weight)
        score = np.array([chain.logits(r[0]) for r in rows])
        score[at] = oof
        if stage == 2:
            break
        p = _sigmoid(score[:, -1])
        wrong_no = (yes == 0) & (no <= 2) & seeded & strong & (p > 0.8)  # judged harmless, yet surely abusive
        wrong_yes = (label > 0) & (p < 0.35) & (yes - 3 * no < 4)  # not so if several documents agree
        label = np.where(only_yes & ~told & (p > 0.5) & signed, 1.0, label)
        label = np.where(wrong_no, 1.0, np.where(wrong_yes, 0.0, label))
        use = ~(only_yes & (label == 0) & (p > 0.1) & (p <= 0.5))
        kinds = np.where(seeded[:, None], kinds, score[:, :-1] > 0)  # a wording without seed words is of the categories that the chain finds
    of = {r[0]: z for r, z in zip(rows, score[:, -1])}
    chain.shift(_threshold([(max((of[r] for r in map(chain.read, ws) if r in of), default=-30.0), y) for _, ws, y in docs]))
    return chain


def _threshold(judged: list[tuple[float, int]]) -> float:
    """The logit that tells judged documents apart best (F1 of out-of-fold scores), or 0 if that is hardly worse."""
    z, y = np.array([z for z, _ in judged]), np.array([y for _, y in judged])

    def f1(t: float) -> float:
        return 2 * (y[z >= t].sum()) / max(1, (z >= t).sum() + y.sum())

    best = max([0.0, *np.unique(np.round(z, 1)) + 0.05], key=lambda t: (f1(t), -abs(t)))
    return float(best) if f1(best) > f1(0.0) + GAIN else 0.0


def _signs(chain: Chain, docs: list) -> dict[str, float]:
    """Log odds of the features that stand in abusive documents too often for chance, given how many features there are; rare words, which may be names, say nothing."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for _, ws, y in docs:
        counts[y].update({f for words in ws for f in chain.names(chain.read(words))})
    total = [max(1, sum(y == k for *_, y in docs)) for k in (0, 1)]
    out = {}
    for f, n in counts[1].items():
        if not f or "~" in f:
            continue
        expected = (n + counts[0][f]) * total[1] / sum(total)
        if n > expected and n * np.log(n / expected) - (n - expected) > SURE + np.log(len(counts[1])):
            out[f] = float(np.log((n + 0.5) / (total[1] + 1)) - np.log((counts[0][f] + 0.5) / (total[0] + 1)))
    return out


def _evidence(chain: Chain, read: tuple[str, ...], signs: dict[str, float]) -> float:
    """The strongest sign of a wording."""
    return max((signs.get(f, 0.0) for f in chain.names(read)), default=0.0)


def hash_of(read: tuple[str, ...]) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(" ".join(read))


def labelled(documents: DataFrame, labels: DataFrame) -> list[tuple[int, str, int]]:
    """At most MAX_LABELLED labelled documents ``(doc, text, label)``: those of the smallest id hashes."""
    votes = labels.select("doc", "label").where("label in (0, 1) and doc is not null").groupBy("doc").agg(F.sum(F.col("label") * 2 - 1).alias("v")).where("v <> 0")
    votes = votes.orderBy(F.xxhash64("doc"), "doc").limit(MAX_LABELLED)
    rows = documents.select("doc", "text").where("text is not null").join(F.broadcast(votes), "doc").select("doc", "text", (F.col("v") > 0).cast("int").alias("y")).collect()  # at most MAX_LABELLED rows
    return [(r.doc, r.text, r.y) for r in rows]


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: Chain = shared.value
        for batch in batches:
            got = chain.score_many(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(got[:, c]) for c in range(len(CATEGORIES))]], names=["doc", *CATEGORIES])

    return run


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc`` and the probability of each category for every document.

    ``documents``: ``doc long, text``; ``labels``: ``doc, label`` (1, 0 or null).
    """
    spark = documents.sparkSession
    chain = train_chain(labelled(documents, labels))
    shared = spark.sparkContext.broadcast(chain)  # bounded by MAX_WORDINGS
    schema = "doc long, " + ", ".join(f"{c} double" for c in CATEGORIES)
    return documents.select("doc", "text").mapInArrow(_score(shared), schema)
