"""Evaluation texts leaking into training text, by a generalised suffix automaton.

The normalised words of all test items form one automaton: each state stands for
word runs that occur at the same places of the items.  Training text is streamed
through it word by word while the length of the longest run that ends here and
occurs in an item is tracked; where it reaches ``min_words`` the items that hold
the run are read from the state's anchor (its ancestor that holds the last
``min_words`` words).  Words that no item has end every match, so only stretches
of at least ``min_words`` known words are streamed; this loses nothing.

The automaton is built on the driver and broadcast.  Its size is proven: at most
MAX_WORDS words of items, counted as the automaton counts them, or one item, make one
automaton (fewer than two states per word); larger sets are cut into blocks of items,
each a pass of its own.

``clean`` removes the matched spans of at least ``min_words`` words, and drops a
text altogether when the spans cover more than ``max_coverage`` of its words.

Defined cases: null and blank texts or items match nothing; runs do not cross
from one text or item field to another; an item in several spans of one text is
reported once; an empty item set gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import flatwords as fw

MIN_WORDS = 12
MAX_COVERAGE = 0.5
MAX_WORDS = 500_000


class Automaton:
    """Generalised suffix automaton over word hashes of ``(item, texts)``."""

    def __init__(self, items: Iterable[tuple[int, list[str | None]]], min_words: int = MIN_WORDS):
        self.min_words = min_words
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        runs = []
        for item, texts in items:
            for w in fw.pieces(texts, 1 << 62):
                for t in range(w.n):
                    runs.append((item, w.hashes[w.starts[t] : w.starts[t] + w.counts[t]].tolist()))
        for _, run in runs:
            last = 0
            for c in run:
                last = self._extend(last, c)
        self.vocabulary = np.array(sorted(self.next[0]), np.uint64)
        marks: dict[int, set[int]] = {}
        for item, run in runs:
            s = 0
            for c in run:
                s = self.next[s][c]
                v = s
                while v > 0 and self.length[v] >= min_words and item not in marks.setdefault(v, set()):
                    marks[v].add(item)
                    v = self.link[v]
        self.items = {v: tuple(sorted(x)) for v, x in marks.items() if self.length[self.link[v]] < min_words}
        self.anchor = {}
        for s in marks:
            v = s
            while self.length[self.link[v]] >= min_words:
                v = self.link[v]
            self.anchor[s] = v

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        q = nxt[last].get(c)
        if q is not None:  # the run is known already: no new state, at most a split
            return q if length[q] == length[last] + 1 else self._split(last, q, c)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, q, c)
        return cur

    def _split(self, p: int, q: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        link[q] = clone
        return clone

    def spans(self, run: list[int]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Matched spans (first word, end) of at least min_words words, merged; their items; the longest match."""
        nxt, link, length, least = self.next, self.link, self.length, self.min_words
        out: list[list[int]] = []
        items: set[int] = set()
        s = n = longest = 0
        for i, c in enumerate(run):
            while s and c not in nxt[s]:
                s = link[s]
                n = length[s]
            s = nxt[s].get(c, 0)
            n = n + 1 if s else 0
            if n >= least:
                items.update(self.items[self.anchor[s]])
                longest = max(longest, n)
                if out and i + 1 - n <= out[-1][1]:
                    out[-1][1] = i + 1
                    out[-1][0] = min(out[-1][0], i + 1 - n)
                else:
                    out.append([i + 1 - n, i + 1])
        return [(a, b) for a, b in out], items, longest


_LEAKS = "doc long, field string, items array<long>, words long, covered long, longest long, spans long, dropped boolean, cleaned string, parts array<struct<first:long,end:long>>"
_CLEANED = ["doc", "field", "words", "covered", "longest", "spans", "dropped", "cleaned"]


def _known_stretches(known: np.ndarray, text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the stretches of at least ``least`` known words inside one text."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.concatenate(([False], (text[1:] == text[:-1]) & known[1:] & known[:-1]))
    first = np.flatnonzero(known & ~same)
    follows = np.append(same[1:], False)
    end = np.flatnonzero(known & ~follows) + 1
    long_enough = end - first >= least
    return first[long_enough], end[long_enough]


def _match(shared, fields: list[str], max_coverage: float, with_clean: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto: Automaton = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            rows: list[tuple] = []
            for f, field in enumerate(fields):
                texts = batch.column(f + 1).to_pylist()
                for w in fw.pieces(texts):
                    at = np.searchsorted(auto.vocabulary, w.hashes)
                    known = auto.vocabulary[np.minimum(at, len(auto.vocabulary) - 1)] == w.hashes
                    text = w.text_of_word()
                    hits: dict[int, list] = {}
                    for a, b in zip(*_known_stretches(known, text, auto.min_words)):
                        spans, items, longest = auto.spans(w.hashes[a:b].tolist())
                        if spans:
                            hit = hits.setdefault(int(text[a]), [[], set(), 0])
                            hit[0] += [(a + x, a + y) for x, y in spans]
                            hit[1] |= items
                            hit[2] = max(hit[2], longest)
                    for t, (spans, items, longest) in hits.items():
                        words, covered = int(w.counts[t]), sum(b - a for a, b in spans)
                        drop = covered > max_coverage * words
                        cleaned = _cut(w, t, spans) if with_clean and not drop else None
                        parts = [{"first": int(a - w.starts[t]), "end": int(b - w.starts[t])} for a, b in spans] if with_clean else None
                        rows.append((int(ids[w.first + t]), field, sorted(items), words, covered, longest, len(spans), drop, cleaned, parts))
            if rows:
                names = ["doc", "field", "items", "words", "covered", "longest", "spans", "dropped", "cleaned", "parts"]
                types = [pa.int64(), pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def _cut(w: fw.Words, t: int, spans: list[tuple[int, int]]) -> str:
    """Text t without the bytes of the spans."""
    out, at = [], int(w.text_begin[t])
    for a, b in spans:
        out.append(w.data[at : int(w.begin[a])])
        at = int(w.end[b - 1])
    out.append(w.data[at : int(w.text_begin[t + 1]) - 1])
    return b"".join(out).decode("utf-8", "replace")


def _blocks(items: DataFrame, fields: list[str]) -> Iterator[list[tuple[int, list[str | None]]]]:
    block, words = [], 0
    for r in items.toLocalIterator():
        texts = [r[f] for f in fields]
        n = sum(len(w.hashes) for w in fw.pieces(texts, 1 << 62))
        if block and words + n > MAX_WORDS:
            yield block
            block, words = [], 0
        block.append((r["item"], texts))
        words += n
    if block:
        yield block


def find_leaks(
    docs: DataFrame, doc_fields: list[str], items: DataFrame, item_fields: list[str], min_words: int = MIN_WORDS, max_coverage: float = MAX_COVERAGE, with_clean: bool = False
) -> DataFrame:
    """One row per text of ``docs`` (columns ``doc`` and doc_fields) and block of items that holds item passages.

    ``items``: ``item`` and item_fields.  Returns ``doc, field, items, words,
    covered, longest, spans, dropped, cleaned, parts`` (the spans as word numbers, with_clean only).
    """
    parts = _leaks_by_block(docs, doc_fields, items, item_fields, min_words, max_coverage, with_clean)
    return reduce(DataFrame.unionByName, parts) if parts else docs.sparkSession.createDataFrame([], _LEAKS)


def _leaks_by_block(docs: DataFrame, doc_fields: list[str], items: DataFrame, item_fields: list[str], min_words: int, max_coverage: float, with_clean: bool) -> list[DataFrame]:
    out = []
    for block in _blocks(items.where("item is not null").select("item", *item_fields), item_fields):
        auto = Automaton(block, min_words)
        if not auto.items:
            continue
        shared = docs.sparkSession.sparkContext.broadcast(auto)
        out.append(docs.where("doc is not null").select("doc", *doc_fields).mapInArrow(_match(shared, doc_fields, max_coverage, with_clean), _LEAKS))
    return out


def _merged(max_coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, fields, longest, parts, texts = (c.to_pylist() for c in batch.columns)
            rows = []
            for w in fw.pieces(texts):
                for t in range(w.n):
                    i, start = w.first + t, int(w.starts[t])
                    spans: list[list[int]] = []
                    for a, b in sorted((start + p["first"], start + p["end"]) for p in parts[i]):
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], b)
                        else:
                            spans.append([a, b])
                    words, covered = int(w.counts[t]), sum(b - a for a, b in spans)
                    drop = covered > max_coverage * words
                    rows.append((docs[i], fields[i], words, covered, longest[i], len(spans), drop, None if drop else _cut(w, t, spans)))
            if rows:
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_CLEANED)

    return run


def cleaned_texts(docs: DataFrame, doc_fields: list[str], items: DataFrame, item_fields: list[str], min_words: int = MIN_WORDS, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """One row per affected text, spans of all blocks of items merged: ``doc, field, words, covered, longest, spans, dropped, cleaned``."""
    parts = _leaks_by_block(docs, doc_fields, items, item_fields, min_words, max_coverage, True)
    if len(parts) < 2:
        return (parts[0] if parts else docs.sparkSession.createDataFrame([], _LEAKS)).select(_CLEANED).dropDuplicates(["doc", "field"])
    found = reduce(DataFrame.unionByName, parts).groupBy("doc", "field").agg(F.max("longest").alias("longest"), F.flatten(F.collect_set("parts")).alias("parts"))
    texts = docs.select("doc", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in doc_fields])).alias("t"))
    texts = texts.select("doc", "t.field", "t.text").dropDuplicates(["doc", "field"])
    rows = found.join(texts, ["doc", "field"]).select("doc", "field", "longest", "parts", "text")
    return rows.mapInArrow(_merged(max_coverage), "doc long, field string, words long, covered long, longest long, spans long, dropped boolean, cleaned string")


def leaked_items(leaks: DataFrame) -> DataFrame:
    """Unique ``item, doc``."""
    return leaks.select(F.explode("items").alias("item"), "doc").distinct()
