"""Exact likeness and banded alignment of candidate pairs, and copies of texts.

The likeness of two texts is the number of distinct runs of ``k`` words found in
both divided by the number found in either; texts without such a run have none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import flatwords as fw

#: Identifiers of candidate documents are broadcast up to this many (8 bytes each), else joined by shuffle.
BROADCAST_IDS = 1_000_000
BAND = 32
_FAR = np.int32(1 << 20)


def text_keys(w: fw.Words) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per text that depend on its sequence of words only."""
    if not len(w.hashes):
        return np.zeros(w.n, np.int64), np.zeros(w.n, np.int64)
    at = (np.arange(len(w.hashes)) - np.repeat(w.starts, w.counts)).astype(np.uint64)
    keys = []
    for c in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)):
        v = fw.mix(w.hashes ^ (at * c + c))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(v)))
        keys.append((total[w.starts + w.counts] - total[w.starts]).view(np.int64))
    return keys[0], keys[1]


def distinct_grams(w: fw.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word runs of each text: (text, hash), sorted by text, then hash."""
    h, text, _ = fw.grams(w, k)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return text[new], h[new]


def pair_likeness(x: fw.Words, y: fw.Words, k: int) -> np.ndarray:
    """Likeness of text i of x and text i of y."""
    tx, hx = distinct_grams(x, k)
    ty, hy = distinct_grams(y, k)
    nx, ny = np.bincount(tx, minlength=x.n), np.bincount(ty, minlength=y.n)
    text, h = np.concatenate((tx, ty)), np.concatenate((hx, hy))
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    both = (text[1:] == text[:-1]) & (h[1:] == h[:-1])
    shared = np.bincount(text[1:][both], minlength=x.n)
    return shared / np.maximum(nx + ny - shared, 1)


def edit_similarity(x: fw.Words, y: fw.Words, band: int = BAND) -> np.ndarray:
    """1 - word edits / words of the longer text, aligned within a band around the diagonal.

    NaN where the lengths differ by more than the band.  All pairs advance
    together, one row of the alignment per step.
    """
    n, width = x.n, 2 * band + 1
    la, lb = x.counts, y.counts
    out = np.full(n, np.nan)
    todo = np.flatnonzero(np.abs(la - lb) <= band)
    todo = todo[np.argsort(la[todo], kind="stable")]
    ramp = np.arange(width, dtype=np.int32)
    for s in range(0, len(todo), 512):
        ids = todo[s : s + 512]
        a_len, b_len = la[ids], lb[ids]
        rows = int(a_len.max(initial=0))
        a = np.zeros((len(ids), rows + 1), np.uint64)
        b = np.zeros((len(ids), int(b_len.max(initial=0)) + 2 * width + rows), np.uint64)
        for r, i in enumerate(ids):
            a[r, : la[i]] = x.hashes[x.starts[i] : x.starts[i] + la[i]]
            b[r, band + 1 : band + 1 + lb[i]] = y.hashes[y.starts[i] : y.starts[i] + lb[i]]
        col = ramp - band  # column j of cell k in row i is i + k - band
        d = np.where((col >= 0) & (col <= b_len[:, None]), col, _FAR).astype(np.int32)
        dist = np.where(a_len == 0, b_len, _FAR)
        for i in range(1, rows + 1):
            low = int(np.searchsorted(a_len, i))  # pairs are sorted by length; shorter ones are done
            prev = d[low:]
            step = prev + (a[low:, i - 1, None] != b[low:, i : i + width])
            step[:, :-1] = np.minimum(step[:, :-1], prev[:, 1:] + 1)
            j = col + i
            step[:, j < 0] = _FAR
            step = np.where(j <= b_len[low:, None], step, _FAR)
            step = np.minimum.accumulate(step - ramp, axis=1) + ramp
            d[low:] = np.minimum(np.where((j >= 0) & (j <= b_len[low:, None]), step, _FAR), _FAR)
            ended = low + np.flatnonzero(a_len[low:] == i)
            dist[ended] = d[ended, (b_len - a_len)[ended] + band]
        longest = np.maximum(np.maximum(a_len, b_len), 1)
        out[ids] = 1 - np.minimum(dist, longest) / longest
    return out


def _verify(k: int, measure: Callable[[fw.Words, fw.Words], np.ndarray], min_likeness: float, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                texts_a, texts_b = part.column(2).to_pylist(), part.column(3).to_pylist()
                for x, y in zip(fw.pieces(texts_a, 1 << 62), fw.pieces(texts_b, 1 << 62)):
                    like, got = pair_likeness(x, y, k), measure(x, y)
                    keep = np.flatnonzero((like >= min_likeness) | (np.nan_to_num(got, nan=-1.0) >= least))
                    cols = [part.column(0).take(pa.array(keep)), part.column(1).take(pa.array(keep))]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(like[keep]), pa.array(got[keep])], names=["a", "b", "likeness", "measure"])

    return run


def verify_pairs(pairs: DataFrame, texts: DataFrame, measure: Callable[[fw.Words, fw.Words], np.ndarray], name: str, k: int = 3, min_likeness: float = 0.6, least: float = 2.0) -> DataFrame:
    """``a, b, likeness`` and a second measure of candidate pairs ``a, b`` that reach one of the bounds.

    ``texts``: ``doc, text``; only the documents of the pairs are shuffled.
    """
    docs = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct()
    few = docs.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    used = texts.join(F.broadcast(docs) if few else docs, "doc", "left_semi").dropDuplicates(["doc"])
    x = used.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    y = used.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(_verify(k, measure, min_likeness, least), "a long, b long, likeness double, measure double").withColumnRenamed("measure", name)


def expand_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of documents from pairs of representatives: ``x < y``.

    ``members``: unique ``rep, doc``.  Copies of one text are paired with each other, too.
    """
    m1 = members.select(F.col("rep").alias("a"), F.col("doc").alias("x"))
    m2 = members.select(F.col("rep").alias("b"), F.col("doc").alias("y"))
    across = pairs.select("a", "b").join(m1, "a").join(m2, "b").select("x", "y")
    several = members.groupBy(F.col("rep").alias("a")).agg(F.count("*").alias("n")).where("n > 1").select("a")
    repeated = m1.join(several, "a", "left_semi")
    copies = repeated.join(m2.withColumnRenamed("b", "a"), "a").select("x", "y").where("x < y")
    out = across.unionByName(copies)
    return out.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
