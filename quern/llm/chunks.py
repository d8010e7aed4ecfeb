"""Same or near-same records across splits, by content-defined chunks.

*Chunks.*  A rolling hash over the last WINDOW words cuts a normalised record
wherever its value is divisible by DIVISOR, so cuts depend on nearby words only
and an edit changes the chunks around it, not those after it.  LAYERS rolling
hashes with different seeds cut every record in as many ways; a chunk's digest is
taken over its words and layer.

*Overlap.*  ``record_overlaps`` joins the chunk digests of one side (train, evaluation)
with the distinct digests of the other, and sums for every record the lengths of its
chunks that occur there: the part of the record that the other side holds, in one record
or in many.  A digest is one row per side in that join, however frequent.

*Pairs.*  ``cross_overlaps`` joins digests between the sides through ``bucket_pairs``
and sums the lengths of the chunks that two records share; candidates share at least
MIN_OVERLAP of the shorter one.  Chunks that more than COLD records hold pair none of
them; the exact way for these and for records with too few chunks are prefix keys over
3-word runs (``prefix``), which have no bound.  For all candidates the overlap fraction
is summed over all shared chunks, and the exact likeness decides.

Copies (records with the same words) are one representative while chunks are
joined.  Defined cases: null and blank texts are like nothing and overlap with
nothing; records in neither side are left out; a text that stands on both sides pairs
its own records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import flatwords as fw
from quern.llm.buckets import bucket_pairs
from quern.llm.likeness import text_keys, verify_pairs
from quern.llm.prefix import gram_order, prefix_keys, prefix_pairs
from quern.plans.stage import Stage

WINDOW = 2
DIVISOR = 6
LAYERS = 2
MIN_OVERLAP = 0.1
MIN_LIKENESS = 0.6


def content_chunks(w: fw.Words, layer: int, window: int = WINDOW, divisor: int = DIVISOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of all texts: (text, digest, number of words)."""
    n = len(w.hashes)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    text = w.text_of_word()
    seed = 0x9E3779B97F4A7C15 * (2 * layer + 3)
    rolling = np.zeros(n, np.uint64)
    for i in range(window):
        rolling[i:] += fw.mix(w.hashes[: n - i] + np.uint64(seed * (i + 1) % (1 << 64)))
    cut = fw.mix(rolling) % np.uint64(divisor) == 0
    at = np.arange(n) - np.repeat(w.starts, w.counts)
    cut &= at >= window - 1  # windows that reach into the text before do not count
    last = np.append(text[1:] != text[:-1], True)
    ends = np.flatnonzero(cut | last) + 1
    begins = np.concatenate(([0], ends[:-1]))
    order = (np.arange(n) - np.repeat(begins, ends - begins)).astype(np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(fw.mix(w.hashes + order * np.uint64(0xC2B2AE3D27D4EB4F)))))
    digest = fw.mix((total[ends] - total[begins]) * np.uint64(2 * layer + 1) + (ends - begins).astype(np.uint64))
    return text[begins], digest.view(np.int64), ends - begins


def chunk_sums(w: fw.Words, layer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct chunks of all texts: (text, digest, words in all places of it), sorted by text."""
    text, digest, size = content_chunks(w, layer)
    order = np.lexsort((digest, text))
    text, digest, size = text[order], digest[order], size[order]
    if not len(text):
        return text, digest, size
    first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (digest[1:] != digest[:-1]))))
    return text[first], digest[first], np.add.reduceat(size, first)


def overlap_fraction(x: fw.Words, y: fw.Words) -> np.ndarray:
    """Words in chunks that text i of x shares with text i of y, over the words of the shorter, as a mean of all layers."""
    shared = np.zeros(x.n)
    for layer in range(LAYERS):
        text, digest, size = (np.concatenate(z) for z in zip(chunk_sums(x, layer), chunk_sums(y, layer)))
        order = np.lexsort((digest, text))
        text, digest, size = text[order], digest[order], size[order]
        both = np.flatnonzero((text[1:] == text[:-1]) & (digest[1:] == digest[:-1]))
        np.add.at(shared, text[both], np.minimum(size[both], size[both + 1]))
    return shared / np.maximum(np.minimum(x.counts, y.counts) * LAYERS, 1)


def _chunk_lists(w: fw.Words, layers: int) -> list[pa.Array]:
    text, digest, size = (np.concatenate(x) for x in zip(*(chunk_sums(w, layer) for layer in range(layers))))
    order = np.argsort(text, kind="stable")
    offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(text, minlength=w.n)))).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(x[order], t)) for x, t in ((digest, pa.int64()), (size, pa.int32()))]


def _cut(min_likeness: float, grams: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, mask = batch.column(0), batch.column(2)
            for w in fw.pieces(batch.column(1).to_pylist()):
                prefix, runs = prefix_keys(w, 3, min_likeness, grams.value)
                cols = [docs.slice(w.first, w.n), mask.slice(w.first, w.n), *map(pa.array, text_keys(w)), pa.array(w.counts), *_chunk_lists(w, LAYERS), *prefix, pa.array(runs, pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc", "mask", "t1", "t2", "words", "digests", "sizes", "prefix", "places", "runs"])

    return run


def cross_overlaps(records: DataFrame, min_likeness: float = MIN_LIKENESS) -> tuple[DataFrame, DataFrame]:
    """Pairs of similar texts of which one is in train and one in evaluation, and the texts' members.

    ``records``: ``doc long (unique), text, mask byte`` (1 train, 2 evaluation).
    Returns pairs of representatives ``a < b, likeness, overlap`` and the members
    ``rep, doc, mask``.
    """
    stage = Stage(records.sparkSession, "chunks")
    schema = "doc long, mask byte, t1 long, t2 long, words long, digests array<long>, sizes array<int>, prefix array<long>, places array<int>, runs int"
    records = records.where("doc is not null and text is not null and mask in (1, 2)").select("doc", "text", "mask")
    grams = gram_order(records, 3)
    cut = stage.write(records.mapInArrow(_cut(min_likeness, grams), schema).where("words > 2"))
    all_records = stage.last
    grams.unpersist()
    ids = cut.groupBy("t1", "t2").agg(F.min("doc").alias("rep"), F.bit_or("mask").alias("mask"))
    members = stage.write(cut.select("t1", "t2", "doc", F.col("mask").alias("own")).join(ids, ["t1", "t2"]).select("rep", "doc", "own", "mask"))
    reps = stage.write(cut.drop("mask").join(members.where("doc = rep").select("doc", "mask"), "doc").select("doc", "mask", "words", "runs", F.arrays_zip("digests", "sizes").alias("c"), F.arrays_zip("prefix", "places").alias("p")))
    stage.drop(all_records)
    representatives = stage.last
    rows = reps.select("doc", "mask", F.explode("c").alias("c")).select(F.col("c.digests").alias("key"), "doc", "mask", F.col("c.sizes").alias("weight"))
    words = reps.select("doc", "words")
    pairs = bucket_pairs(rows).join(words.toDF("a", "words_a"), "a").join(words.toDF("b", "words_b"), "b")
    pairs = pairs.where(F.col("weight") >= MIN_OVERLAP * LAYERS * F.least("words_a", "words_b")).select("a", "b")
    keys = reps.select("doc", "mask", "runs", F.explode("p").alias("p")).select(F.col("p.prefix").alias("key"), "doc", "mask", F.col("p.places").alias("place"), "runs")
    pairs = stage.write(pairs.unionByName(prefix_pairs(keys, min_likeness)).distinct())
    stage.drop(representatives)
    candidates = stage.last
    sure = stage.write(verify_pairs(pairs, records.select("doc", "text"), overlap_fraction, "overlap", 3, min_likeness))
    stage.drop(candidates)
    return sure, members.select("rep", "doc", F.col("own").alias("mask"))


def _chunks_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in fw.pieces(batch.column(1).to_pylist()):
            cols = [batch.column(0).slice(w.first, w.n), batch.column(2).slice(w.first, w.n), pa.array(w.counts), *_chunk_lists(w, 1)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc", "mask", "words", "digests", "sizes"])


def record_overlaps(records: DataFrame) -> DataFrame:
    """``doc, mask, words, shared, overlap``: of each record the words in chunks that the other side holds, and their fraction.

    ``records`` as for ``cross_overlaps``.  A record without words has the overlap 0.
    """
    stage = Stage(records.sparkSession, "overlaps")
    records = records.where("doc is not null and mask in (1, 2)").select("doc", "text", "mask")
    cut = stage.write(records.mapInArrow(_chunks_only, "doc long, mask byte, words long, digests array<long>, sizes array<int>"))
    chunks = cut.select("doc", "mask", F.explode(F.arrays_zip("digests", "sizes")).alias("c")).select("doc", "mask", F.col("c.digests").alias("key"), F.col("c.sizes").alias("size"))
    both = chunks.groupBy("key").agg(F.bit_or("mask").alias("sides")).where("sides = 3").select("key")
    shared = chunks.join(both, "key", "left_semi").groupBy("doc").agg(F.sum("size").alias("shared"))
    out = cut.select("doc", "mask", "words").join(shared, "doc", "left").na.fill(0, ["shared"])
    return out.select("doc", "mask", "words", "shared", F.when(F.col("words") > 0, F.col("shared") / F.col("words")).otherwise(0.0).alias("overlap"))


def expand_across(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``train_doc, eval_doc, overlap, likeness`` of all records, copies included."""
    same = members.groupBy("rep").agg(F.bit_or("mask").alias("m")).where("m = 3")
    own = same.select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.lit(1.0).alias("likeness"), F.lit(1.0).alias("overlap"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "likeness", "overlap")).unionByName(own)
    train = members.where("mask = 1").select(F.col("rep").alias("a"), F.col("doc").alias("train_doc"))
    evaluation = members.where("mask = 2").select(F.col("rep").alias("b"), F.col("doc").alias("eval_doc"))
    return both.join(train, "a").join(evaluation, "b").select("train_doc", "eval_doc", "overlap", "likeness")
