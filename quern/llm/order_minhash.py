"""Near-duplicate records with small edits, by Order MinHash.

*Sketch.*  The k-mers (runs of K words) of a text are labelled with their number
of occurrence, so repeats count.  Each of SKETCHES orderings picks the PICKS
smallest labelled k-mers and hashes them in the order in which they stand in the
text: two texts agree in a sketch with about (weighted likeness) ** PICKS, less
where their parts are reordered.

*Candidates.*  Texts that agree in at least MIN_SHARED sketches of at most COLD texts
(``buckets``).  Sketches miss texts whose parts repeat or move, and a sketch that many
texts share pairs none of them: the exact way for both are the prefix keys over the
distinct k-mers (``prefix``), which miss no pair that can reach the likeness, however
large the family, and have no bound.

*Classes.*  ``similar_classes`` needs no pairs within a family: every text is linked to
the first text of its sketches (of at least MIN_SHARED of them), however many share it; what these links join is
one class already, and the prefix keys then pair texts of different classes only.

*Verification.*  Word alignment in a band around the diagonal, for all candidates
of a batch at once, gives the edit similarity; the exact likeness settles pairs
whose parts were moved out of the band.

Copies (texts with the same sequence of words) are reduced to one representative,
the smallest id, before keys are made, so a text repeated by a third of all rows
is sketched into one row per key.  Defined cases: a null or blank text is no
case; texts without a k-word run are like nothing; several rows of one id are
taken as one; ids must be long integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import is_blank
from quern.llm import flatwords as fw
from quern.llm.buckets import bucket_pairs
from quern.llm.likeness import edit_similarity, text_keys, verify_pairs
from quern.llm.prefix import gram_order, prefix_keys, prefix_pairs
from quern.llm.splits import hash_to_min
from quern.plans.stage import Stage

K = 3
PICKS = 3
SKETCHES = 48
MIN_SHARED = 2
MIN_LIKENESS = 0.6
MIN_EDIT = 0.8
_POS = np.uint64(24)
_LOW = np.uint64((1 << 24) - 1)
_ALL = np.uint64((1 << 64) - 1)


def order_sketches(w: fw.Words, k: int, picks: int, sketches: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts with at least ``picks`` k-mers, their sketches as rows)."""
    h, text, _ = fw.grams(w, k)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros((0, sketches), np.int64)
    key = fw.mix(h + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    index = np.arange(len(order))
    first = np.maximum.accumulate(np.where(np.concatenate(([True], sorted_key[1:] != sorted_key[:-1])), index, 0))
    label = np.empty(len(order), np.uint64)
    label[order] = (index - first).astype(np.uint64)
    h = fw.mix(h + label * np.uint64(0xD6E8FEB86659FD93))
    starts = np.searchsorted(text, np.arange(w.n))
    enough = np.flatnonzero(np.diff(np.append(starts, len(text))) >= picks)
    keep = np.zeros(w.n, bool)
    keep[enough] = True
    rows = keep[text]
    h, text = h[rows], text[rows]
    if not len(h):
        return enough, np.zeros((0, sketches), np.int64)
    begin = np.searchsorted(text, enough)
    at = np.arange(len(text)) - np.repeat(begin, np.diff(np.append(begin, len(text))))
    pos = np.minimum(at, int(_LOW)).astype(np.uint64)
    out = np.empty((len(enough), sketches), np.int64)
    for j in range(sketches):
        v = h * np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) % (1 << 64) | 1)
        v ^= v >> np.uint64(29)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        v = (v & ~_LOW) | pos
        got = []
        for p in range(picks):
            low = np.minimum.reduceat(v, begin)
            got.append(low)
            if p + 1 < picks:
                v[begin + (low & _LOW).astype(np.int64)] = _ALL
        picked = np.stack(got, 1)
        picked = np.take_along_axis(picked, np.argsort(picked & _LOW, axis=1), 1) >> _POS
        key = np.full(len(enough), j + 1, np.uint64)
        for p in range(picks):
            key = fw.mix(key * np.uint64(31) + picked[:, p])
        out[:, j] = key.view(np.int64)
    return enough, out


def _sketch(k: int, picks: int, sketches: int, min_likeness: float, grams: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for w in fw.pieces(batch.column(1).to_pylist()):
                t1, t2 = text_keys(w)
                texts, sk = order_sketches(w, k, picks, sketches)
                has = np.zeros(w.n, bool)
                has[texts] = True
                offsets = pa.array(np.concatenate(([0], np.cumsum(has * sketches))).astype(np.int32))
                prefix, runs = prefix_keys(w, k, min_likeness, grams.value)
                out = [pa.array(ids[w.first : w.first + w.n]), pa.array(t1), pa.array(t2), pa.ListArray.from_arrays(offsets, pa.array(sk.ravel())), *prefix, pa.array(runs, pa.int32())]
                yield pa.RecordBatch.from_arrays(out, names=["doc", "t1", "t2", "keys", "prefix", "places", "runs"])

    return run


def _sketched(docs: DataFrame, stage: Stage, min_likeness: float, k: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Texts that are cases (``doc, text``), members ``rep, doc`` (written), and of the representatives the sketches ``key, doc`` and prefix keys (in one written table)."""
    docs = docs.where(~is_blank(F.col("text")) & F.col("doc").isNotNull()).select("doc", "text")
    schema = "doc long, t1 long, t2 long, keys array<long>, prefix array<long>, places array<int>, runs int"
    grams = gram_order(docs, k)
    sketched = stage.write(docs.mapInArrow(_sketch(k, PICKS, SKETCHES, min_likeness, grams), schema).where("runs > 0"))
    grams.unpersist()
    ids = sketched.groupBy("t1", "t2").agg(F.min("doc").alias("rep"))
    members = stage.write(sketched.select("t1", "t2", "doc").distinct().join(ids, ["t1", "t2"]).select("rep", "doc"))
    own = members.where("rep = doc").select("doc")
    reps = stage.write(sketched.join(own, "doc", "left_semi").dropDuplicates(["doc"]).select("doc", "keys", "prefix", "places", "runs"))
    stage.drop_all_but(*stage.paths[-2:])  # members and representatives
    sketches = reps.select("doc", F.explode("keys").alias("key"))
    prefix = reps.select("doc", "runs", F.explode(F.arrays_zip("prefix", "places")).alias("p"))
    prefix = prefix.select(F.col("p.prefix").alias("key"), "doc", F.lit(3).cast("byte").alias("mask"), F.col("p.places").alias("place"), "runs")
    return docs, members, sketches, prefix


def near_duplicates(docs: DataFrame, min_likeness: float = MIN_LIKENESS, min_edit: float = MIN_EDIT, k: int = K) -> tuple[DataFrame, DataFrame]:
    """Pairs of similar texts and the texts' members.

    ``docs``: ``doc long, text``.  Returns pairs of representatives
    ``a < b, likeness, edit_similarity`` with a likeness of at least
    ``min_likeness`` (all of them) or an edit similarity of at least ``min_edit`` (those
    that sketches find), and the unique members ``rep, doc`` of every text that is a case.
    """
    stage = Stage(docs.sparkSession, "orderminhash")
    docs, members, sketches, prefix = _sketched(docs, stage, min_likeness, k)
    rows = sketches.select("key", "doc", F.lit(3).cast("byte").alias("mask"), F.lit(1).alias("weight"))
    pairs = bucket_pairs(rows).where(F.col("shared") >= MIN_SHARED).select("a", "b")
    pairs = stage.write(pairs.unionByName(prefix_pairs(prefix, min_likeness)).distinct())
    stage.drop_all_but(stage.paths[0], stage.last)
    found = stage.write(verify_pairs(pairs, docs, edit_similarity, "edit_similarity", 3, min_likeness, min_edit))
    stage.drop_all_but(stage.paths[0], stage.last)
    return found, members


def similar_classes(docs: DataFrame, min_likeness: float = MIN_LIKENESS, k: int = K) -> DataFrame:
    """One row per text that is a case: ``doc, class_id, copies``.

    Classes are the connected components of texts of at least the likeness; class_id is
    the smallest id, copies the number of other documents with the same words.
    """
    stage = Stage(docs.sparkSession, "classes")
    docs, members, sketches, prefix = _sketched(docs, stage, min_likeness, k)
    first = sketches.groupBy("key").agg(F.min("doc").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    stars = sketches.join(first, "key").where(F.col("doc") != F.col("a")).groupBy("a", F.col("doc").alias("b")).agg(F.count("*").alias("shared"))
    stars = stage.write(stars.where(F.col("shared") >= MIN_SHARED).select("a", "b"))
    links = stage.write(_links(stars, docs, min_likeness))
    found = stage.write(_components(links))
    known = prefix.join(found, prefix.doc == found.rep, "left").select(prefix["*"], F.coalesce("class_id", "doc").alias("part"))
    several = known.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("key")
    rest = stage.write(known.join(several, "key", "left_semi"))
    more = _links(stage.write(prefix_pairs(rest, min_likeness, "part")), docs, min_likeness)
    component = _components(links.unionByName(more))
    stage.drop_all_but(stage.paths[0])  # members
    copies = members.groupBy("rep").agg((F.count("*") - 1).alias("copies"))
    reps = copies.join(component, "rep", "left").select("rep", F.coalesce("class_id", "rep").alias("class_id"), "copies")
    return members.join(reps, "rep").select("doc", "class_id", "copies")


def _links(pairs: DataFrame, docs: DataFrame, min_likeness: float) -> DataFrame:
    """The pairs of at least the likeness."""
    return verify_pairs(pairs, docs, edit_similarity, "edit_similarity", 3, min_likeness).select("a", "b")


def _components(links: DataFrame) -> DataFrame:
    """``rep, class_id`` of all linked representatives."""
    padded = [F.lpad(F.col(c).cast("string"), 20, "0").alias(c) for c in ("a", "b")]
    return hash_to_min(links.select(*padded)).select(F.col("node").cast("long").alias("rep"), F.col("component").cast("long").alias("class_id"))
