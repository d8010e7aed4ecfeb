"""Every pair of texts that can reach a likeness, by prefix keys over distinct k-word runs.

*Order.*  All distinct runs are put in one order, rare ones first, that depends on
the run alone.  Of its n runs a text gives the first n - ceil(likeness * n) + 1 as
keys: two texts of at least that likeness share one, whatever else is frequent,
repeated or moved.  No bucket is capped.

*Counts.*  The order comes from counts of hashed runs in BLOCKS * SLOTS slots.  A
slot counts at least as much as each of its runs, so a run whose slot counts one
text pairs nothing and gives no key, though it keeps its place in the prefix.  Where
more runs than slots exist, fewer keys are saved; the pairs stay the same.

*Pairs.*  Of the runs that two texts share none stands before the first one in
either text, so that one's places bound the number shared; pairs that cannot reach
the likeness are left out before any text is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import flatwords as fw
from quern.llm.likeness import distinct_grams

BLOCKS = 1 << 10
SLOTS = 1 << 17
#: Slots that share one level of frequency.
COARSE = 32
#: Runs that a task holds before it gives out their counts.
HELD = 1 << 23
_SHIFT = np.uint64(64 - 27)


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> _SHIFT).astype(np.int64)


def _count(k: int):
    def counts(held: list) -> pa.RecordBatch:
        slot, n = np.unique(np.concatenate(held), return_counts=True)
        block, first = np.unique(slot // SLOTS, return_index=True)
        low, n = (slot % SLOTS).astype(np.uint32), np.minimum(n, 65535).astype(np.uint16)
        parts = list(zip(first, np.append(first[1:], len(slot))))
        cols = [pa.array(block, pa.int32()), *(pa.array([v[s:e].tobytes() for s, e in parts], pa.binary()) for v in (low, n))]
        return pa.RecordBatch.from_arrays(cols, names=["block", "slots", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for w in fw.pieces(batch.column(0).to_pylist()):
                held.append(_slots(distinct_grams(w, k)[1]).astype(np.uint32))
                size += len(held[-1])
                if size > HELD:
                    yield counts(held)
                    held, size = [], 0
        if size:
            yield counts(held)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block, from rows sorted by block: a bit for every slot that counts two or more, and levels of frequency."""
    block, total = None, np.zeros(SLOTS, np.int64)

    def merged() -> pa.RecordBatch:
        often = np.packbits(total > 1, bitorder="little")
        level = np.minimum(8 * np.log2(np.maximum(total, 1)), 254).astype(np.uint8).reshape(-1, COARSE).max(1)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([often.tobytes()]), pa.array([level.tobytes()])], names=["block", "often", "level"])

    for batch in batches:
        for b, slots, n in zip(*(c.to_pylist() for c in batch.columns)):
            if b != block:
                if block is not None:
                    yield merged()
                block = b
                total[:] = 0
            total[np.frombuffer(slots, np.uint32)] += np.frombuffer(n, np.uint16)
    if block is not None:
        yield merged()


def gram_order(texts: DataFrame, k: int) -> Broadcast:
    """The order of the k-word runs of all texts (the column ``text``), for ``prefix_keys``."""
    rows = texts.select("text").mapInArrow(_count(k), "block int, slots binary, counts binary").repartition("block").sortWithinPartitions("block")
    often, level = np.zeros((BLOCKS, SLOTS // 8), np.uint8), np.zeros((BLOCKS, SLOTS // COARSE), np.uint8)
    for r in rows.mapInArrow(_merge, "block int, often binary, level binary").toLocalIterator():
        often[r.block], level[r.block] = np.frombuffer(r.often, np.uint8), np.frombuffer(r.level, np.uint8)
    return texts.sparkSession.sparkContext.broadcast((often.ravel(), level.ravel()))


def prefix_keys(w: fw.Words, k: int, threshold: float, order: tuple[np.ndarray, np.ndarray]) -> tuple[list[pa.Array], np.ndarray]:
    """Keys and their places as lists per text, and the number of distinct runs of each text."""
    often, level = order
    text, h = distinct_grams(w, k)
    slot = _slots(h)
    twice = (often[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 != 0
    at = np.argsort(text * 256 + np.where(twice, level[slot // COARSE].astype(np.int64) + 1, 0), kind="stable")
    h, twice = h[at], twice[at]
    n = np.bincount(text, minlength=w.n)
    place = np.arange(len(text)) - (np.cumsum(n) - n)[text]
    need = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
    ok = twice & (place < need[text])
    offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(text[ok], minlength=w.n)))).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v, t)) for v, t in ((h[ok].view(np.int64), pa.int64()), (place[ok], pa.int32()))]
    return lists, n


def prefix_pairs(keys: DataFrame, threshold: float, apart: str | None = None) -> DataFrame:
    """Unique pairs ``a < b`` that may reach the likeness, from ``key, doc, mask, place, runs``.

    A pair needs bit 1 in one mask and bit 2 in the other (mask 3: any pair), and
    different values of the column ``apart``, if one is named.
    """
    x, y = keys, keys.toDF(*[f"{c}2" if c != "key" else c for c in keys.columns])
    sides = "((mask & 1) <> 0 and (mask2 & 2) <> 0) or ((mask & 2) <> 0 and (mask2 & 1) <> 0)"
    most = F.least(F.col("runs") - F.col("place"), F.col("runs2") - F.col("place2"))
    enough = most * F.lit(1 + threshold) >= (F.col("runs") + F.col("runs2")) * F.lit(threshold) - 1e-6
    both = x.join(y, "key").where((F.col("doc") < F.col("doc2")) & enough).where(sides)
    if apart:
        both = both.where(F.col(apart) != F.col(f"{apart}2"))
    return both.select(F.col("doc").alias("a"), F.col("doc2").alias("b")).distinct()
