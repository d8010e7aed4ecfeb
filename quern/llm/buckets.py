"""Pairs of documents that share a bucket key, without all pairs of a frequent key.

Key rows ``(key, doc, mask, weight)`` are hashed by key once and sorted; each task
streams over the runs of equal keys.  A key of at most ``cold`` documents gives its
pairs, at most ``cold - 1`` per row, so the work grows with the rows; nothing larger
than one run of ``cold`` rows is ever held.  A more frequent key gives none: what such
keys alone would find must come from keys without a bound (``prefix``), as the callers
see to.  Before the shuffle each stretch of HELD rows keeps ``cold + 1`` rows of a key,
which is enough to know it as frequent, so a key that a third of all documents share
does not fill one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLD = 48
HELD = 1 << 20
_OUT = "a long, b long, weight int"


def _runs(cold: int):
    def emit(key, doc, mask, weight, start, size):
        """Pairs of the runs of 2 .. cold rows; runs as arrays of start and size."""
        out = []
        for n in np.unique(size):
            if n < 2:
                continue
            at = start[size == n]
            i, j = np.triu_indices(int(n), 1)
            x, y = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
            ok = (doc[x] != doc[y]) & ((((mask[x] & 1) != 0) & ((mask[y] & 2) != 0)) | (((mask[x] & 2) != 0) & ((mask[y] & 1) != 0)))
            x, y = x[ok], y[ok]
            if len(x):
                a, b = np.minimum(doc[x], doc[y]), np.maximum(doc[x], doc[y])
                out.append((a, b, np.minimum(weight[x], weight[y])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, t) for t in (np.int64, np.int64, np.int8, np.int32)]
        hot = None  # the frequent key whose run may go on in the next batch

        def handle(cols, last):
            nonlocal hot, rest
            key, doc, mask, weight = cols
            if not len(key):
                return
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.append(first, len(key)))
            is_hot = size > cold
            if hot is not None and key[0] == hot:
                is_hot[0] = True
            if not last and not is_hot[-1]:  # the last run may go on
                cut = first[-1]
                rest = [c[cut:] for c in cols]
                first, size, is_hot = first[:-1], size[:-1], is_hot[:-1]
            else:
                rest = [c[:0] for c in cols]
                hot = key[-1] if is_hot[-1] else None
            for a, b, w in emit(key, doc, mask, weight, first[~is_hot], size[~is_hot]):
                for s in range(0, len(a), 100_000):
                    e = slice(s, s + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array(a[e], pa.int64()), pa.array(b[e], pa.int64()), pa.array(w[e], pa.int32())], names=["a", "b", "weight"])

        for batch in batches:
            cols = [np.concatenate((r, c.to_numpy(zero_copy_only=False).astype(r.dtype))) for r, c in zip(rest, batch.columns)]
            yield from handle(cols, False)
        yield from handle(rest, True)

    return run


def _few(cold: int):
    """At most ``cold + 1`` rows of a key for every HELD rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def cut():
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column(0).to_numpy()
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            rank = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
            if rank.max(initial=0) <= cold:
                return table.to_batches(max_chunksize=100_000)
            return table.take(pa.array(np.sort(order[rank <= cold]))).to_batches(max_chunksize=100_000)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= HELD:
                yield from cut()
                held, size = [], 0
        if size:
            yield from cut()

    return run


def bucket_pairs(keys: DataFrame, cold: int = COLD) -> DataFrame:
    """Pairs of documents that share keys of at most ``cold`` documents: ``a < b, shared (number of keys), weight (their sum)``.

    ``keys``: ``key long, doc long, mask byte, weight int``, unique by key and doc;
    a pair needs bit 1 in one mask and bit 2 in the other (mask 3: any pair).
    """
    few = keys.select("key", "doc", "mask", "weight").mapInArrow(_few(cold), "key long, doc long, mask byte, weight int")
    rows = few.repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(_runs(cold), _OUT).groupBy("a", "b").agg(F.count("*").alias("shared"), F.sum("weight").alias("weight"))
