"""Sizes of texts in tokens of a public tokenizer.

The vocabulary is a rank file (base64 token, rank); its path is a parameter and
the file is read where the work runs.  Whole texts are encoded; the strings of
special tokens are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import is_blank
from quern.plans.stage import Stage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How texts are split before merging; fixed value of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["doc", "tokens"])

    return run


def token_sizes(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc, tokens`` (at least 1) of all texts that are not null or blank, written once.

    ``docs``: ``doc long, text`` and any other columns, which are kept if their
    names are ``source``.
    """
    kept = [c for c in docs.columns if c == "source"]
    docs = docs.where(F.col("doc").isNotNull() & ~is_blank(F.col("text")))
    if not kept:
        counted = docs.select("doc", "text").mapInArrow(_count(vocabulary), "doc long, tokens long")
        return Stage(docs.sparkSession, "tokens").write(counted)
    paired = docs.select(F.struct("doc", "source").alias("doc"), "text").mapInArrow(_count(vocabulary), "doc struct<doc:bigint,source:string>, tokens long")
    return Stage(docs.sparkSession, "tokens").write(paired.select("doc.doc", "doc.source", "tokens"))
