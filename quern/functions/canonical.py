"""Canonical JSON and hashes over it."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(text: str | None) -> str | None:
    """JSON with sorted keys, no blanks and unescaped letters; null for null or text that is not JSON."""
    if text is None:
        return None
    try:
        return json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    except ValueError:
        return None


def canonical_json(c: Column) -> Column:
    """Column of ``canonical``, for byte parity with hashes made elsewhere."""
    return F.pandas_udf(lambda s: pd.Series([canonical(t) for t in s], dtype=object), "string")(c)


def _hash(text: str | None) -> str | None:
    done = canonical(text)
    return None if done is None else hashlib.sha256(done.encode("utf-8", "replace")).hexdigest()


def canonical_hash(c: Column) -> Column:
    """SHA-256 of the canonical form of JSON text."""
    return F.pandas_udf(lambda s: pd.Series([_hash(t) for t in s], dtype=object), "string")(c)


def struct_hash(*columns: str) -> Column:
    """SHA-256 over columns in the order of their names, nulls included; stays in the JVM."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


def joined_hash(*parts: Column, by: str = "|") -> Column:
    """SHA-256 of parts joined by ``by``; null parts count as empty."""
    return F.sha2(F.concat_ws(by, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
