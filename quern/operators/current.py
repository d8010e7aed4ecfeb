"""Latest version of every record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import clean_key


def current_records(rows: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """One row per cleaned key: of several rows the one with the highest ``order``.

    Rows whose key is null or blank are no records and are left out.  Equal
    values of ``order`` under one key are settled by the greatest values of
    ``columns``.  Aggregation combines on the map side, so a key that holds many
    of the rows costs one row per map task in the shuffle.
    """
    picked = F.max(F.struct(F.col(order).alias("_o"), *[F.col(c) for c in columns]))
    out = rows.select(clean_key(key).alias("_k"), order, *columns).where("_k is not null").groupBy("_k").agg(picked.alias("_r"))
    return out.select(F.col("_k").alias(key), F.col(f"_r._o").alias(order), *[F.col(f"_r.{c}").alias(c) for c in columns])
