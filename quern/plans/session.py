"""Session settings that the operators are made for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Adaptive execution with skew handling; settings that a cluster has made are left alone."""
    for key, value in (("spark.sql.adaptive.enabled", "true"), ("spark.sql.adaptive.skewJoin.enabled", "true"), ("spark.sql.adaptive.coalescePartitions.enabled", "true")):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark
