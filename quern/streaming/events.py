"""Event streams: windows, first-seen rows, and batches checked against a growing registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import text_fingerprint


def read_stream(spark: SparkSession, folder: str, pattern: str, schema) -> DataFrame:
    """Stream over the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def tumbling(events: DataFrame, ts: str, width: str, *by: str) -> DataFrame:
    """Counts and sums of ``value`` per time window; the same for batch and stream."""
    out = events.groupBy(F.window(ts, width).alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), *by, "n", "total")


def sessions(events: DataFrame, ts: str, gap: str, *by: str) -> DataFrame:
    """Sessions that end after a pause of ``gap``."""
    out = events.groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return out.select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(rows: DataFrame, text: str, ts: str, delay: str) -> DataFrame:
    """Stream of rows whose text was not seen within the watermark."""
    return rows.withColumn("fingerprint", text_fingerprint(F.col(text))).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["fingerprint"])


def against_registry(rows: DataFrame, registry: str, key: str, out: str, checkpoint: str, order: str | None = None, buckets: int = 64):
    """Stream query: each batch is written without rows whose key the registry holds; new keys are then added to it.

    The registry is a folder partitioned by the bucket of the key's hash and the batch: only the buckets
    that a batch touches are read.  Of several rows of a key in a batch the first by ``order``, then by the
    hash of all columns, stays.  The batch is keyed by its id, so a batch that is run again
    after a failure replaces what it had written.  Rows without a key are kept.
    """
    spark = rows.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        from quern.sources.files import exists

        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        rank = F.struct(*([F.col(order)] if order else []), F.xxhash64(*batch.columns).alias("_h"))
        named = batch.where(F.col(key).isNotNull())
        first = named.groupBy(key).agg(F.min_by(F.struct(*batch.columns), rank).alias("_r")).select("_r.*").withColumn("bucket", bucket)
        if exists(spark, registry):
            used = [r[0] for r in named.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets`` numbers
            known = spark.read.parquet(registry).where(F.col("bucket").isin(used) & (F.col("batch") < batch_id)).select("bucket", key)
            first = first.join(known, ["bucket", key], "left_anti")
        new = first.drop("bucket").select(*batch.columns).unionByName(batch.where(F.col(key).isNull()))
        new.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        added = spark.read.parquet(f"{out}/batch={batch_id}").where(F.col(key).isNotNull()).select(key, bucket.alias("bucket"), F.lit(batch_id).alias("batch"))
        added.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(registry)

    return rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
