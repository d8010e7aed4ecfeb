"""Event-window queries, batch form of the streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.tables import table
from quern.streaming.events import sessions, tumbling


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = tumbling(_events(spark, sf), "ts", "1 hour", "event_type")
    return out.select(F.unix_timestamp("start").alias("start_s"), "event_type", "n", F.round("total", 4).alias("total"))


def session_windows(spark: SparkSession, sf: str) -> DataFrame:
    out = sessions(_events(spark, sf), "ts", "30 minutes", "user_id")
    return out.select("user_id", F.unix_micros("start").alias("start_us"), "n")


QUERIES = {"tumbling_counts": tumbling_counts, "session_windows": session_windows}
ORACLES = {
    "tumbling_counts": "select (epoch_us(time_bucket(interval '1 hour', ts)) // 1000000)::bigint as start_s, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2",
    "session_windows": """with g as (select user_id, ts, case when ts - lag(ts) over w < interval '30 minutes' then 0 else 1 end b from events window w as (partition by user_id order by ts, event_id)),
s as (select user_id, ts, sum(b) over (partition by user_id order by ts rows unbounded preceding) k from g)
select user_id, epoch_us(min(ts)) as start_us, count(*) as n from s group by user_id, k""",
}
