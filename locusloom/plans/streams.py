"""Batch forms of the streaming operators, over the tables' event times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.operators.clusters import gap_clusters
from locusloom.session import table


def x1_hourly_loads(spark: SparkSession, d: str) -> DataFrame:
    """Rows and abundance loaded by library and hour: the same windows as the streaming operator's."""
    rows = table(spark, d, "phas_to_detect").where("loaded_at is not null")
    out = rows.groupBy(F.window("loaded_at", "1 hour").alias("w"), "alib").agg(F.count(F.lit(1)).alias("n"), F.sum("abun").alias("abun"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "alib", "n", "abun")


SESSION_GAP = 30 * 60 * 1_000_000  # microseconds
DAY = 24 * 60 * 60 * 1_000_000


def x2_event_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of each user's events, apart by more than half an hour: the time form of gap clusters.

    Sessions are found within the days of a user and stitched over midnight, so a user with most events is many keys.
    """
    rows = table(spark, d, "events").where("user_id is not null and ts is not null")
    at = rows.groupBy("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("pos")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    runs = gap_clusters(at, ["user_id"], SESSION_GAP - 1, DAY)
    out = runs.groupBy("user_id", "cluster_no").agg(F.min("pos").alias("first"), F.sum("n").alias("n"), F.round(F.sum("value"), 6).alias("value"))
    return out.select("user_id", F.timestamp_micros("first").cast("timestamp_ntz").alias("session_start"), "n", "value")


QUERIES = {f.__name__: f for f in (x1_hourly_loads, x2_event_sessions)}

SQL = {
    "x1_hourly_loads": "SELECT date_trunc('hour', loaded_at) AS window_start, alib, count(*) AS n, CAST(sum(abun) AS BIGINT) AS abun FROM phas_to_detect WHERE loaded_at IS NOT NULL GROUP BY 1, 2",
    "x2_event_sessions": """WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, min(ts) AS session_start, count(*) AS n, round(sum(value), 6) AS value FROM s GROUP BY user_id, k""",
}
