"""Counts of aligned reads that arrive over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(reads: DataFrame, time: str, keys: list[str], window: str = "1 hour", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Rows and abundance of each key by event-time window; rows later than ``late`` behind the newest are left out."""
    at = F.window(time, window, slide) if slide else F.window(time, window)
    counted = reads.withWatermark(time, late).groupBy(at.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("abun").alias("abun"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", "abun")


def first_loads(reads: DataFrame, time: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """The stream without rows that repeat the keys of an earlier one within the watermark."""
    return reads.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def session_counts(reads: DataFrame, time: str, keys: list[str], gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Rows and abundance of each key by session: rows at most ``gap`` apart. A session comes out when no late row can join it."""
    counted = reads.withWatermark(time, late).groupBy(*keys, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("abun").alias("abun"))
    return counted.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "n", "abun")
