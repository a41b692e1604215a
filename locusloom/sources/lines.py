"""Text files as numbered lines, whatever the splits they are read in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``line_no`` (from 0) and ``value`` of text files, plain or compressed.

    A split's rows are numbered where they are read; splits are then put in the order of their place in the file, so
    only one row per split is gathered to find where its numbers begin.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"), "value"
    )
    splits = rows.groupBy("file", "__block").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = splits.select("file", "__block", (before - F.col("__first")).alias("__shift"))
    return rows.join(starts, ["file", "__block"]).select("file", (F.col("__id") + F.col("__shift")).alias("line_no"), "value")


def chunks(spark: SparkSession, path: str, mark: str = ">") -> DataFrame:
    """``file`` and ``value`` of the records that begin with ``mark``, without it."""
    rows = spark.read.option("lineSep", mark).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return rows.where(F.trim("value") != "")
