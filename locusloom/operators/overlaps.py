"""Overlap joins and overlap groups of intervals, by bins of positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusloom.operators.intervals import interval_periods

BIN = 1 << 12


def _bins(start: Column, end: Column, size: int) -> Column:
    return F.explode(F.sequence(F.floor(start / size).cast("long"), F.floor(end / size).cast("long")))


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], buffer: int = 0, size: int = BIN) -> DataFrame:
    """Pairs of a left and a right interval of the same key that overlap, or lie within ``buffer`` of each other.

    Both sides have ``keys``, ``start`` and ``end`` (inclusive, ``start <= end``); their other columns must differ in
    name. The result has ``keys``, the left columns with ``start_a``/``end_a`` and the right ones with
    ``start_b``/``end_b``. Intervals are joined by key and bin, so one busy contig is many join keys; a pair is kept
    only in the bin where the later of both starts lies, hence once. Rows with a null key or end match nothing.
    """
    keys = list(keys)
    a = left.withColumnsRenamed({"start": "start_a", "end": "end_a"}).withColumn("__bin", _bins(F.col("start_a"), F.col("end_a") + buffer, size))
    b = right.withColumnsRenamed({"start": "start_b", "end": "end_b"}).withColumn("__bin", _bins(F.col("start_b"), F.col("end_b") + buffer, size))
    near = (F.col("start_b") <= F.col("end_a") + buffer) & (F.col("start_a") <= F.col("end_b") + buffer)
    once = F.col("__bin") == F.floor(F.greatest("start_a", "start_b") / size)
    return a.join(b, [*keys, "__bin"]).where(near & once).drop("__bin")


def overlap_groups(loci: DataFrame, keys: Sequence[str], buffer: int = 0, size: int = BIN) -> DataFrame:
    """``loci`` with ``group_start`` and ``group_end``: the extent of all loci linked by overlap, directly or through others.

    Two loci are linked if the later starts at most ``buffer`` behind the end of the other. Groups are the covered
    stretches of doubled coordinates (where adjacency is no overlap); each locus finds its stretch by bin.
    """
    keys = list(keys)
    stretches = interval_periods(loci, {k: F.col(k) for k in keys}, F.col("start") * 2, (F.col("end") + buffer) * 2).where("kind = 'covered'")
    groups = stretches.select(
        *keys, (F.col("period_start") / 2).cast("long").alias("group_start"), (F.col("period_end") / 2 - buffer).cast("long").alias("group_end")
    ).withColumn("__bin", _bins(F.col("group_start"), F.col("group_end") + buffer, size))
    binned = loci.withColumn("__bin", F.floor(F.col("start") / size).cast("long"))
    inside = (F.col("start") >= F.col("group_start")) & (F.col("start") <= F.col("group_end"))
    return binned.join(groups, [*keys, "__bin"]).where(inside).drop("__bin")
