"""Sliding scoring windows over the positions of a cluster, and their combination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.functions.loci import known
from locusloom.functions.stats import fisher_log10


def window_shape(phase: int) -> tuple[int, int]:
    """Length and step of the scoring windows."""
    return (26, 8) if phase > 21 else (23, 5)


def score_cutoff(phase: int, cutoff: float) -> float:
    return min(max(cutoff, 250.0), 300.0) if phase > 21 else cutoff


def scoring_windows(rows: DataFrame, cluster: str, forward: str, reverse: str, length: int, step: int, least_length: int) -> DataFrame:
    """``cluster``, ``window_n`` and the least finite p-value of either direction in each window.

    Windows start at the first position of a cluster, every ``step``; the last partial one is left out, as are clusters
    shorter than ``least_length`` or ``length`` and windows in which a direction has no finite value. A position names
    the few windows that hold it, so there is no join of windows with positions.
    """
    span = rows.groupBy(cluster).agg(F.min("pos").alias("__s"), F.max("pos").alias("__e")).where(F.col("__e") - F.col("__s") >= max(least_length, length))
    at = rows.select(cluster, "pos", known(F.col(forward)).alias("__f"), known(F.col(reverse)).alias("__r")).where("pos is not null")
    at = at.groupBy(cluster, "pos").agg(F.min("__f").alias("__f"), F.min("__r").alias("__r")).join(span, cluster)
    offset = F.col("pos") - F.col("__s")
    last = F.least(F.floor((F.col("__e") - F.col("__s") - length) / step), F.floor(offset / step)).cast("long")
    first = F.greatest(F.lit(0), F.ceil((offset - length + 1) / step)).cast("long")
    held = at.where(first <= last).withColumn("window_n", F.explode(F.sequence(first, last)))
    out = held.groupBy(cluster, "window_n").agg(F.min("__f").alias("fw_pval_corr"), F.min("__r").alias("rv_pval_corr"))
    return out.where("fw_pval_corr is not null and rv_pval_corr is not null")


def with_combined(windows: DataFrame) -> DataFrame:
    """The product of both directions' least p-values."""
    return windows.withColumn("combined_window_p_value", F.col("fw_pval_corr") * F.col("rv_pval_corr"))


def cluster_scores(windows: DataFrame, cluster: str, p: str) -> DataFrame:
    """Fisher's combination of the windows of each cluster: ``phase_score`` (capped at 300) and ``combined_fishers``.

    Only the sum of logarithms and the count of a cluster are gathered, never its values.
    """
    value = known(F.col(p))
    logs = F.ln(F.least(F.greatest(value, F.lit(1e-300)), F.lit(1.0)))
    sums = windows.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.sum(logs).alias("__s"), F.count(value).alias("__n"))
    return sums.withColumn("__l", fisher_log10("__s", "__n")).select(
        cluster, F.least(F.lit(300.0), -F.col("__l")).alias("phase_score"), F.when(F.col("__n") == 0, 1.0).otherwise(F.greatest(F.pow(F.lit(10.0), F.col("__l")), F.lit(1e-300))).alias("combined_fishers")
    )
