"""Positions of aligned reads, gap clusters and their loci."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TILE = 1 << 16


def cluster_gap(phase: int, buffer: int) -> int:
    """Distance beyond which a new cluster begins: forming and merging of neighbours collapse to one rule."""
    return max(phase + 4, buffer)


def position_counts(reads: DataFrame, keys: Sequence[str], phase: int) -> DataFrame:
    """Per key and position: reads, abundance, and abundance at the phase length."""
    return reads.groupBy(*keys, "pos").agg(
        F.count(F.lit(1)).alias("n_reads"), F.sum("abun").alias("abun"), F.sum(F.when(F.col("len") == phase, F.col("abun"))).alias("abun_phase")
    )


def gap_clusters(positions: DataFrame, keys: Sequence[str], gap: int, tile: int = TILE) -> DataFrame:
    """``positions`` with ``cluster_no``: 1 for the first run of positions of a key, one more behind each gap.

    ``positions`` has one row per key and position. Runs are found within tiles of positions; a tile's first position
    is compared with the last one of the tile before it, and numbers are shifted by those used before. No task holds
    more than one tile of a key, except for the list of its tiles.
    """
    keys = list(keys)
    tiled = positions.withColumn("__tile", F.floor(F.col("pos") / tile).cast("long"))
    inside = Window.partitionBy(*keys, "__tile").orderBy("pos")
    tiled = tiled.withColumn("__new", F.coalesce(F.col("pos") - F.lag("pos").over(inside) > gap, F.lit(False)).cast("long"))
    tiled = tiled.withColumn("__run", F.sum("__new").over(inside))
    line = Window.partitionBy(*keys).orderBy("__tile")
    ends = tiled.groupBy(*keys, "__tile").agg(F.min("pos").alias("__first"), F.max("pos").alias("__last"), F.sum("__new").alias("__breaks"))
    ends = ends.withColumn("__starts", F.coalesce(F.col("__first") - F.lag("__last").over(line) > gap, F.lit(True)).cast("long"))
    before = F.coalesce(F.sum(F.col("__breaks") + F.col("__starts")).over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = ends.select(*keys, "__tile", (before + F.col("__starts")).alias("__offset"))
    return tiled.join(ends, [*keys, "__tile"]).withColumn("cluster_no", F.col("__offset") + F.col("__run")).drop("__tile", "__new", "__run", "__offset")


def cluster_spans(clustered: DataFrame, keys: Sequence[str]) -> DataFrame:
    return clustered.groupBy(*keys, "cluster_no").agg(
        F.min("pos").alias("start"), F.max("pos").alias("end"), F.count(F.lit(1)).alias("n_pos"), F.sum("n_reads").alias("n_reads")
    )


def long_enough(spans: DataFrame, phase: int) -> DataFrame:
    """Clusters that span more than four cycles."""
    return spans.where(F.col("end") - F.col("start") + 1 > 4 * phase + 4)


def library_totals(reads: DataFrame) -> DataFrame:
    return reads.groupBy("alib").agg(F.sum("abun").alias("total_abun"))


def cluster_quality(reads: DataFrame, cluster: str, phase: int, unique_ratio: float = 0.2, size_share: float = 0.5, least_tags: int = 10) -> DataFrame:
    """Per cluster what the quality filter looks at, and whether the cluster ``passes``.

    Reads at the phase length must outnumber a quarter of the abundance where there are at most four lengths, else the
    median count of a length; tags with at most two hits must have ``unique_ratio`` of the tags and the phase length
    ``size_share`` of the abundance. Lengths are pre-aggregated, so a large cluster is a few rows.
    """
    by_len = reads.groupBy(cluster, "len").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("abun", F.lit(0))).alias("a"), F.count_if(F.col("hits") <= 2).alias("u")
    )
    at = F.col("len") == phase
    out = by_len.groupBy(cluster).agg(
        F.sum("n").alias("tags"), F.sum("a").alias("abun"), F.sum("u").alias("unique_tags"),
        F.coalesce(F.sum(F.when(at, F.col("n"))), F.lit(0)).alias("phase_tags"), F.coalesce(F.sum(F.when(at, F.col("a"))), F.lit(0)).alias("phase_abun"),
        F.count(F.lit(1)).alias("lengths"), F.percentile("n", 0.5).alias("median_tags"),
    )
    cut = F.when(F.col("lengths") <= 4, F.floor(0.25 * F.col("abun")).cast("double")).otherwise(F.col("median_tags"))
    out = out.withColumn("count_cut", cut)
    passes = (
        (F.col("tags") >= least_tags) & (F.col("abun") > 0) & (F.col("phase_tags") > F.col("count_cut"))
        & (F.round(F.col("unique_tags") / F.col("tags"), 5) >= unique_ratio)
        & (F.round(F.try_divide(F.col("phase_abun"), F.col("abun")), 5) >= size_share)
    )
    return out.withColumn("passes", F.coalesce(passes, F.lit(False)))


def cluster_loci(reads: DataFrame, cluster: str, least_length: int) -> DataFrame:
    """Contig, start and end of each cluster that spans ``least_length``."""
    return reads.groupBy(cluster, "chromosome").agg(F.min("pos").alias("start"), F.max("pos").alias("end")).where(F.col("end") - F.col("start") >= least_length)


