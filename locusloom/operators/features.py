"""Per-cluster features and what is reported of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusloom.functions.loci import bare_cluster_id, known


def cluster_features(reads: DataFrame, cluster: str, phase: int) -> DataFrame:
    """Strand bias by rows, abundance at the phase length against the rest, length-normalised abundance, complexity.

    Distinct tags are counted after a first aggregation by tag, which also carries the sums, so one shuffle serves all.
    """
    abun = F.coalesce(F.col("abun"), F.lit(0))
    at = F.col("len") == phase
    w, c = F.col("strand") == "w", F.col("strand") == "c"
    by_tag = reads.groupBy(cluster, "tag_seq").agg(
        F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.sum(abun).alias("abun"), F.count_if(w).alias("w"), F.count_if(c).alias("c"),
        F.sum(F.when(at, abun)).alias("on"), F.sum(F.when(~at, abun)).alias("off"), F.sum(F.when(at & (w | c), abun)).alias("on_strand"),
    )
    out = by_tag.groupBy(cluster).agg(
        F.min("lo").alias("start"), F.max("hi").alias("end"), F.sum("abun").alias("total"), F.sum("w").alias("w"), F.sum("c").alias("c"),
        F.coalesce(F.sum("on"), F.lit(0)).alias("on"), F.coalesce(F.sum("off"), F.lit(0)).alias("off"), F.coalesce(F.sum("on_strand"), F.lit(0)).alias("on_strand"),
        F.count("tag_seq").alias("tags"),
    )
    room = F.greatest(F.col("end") - F.col("start"), F.lit(0)) - phase
    return out.select(
        cluster, "start", "end",
        F.when(F.col("w") + F.col("c") > 0, F.col("w") / (F.col("w") + F.col("c"))).otherwise(1.0).alias("strand_bias"),
        F.when(F.col("off") > 0, F.try_divide(F.col("on"), F.col("off"))).otherwise(1.0).alias("ratio_abund_len_phase"),
        F.log10(F.when(room > 0, F.try_divide(F.col("on_strand"), room)).otherwise(0.0) + 1).alias("log_clust_len_norm_counts"),
        F.col("total").cast("double").alias("total_abund"),
        F.when(F.col("total") > 0, F.try_divide(F.col("tags"), F.col("total"))).otherwise(0.0).alias("complexity"),
    )


def phase_positions(reads: DataFrame, cluster: str, phase: int) -> DataFrame:
    """Abundance at each position and strand of the reads at the phase length."""
    rows = reads.where((F.col("len") == phase) & F.col("strand").isNotNull() & F.col(cluster).isNotNull())
    return rows.groupBy(cluster, "strand", "pos").agg(F.sum(F.coalesce("abun", F.lit(0))).alias("abun"))


def best_rows(features: DataFrame, keys: list[str]) -> DataFrame:
    """The best feature row of each key: exact support, then peak, then phase score, then id; NaN and null come last."""
    rank = [known(F.col(c)).desc_nulls_last() for c in ("Howell_exact_support_score", "Peak_Howell_score", "phase_score")]
    best = features.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*rank, F.col("cID").asc())))
    return best.where("__r = 1").drop("__r")


def longest_empty_run(positions: DataFrame, cluster: str, phase: int) -> DataFrame:
    """Per cluster and register of the Watson positions: longest run of cycles without a read between two that have one."""
    at = positions.where("strand = 'w'").select(cluster, F.pmod("pos", F.lit(phase)).alias("register"), F.floor(F.col("pos") / phase).alias("cycle")).distinct()
    step = F.col("cycle") - F.lag("cycle").over(Window.partitionBy(cluster, "register").orderBy("cycle"))
    runs = at.withColumn("__empty", F.coalesce(step - 1, F.lit(0)))
    return runs.groupBy(cluster, "register").agg(F.count(F.lit(1)).alias("supported"), F.max("__empty").alias("longest_empty"))


def scores_by_any_id(rows: DataFrame, scores: DataFrame, places: DataFrame, phase: int) -> DataFrame:
    """``rows`` (``alib``, ``cID``, ``identifier``) with ``score`` and ``found_by``: ``id``, ``bare id``, ``place`` or null (score 0).

    ``scores`` has ``cluster_id`` and ``phase_score``, ``places`` the ``place`` of each ``clusterID``. An id is looked up
    as it is, then without the file name in front, and its identifier among the places of scored clusters at last, of
    which the highest score counts.
    """
    plain = scores.select(F.trim("cluster_id").alias("__id"), F.col("phase_score").alias("__s")).groupBy("__id").agg(F.max("__s").alias("__s"))
    at_place = scores.join(places, F.col("cluster_id") == F.col("clusterID")).groupBy("place").agg(F.max("phase_score").alias("__by_place"))
    named = rows.withColumns({"__raw": F.trim("cID"), "__bare": bare_cluster_id(F.col("cID"), phase, F.col("alib"))})
    out = (
        named.join(plain.select(F.col("__id").alias("__raw"), F.col("__s").alias("__by_raw")), "__raw", "left")
        .join(plain.select(F.col("__id").alias("__bare"), F.col("__s").alias("__by_bare")), "__bare", "left")
        .join(at_place, F.col("identifier") == F.col("place"), "left")
    )
    found = F.when(F.col("__by_raw").isNotNull(), "id").when(F.col("__by_bare").isNotNull(), "bare id").when(F.col("__by_place").isNotNull(), "place")
    return out.select("alib", "cID", "identifier", found.alias("found_by"), F.coalesce("__by_raw", "__by_bare", "__by_place", F.lit(0.0)).alias("score"))
