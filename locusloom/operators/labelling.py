"""Phased and unphased positions around each position of a cluster, and the tests on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusloom.functions.stats import hypergeometric_tail, rank_sum_p, stouffer

CYCLES, OVERHANG = 15, 3


def _on_site(shift: Column, phase: int) -> Column:
    """A multiple of the phase, or one off, within the cycles of a window."""
    return shift.between(-1, (CYCLES - 1) * phase + 1) & (F.pmod(shift + 1, F.lit(phase)) <= 2)


def _block_pairs(sites: DataFrame, cluster: str, phase: int) -> DataFrame:
    """Pairs as :func:`labelled_pairs` gives them, with ``__b``, the block of the site that looks.

    The neighbours go to their own and the two blocks beside it, so all pairs of a site stand in the partition of its
    cluster and block, and what is counted by these and the site needs no other shuffle.
    """
    reach = (CYCLES - 1) * phase + 1 + OVERHANG
    block = F.floor(F.col("pos") / reach).cast("long")
    a = sites.select(F.col(cluster).alias("__c"), F.col("pos").alias("a_pos"), F.col("strand").alias("a_strand"), block.alias("__b"))
    b = sites.withColumn("__b", F.explode(F.array(block - 1, block, block + 1))).withColumnsRenamed({"pos": "b_pos", "strand": "b_strand", cluster: "__c"})
    pairs = a.join(b, ["__c", "__b"])
    d = F.col("b_pos") - F.col("a_pos")
    rank = lambda s: F.when(F.col(s) == "w", 0).otherwise(1)
    ahead = (d > 0) | ((d == 0) & (rank("b_strand") >= rank("a_strand")))
    behind = (d < 0) | ((d == 0) & (rank("b_strand") <= rank("a_strand")))
    same = F.col("a_strand") == F.col("b_strand")
    on_w = F.col("a_strand") == "w"
    far = (CYCLES - 1) * phase + 1
    forward_site = _on_site(F.when(same, d).when(on_w, d + OVERHANG).otherwise(d - OVERHANG), phase)
    reverse_site = _on_site(F.when(same, -d).when(on_w, -d - OVERHANG).otherwise(OVERHANG - d), phase)
    forward = F.when(~ahead, None).when(forward_site, "p").when(d <= F.when(on_w, far).otherwise(far + OVERHANG), "np")
    reverse = F.when(~behind, None).when(reverse_site, "p").when(d >= F.when(on_w, -far - OVERHANG).otherwise(-far), "np")
    return pairs.withColumn("f", forward).withColumn("r", reverse).where("f is not null or r is not null").withColumnRenamed("__c", cluster)


def labelled_pairs(sites: DataFrame, cluster: str, phase: int) -> DataFrame:
    """Each site with the sites of its cluster in reach, ``f`` and ``r``: ``p``, ``np`` or null in either direction.

    ``sites`` has one row per cluster, position and strand. Pairs are joined by cluster and block of positions as long
    as the reach, so a cluster that holds a tenth of all sites is many join keys and pairs grow with sites times reach.
    Reverse labels mirror the forward ones; the other strand is shifted by the overhang.
    """
    return _block_pairs(sites, cluster, phase).drop("__b")


def label_counts(sites: DataFrame, cluster: str, phase: int) -> DataFrame:
    """Per site: phased (``X``) and all labelled (``N``) sites in either direction."""
    return _block_pairs(sites, cluster, phase).groupBy(cluster, "__b", "a_pos", "a_strand").agg(
        F.count_if(F.col("f") == "p").alias("X_f"), F.count_if(F.col("f").isNotNull()).alias("N_f"),
        F.count_if(F.col("r") == "p").alias("X_r"), F.count_if(F.col("r").isNotNull()).alias("N_r"),
    ).drop("__b")


def rank_sums(values: DataFrame, keys: list[str], first: Column, value: str) -> DataFrame:
    """Rank-sum statistic ``u`` of the rows where ``first`` holds against the others, with sizes ``n``, ``m`` and ``ties``.

    Works on counts of distinct values: midranks come from running counts, so no list of a group's values is built.
    ``ties`` is the sum of t^3 - t over groups of equal values.
    """
    counts = values.groupBy(*keys, F.col(value).alias("__v")).agg(F.count_if(first).alias("__x"), F.count_if(~first).alias("__y"))
    t = F.col("__x") + F.col("__y")
    below = F.coalesce(F.sum(t).over(Window.partitionBy(*keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = counts.withColumn("__mid", below + (t + 1) / 2)
    sums = ranked.groupBy(*keys).agg(
        F.sum("__x").alias("n"), F.sum("__y").alias("m"), F.sum(F.col("__x") * F.col("__mid")).alias("__r"), F.sum((t * t * t - t).cast("double")).alias("ties")
    )
    return sums.withColumn("u", F.col("__r") - F.col("n") * (F.col("n") + 1) / 2).drop("__r")


def site_rank_sums(sites: DataFrame, cluster: str, phase: int) -> DataFrame:
    """Per site and direction (``_f``, ``_r``): phased ``X`` and labelled ``N`` sites, and the rank-sum of phased against other abundances.

    ``u``, ``size`` and ``others`` (of the two sides) and ``ties`` as in :func:`rank_sums`; an empty side counts as one 0. One aggregation by site and
    abundance, running counts over it, and one by site give all of them, without another shuffle than that of the pairs.
    """
    site = [cluster, "__b", "a_pos", "a_strand"]
    pairs = _block_pairs(sites, cluster, phase).withColumn("__v", F.coalesce("abun", F.lit(0)))
    each = [(way, label) for way in ("f", "r") for label in ("p", "np")]
    counts = pairs.groupBy(*site, "__v").agg(*(F.count_if(F.col(way) == label).alias(f"__{way}_{label}") for way, label in each))
    before = Window.partitionBy(*site).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    of = lambda way: F.col(f"__{way}_p") + F.col(f"__{way}_np")
    ranked = counts.withColumns({f"__{way}_mid": F.coalesce(F.sum(of(way)).over(before), F.lit(0)) + (of(way) + 1) / 2 for way in ("f", "r")})
    cube = lambda t: (t * t * t - t).cast("double")
    sums = ranked.groupBy(*site).agg(*(
        c for way in ("f", "r") for c in (
            F.sum(f"__{way}_p").alias(f"__x_{way}"), F.sum(f"__{way}_np").alias(f"__y_{way}"), F.sum(F.col(f"__{way}_p") * F.col(f"__{way}_mid")).alias(f"__s_{way}"),
            F.sum(cube(of(way))).alias(f"__t_{way}"), F.sum(F.when(F.col("__v") == 0, of(way)).otherwise(0)).alias(f"__z_{way}"),
        )
    ))
    out = {}
    for way in ("f", "r"):
        x, y, s, t, z = (F.col(f"__{c}_{way}") for c in "xystz")
        lone = (x == 0) | (y == 0)  # the 0 put in ranks amid the other zeros
        out |= {
            f"X_{way}": x, f"N_{way}": x + y, f"size_{way}": F.greatest(x, F.lit(1)), f"others_{way}": F.greatest(y, F.lit(1)),
            f"u_{way}": F.when(x == 0, z / 2).when(y == 0, x - z / 2).otherwise(s - x * (x + 1) / 2),
            f"ties_{way}": F.when(lone, t - cube(z) + cube(z + 1)).otherwise(t),
        }
        out |= {f"{c}_{way}": F.when(x + y > 0, out[f"{c}_{way}"]) for c in ("size", "others", "u", "ties")}
    return sums.select(cluster, "a_pos", "a_strand", *(c.alias(n) for n, c in out.items()))


def site_statistics(sites: DataFrame, cluster: str, phase: int) -> DataFrame:
    """The p-values of every site: hypergeometric, rank-sum and both combined, forward and reverse.

    ``sites`` has ``cluster``, ``pos``, ``strand`` and ``abun``. An empty side of the rank-sum test counts as one 0;
    where all values are equal its p-value is 1. More sites than a window can hold give a null.
    """
    out, tail = site_rank_sums(sites, cluster, phase), hypergeometric_tail(phase, CYCLES)
    for way in ("f", "r"):
        out = out.withColumn(f"pval_r_{way}", rank_sum_p(*(f"{c}_{way}" for c in ("u", "size", "others", "ties")))).withColumn(f"pval_h_{way}", tail(f"N_{way}", f"X_{way}"))
    for way in ("f", "r"):
        out = out.withColumn(f"pval_corr_{way}", stouffer(f"pval_h_{way}", f"pval_r_{way}"))
    return out.select(cluster, "a_pos", "a_strand", *(f"{c}_{way}" for c in ("X", "N") for way in ("f", "r")), *(f"{c}_{way}" for way in ("f", "r") for c in ("pval_r", "pval_h", "pval_corr")))
