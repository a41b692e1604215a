"""Queries of the general data problems: even work under heavy keys (p4), periods and gaps (p5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.operators.eager import eager_join_aggregate, heavy_groups
from locusloom.operators.intervals import interval_periods
from locusloom.session import table

HEAVY_SHARE = 0.03


def pair_totals(spark: SparkSession, d: str) -> DataFrame:
    """Rows and abundance of each library and contig, spellings joined away after the aggregation."""
    rows, contigs = table(spark, d, "phas_to_detect"), table(spark, d, "contigs")
    return eager_join_aggregate(
        rows, contigs, "chromosome", "old_id",
        left_groups={"alib": rows["alib"]}, right_groups={"chromosome": contigs["clean_id"]},
        left_sums={"abun": rows["abun"]}, count="n_rows",
    ).where(F.col("alib").isNotNull())


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Library and contig pairs that hold at least 3 % of all rows."""
    total = table(spark, d, "phas_to_detect").agg(F.count(F.lit(1))).scalar()
    return heavy_groups(pair_totals(spark, d), "n_rows", total, HEAVY_SHARE).select("alib", "chromosome")


def p4_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Per library and contig: rows, abundance, and joined rows with the scoring windows of the same cluster.

    The join of tags and windows on the cluster is many to many; one cluster holds a tenth of both sides. Both are
    reduced per cluster first.
    """
    rows, contigs, windows = (table(spark, d, n) for n in ("phas_to_detect", "contigs", "clusters_windows_to_score"))
    p = F.col("combined_window_p_value")
    valid = F.when(p.isNotNull() & ~F.isnan(p), 1).otherwise(0)
    by_spelling = eager_join_aggregate(
        rows, windows, "clusterID", "cluster_id",
        left_groups={"alib": rows["alib"], "spelling": rows["chromosome"]},
        left_sums={"window_abun": rows["abun"]}, right_sums={"valid_window_rows": valid}, count="window_rows",
    )
    joined = by_spelling.join(contigs.select("old_id", "clean_id"), F.col("spelling") == F.col("old_id"))
    joined = joined.where("alib is not null").groupBy("alib", F.col("clean_id").alias("chromosome")).agg(
        *(F.sum(c).alias(c) for c in ("window_rows", "window_abun", "valid_window_rows"))
    )
    total = rows.agg(F.count(F.lit(1))).scalar()
    return (
        pair_totals(spark, d)
        .join(joined, ["alib", "chromosome"], "left")
        .select(
            "alib", "chromosome", "n_rows", "abun",
            *(F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("window_rows", "window_abun", "valid_window_rows")),
            (F.col("n_rows") >= F.lit(HEAVY_SHARE) * total).alias("is_heavy"),
        )
    )


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Covered stretches, gaps and shared stretches of the loci of each comparison and contig."""
    loci, contigs = table(spark, d, "locus"), table(spark, d, "contigs")
    named = loci.join(contigs.select("old_id", "clean_id"), loci["chromosome"] == F.col("old_id"))
    return interval_periods(
        named,
        {"comparison_id": F.col("comparison_id"), "chromosome": F.col("clean_id")},
        F.col("start"), F.col("end"), F.col("run"),
    ).select("kind", "comparison_id", "chromosome", "period_start", "period_end")


QUERIES = {"p4_found": p4_found, "p4_pairs": p4_pairs, "p5_found": p5_found}

_PAIRS = """
  SELECT p.alib, k.clean_id AS chromosome, count(*) AS n_rows, CAST(sum(p.abun) AS BIGINT) AS abun
  FROM phas_to_detect p JOIN contigs k ON p.chromosome = k.old_id WHERE p.alib IS NOT NULL GROUP BY 1, 2"""

SQL = {
    "p4_found": f"""
WITH pairs AS ({_PAIRS})
SELECT alib, chromosome FROM pairs WHERE n_rows >= 0.03 * (SELECT count(*) FROM phas_to_detect)""",
    "p4_pairs": f"""
WITH pairs AS ({_PAIRS}),
w AS (SELECT cluster_id, count(*) AS n,
        count(*) FILTER (WHERE combined_window_p_value IS NOT NULL AND NOT isnan(combined_window_p_value)) AS v
      FROM clusters_windows_to_score GROUP BY 1),
j AS (SELECT p.alib, k.clean_id AS chromosome, sum(w.n) AS window_rows, sum(p.abun * w.n) AS window_abun, sum(w.v) AS valid_window_rows
      FROM phas_to_detect p JOIN contigs k ON p.chromosome = k.old_id JOIN w ON w.cluster_id = p.clusterID
      WHERE p.alib IS NOT NULL GROUP BY 1, 2)
SELECT alib, chromosome, n_rows, abun, CAST(coalesce(window_rows, 0) AS BIGINT) AS window_rows,
  CAST(coalesce(window_abun, 0) AS BIGINT) AS window_abun, CAST(coalesce(valid_window_rows, 0) AS BIGINT) AS valid_window_rows,
  n_rows >= 0.03 * (SELECT count(*) FROM phas_to_detect) AS is_heavy
FROM pairs LEFT JOIN j USING (alib, chromosome)""",
    "p5_found": """
WITH l AS (
  SELECT comparison_id, clean_id AS chromosome, run, least("start", "end") AS s, greatest("start", "end") AS e
  FROM locus JOIN contigs ON locus.chromosome = contigs.old_id
  WHERE "start" IS NOT NULL AND "end" IS NOT NULL AND run IS NOT NULL AND comparison_id IS NOT NULL),
fam AS (SELECT 'all' AS fam, comparison_id, chromosome, s, e FROM l UNION ALL SELECT run, comparison_id, chromosome, s, e FROM l),
b AS (SELECT *, max(e) OVER (PARTITION BY fam, comparison_id, chromosome ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM fam),
i AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY fam, comparison_id, chromosome ORDER BY s, e) AS island FROM b),
c AS (SELECT fam, comparison_id, chromosome, min(s) AS s, max(e) AS e FROM i GROUP BY fam, comparison_id, chromosome, island),
g AS (SELECT comparison_id, chromosome, e + 1 AS s, lead(s) OVER (PARTITION BY comparison_id, chromosome ORDER BY s) - 1 AS e FROM c WHERE fam = 'all'),
x AS (SELECT a.comparison_id, a.chromosome, greatest(a.s, b.s) AS s, least(a.e, b.e) AS e FROM c a JOIN c b
      ON a.comparison_id = b.comparison_id AND a.chromosome = b.chromosome AND a.s <= b.e AND b.s <= a.e
      WHERE a.fam = 'run_a' AND b.fam = 'run_b')
SELECT 'covered' AS kind, comparison_id, chromosome, s AS period_start, e AS period_end FROM c WHERE fam = 'all'
UNION ALL SELECT 'gap', comparison_id, chromosome, s, e FROM g WHERE e IS NOT NULL
UNION ALL SELECT 'shared', comparison_id, chromosome, s, e FROM x""",
}
