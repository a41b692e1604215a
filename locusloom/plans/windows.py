"""Queries over sites, windows and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.functions.loci import known
from locusloom.functions.stats import hypergeometric_tail
from locusloom.operators import labelling as LB
from locusloom.operators import windows as W
from locusloom.plans.common import PHASE, READS, reads
from locusloom.session import table

LEAST = 48


def _sites(spark: SparkSession, d: str) -> DataFrame:
    rows = reads(spark, d).where("clusterID is not null and strand is not null")
    return rows.groupBy("clusterID", "pos", "strand").agg(F.sum(F.coalesce("abun", F.lit(0))).alias("abun"))


def w3_scoring_windows(spark: SparkSession, d: str) -> DataFrame:
    """Least corrected p-values of either direction in the sliding windows of each cluster."""
    rows = reads(spark, d).where("clusterID is not null")
    length, step = W.window_shape(PHASE)
    windows = W.with_combined(W.scoring_windows(rows, "clusterID", "pval_corr_f", "pval_corr_r", length, step, LEAST))
    return windows.withColumn("combined_window_p_value", F.round("combined_window_p_value", 12))


def a12_cluster_scores(spark: SparkSession, d: str) -> DataFrame:
    """Fisher's combination of the given windows of each cluster."""
    scores = W.cluster_scores(table(spark, d, "clusters_windows_to_score"), "cluster_id", "combined_window_p_value")
    return scores.select("cluster_id", F.round("phase_score", 6).alias("phase_score"))


def n5_site_labels(spark: SparkSession, d: str) -> DataFrame:
    """Phased and unphased sites seen from every site of a cluster."""
    return LB.label_counts(_sites(spark, d), "clusterID", PHASE)


def n1_hypergeometric(spark: SparkSession, d: str) -> DataFrame:
    """Upper tails of all pairs of counts that occur."""
    pairs = table(spark, d, "phas_to_detect").where("N_f is not null and X_f is not null").select("N_f", "X_f").distinct()
    return pairs.select("N_f", "X_f", hypergeometric_tail(PHASE)("N_f", "X_f").alias("p"))


def n2_strand_rank_sums(spark: SparkSession, d: str) -> DataFrame:
    """Rank-sum statistic of Watson against Crick abundances of each cluster."""
    rows = reads(spark, d).where("clusterID is not null and strand is not null and abun is not null")
    return LB.rank_sums(rows, ["clusterID"], F.col("strand") == "w", "abun").select("clusterID", "u", "n", "m", "ties")


def n4_site_rank_sums(spark: SparkSession, d: str) -> DataFrame:
    """Rank-sum statistics of phased against other abundances around every site, forward and reverse."""
    return LB.site_rank_sums(_sites(spark, d), "clusterID", PHASE)


def n4_site_statistics(spark: SparkSession, d: str) -> DataFrame:
    """All p-values of every site."""
    return LB.site_statistics(_sites(spark, d), "clusterID", PHASE)


def n3_window_minima(spark: SparkSession, d: str) -> DataFrame:
    """Least and mean window p-value of each cluster, NaN left out, and how many windows are usable."""
    rows = table(spark, d, "clusters_windows_to_score").where("cluster_id is not null")
    p = known(F.col("combined_window_p_value"))
    return rows.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), F.count(p).alias("usable"), F.min(p).alias("least"), F.round(F.avg(p), 9).alias("mean"))


QUERIES = {f.__name__: f for f in (w3_scoring_windows, a12_cluster_scores, n1_hypergeometric, n2_strand_rank_sums, n3_window_minima, n5_site_labels, n4_site_rank_sums, n4_site_statistics)}

_ON = lambda x: f"({x} BETWEEN -1 AND 295 AND ({x} + 1 + 2100) % 21 <= 2)"

_LABELS = f"""{READS}, s AS (SELECT clusterID, pos, strand, CAST(sum(coalesce(abun, 0)) AS BIGINT) AS abun FROM reads WHERE clusterID IS NOT NULL AND strand IS NOT NULL GROUP BY 1, 2, 3),
x AS (SELECT a.clusterID, a.pos AS a_pos, a.strand AS a_strand, b.strand AS b_strand, b.abun, b.pos - a.pos AS d, (b.pos > a.pos OR (b.pos = a.pos AND b.strand <= a.strand)) AS fw, (b.pos < a.pos OR (b.pos = a.pos AND b.strand >= a.strand)) AS rv
  FROM s a JOIN s b ON a.clusterID = b.clusterID AND b.pos BETWEEN a.pos - 298 AND a.pos + 298),
l AS (SELECT *, CASE WHEN NOT fw THEN NULL WHEN CASE WHEN a_strand = b_strand THEN {_ON("d")} WHEN a_strand = 'w' THEN {_ON("(d + 3)")} ELSE {_ON("(d - 3)")} END THEN 'p'
    WHEN d <= CASE a_strand WHEN 'w' THEN 295 ELSE 298 END THEN 'np' END AS f,
  CASE WHEN NOT rv THEN NULL WHEN CASE WHEN a_strand = b_strand THEN {_ON("(-d)")} WHEN a_strand = 'w' THEN {_ON("(-d - 3)")} ELSE {_ON("(3 - d)")} END THEN 'p'
    WHEN d >= CASE a_strand WHEN 'w' THEN -298 ELSE -295 END THEN 'np' END AS r FROM x)"""

SQL = {
    "w3_scoring_windows": f"""WITH {READS},
s AS (SELECT clusterID, min(pos) AS s, max(pos) AS e FROM reads WHERE clusterID IS NOT NULL GROUP BY 1 HAVING max(pos) - min(pos) >= 48),
n AS (SELECT clusterID, s, unnest(range(0, 1 + (e - s - 23) // 5)) AS window_n FROM s)
SELECT n.clusterID, n.window_n, min(CASE WHEN NOT isnan(pval_corr_f) THEN pval_corr_f END) AS fw_pval_corr, min(CASE WHEN NOT isnan(pval_corr_r) THEN pval_corr_r END) AS rv_pval_corr,
  round(min(CASE WHEN NOT isnan(pval_corr_f) THEN pval_corr_f END) * min(CASE WHEN NOT isnan(pval_corr_r) THEN pval_corr_r END), 12) AS combined_window_p_value
FROM n JOIN reads r ON r.clusterID = n.clusterID AND r.pos >= n.s + n.window_n * 5 AND r.pos < n.s + n.window_n * 5 + 23
GROUP BY 1, 2 HAVING min(CASE WHEN NOT isnan(pval_corr_f) THEN pval_corr_f END) IS NOT NULL AND min(CASE WHEN NOT isnan(pval_corr_r) THEN pval_corr_r END) IS NOT NULL""",
    "a12_cluster_scores": """WITH w AS (SELECT cluster_id, CASE WHEN NOT isnan(combined_window_p_value) THEN combined_window_p_value END AS p FROM clusters_windows_to_score WHERE cluster_id IS NOT NULL),
c AS (SELECT cluster_id, -sum(ln(least(greatest(p, 1e-300), 1.0))) AS x, count(p) AS k FROM w GROUP BY 1),
t AS (SELECT cluster_id, x, k, i, CASE WHEN i = 0 THEN 0.0 ELSE i * ln(greatest(x, 1e-300)) - lgamma(i + 1) END AS l FROM (SELECT *, unnest(range(0, greatest(k, 1))) AS i FROM c)),
m AS (SELECT cluster_id, any_value(x) AS x, any_value(k) AS k, max(l) AS top FROM t GROUP BY 1),
s AS (SELECT m.cluster_id, m.k, -m.x + m.top + ln(sum(exp(t.l - m.top))) AS lp FROM m JOIN t USING (cluster_id) GROUP BY m.cluster_id, m.k, m.x, m.top)
SELECT cluster_id, round(CASE WHEN k = 0 THEN 0 ELSE least(300.0, -lp / ln(10)) END, 6) AS phase_score FROM s""",
    "n1_hypergeometric": """WITH q AS (SELECT DISTINCT N_f, X_f FROM phas_to_detect WHERE N_f IS NOT NULL AND X_f IS NOT NULL),
k AS (SELECT N_f, X_f, unnest(range(X_f, least(90, N_f) + 1)) AS k FROM q),
m AS (SELECT N_f, X_f, sum(CASE WHEN N_f - k <= 540 THEN exp(lgamma(91) - lgamma(k + 1) - lgamma(91 - k) + lgamma(541) - lgamma(N_f - k + 1) - lgamma(541 - N_f + k)
  - lgamma(631) + lgamma(N_f + 1) + lgamma(631 - N_f)) ELSE 0 END) AS p FROM k GROUP BY 1, 2)
SELECT N_f, X_f, CASE WHEN N_f > 630 THEN NULL ELSE round(least(coalesce(p, 0), 1), 10) END AS p FROM q LEFT JOIN m USING (N_f, X_f)""",
    "n2_strand_rank_sums": f"""WITH {READS}, v AS (SELECT clusterID, abun, count(*) FILTER (WHERE strand = 'w') AS x, count(*) FILTER (WHERE strand = 'c') AS y
  FROM reads WHERE clusterID IS NOT NULL AND strand IS NOT NULL AND abun IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, coalesce(sum(x + y) OVER (PARTITION BY clusterID ORDER BY abun ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (x + y + 1) / 2.0 AS mid FROM v)
SELECT clusterID, CAST(sum(x * mid) - sum(x) * (sum(x) + 1) / 2.0 AS DOUBLE) AS u, CAST(sum(x) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS m,
  CAST(sum(CAST(x + y AS DOUBLE) ** 3 - (x + y)) AS DOUBLE) AS ties FROM r GROUP BY 1""",
    "n3_window_minima": """WITH w AS (SELECT cluster_id, CASE WHEN NOT isnan(combined_window_p_value) THEN combined_window_p_value END AS p FROM clusters_windows_to_score WHERE cluster_id IS NOT NULL)
SELECT cluster_id, count(*) AS n, count(p) AS usable, min(p) AS least, round(avg(p), 9) AS mean FROM w GROUP BY 1""",
    "n4_site_rank_sums": f"""WITH {_LABELS},
v AS (SELECT clusterID, a_pos, a_strand, 'f' AS way, f AS label, abun FROM l WHERE f IS NOT NULL UNION ALL SELECT clusterID, a_pos, a_strand, 'r', r, abun FROM l WHERE r IS NOT NULL),
g AS (SELECT clusterID, a_pos, a_strand, way, count(*) FILTER (WHERE label = 'p') AS x, count(*) FILTER (WHERE label = 'np') AS y FROM v GROUP BY 1, 2, 3, 4),
e AS (SELECT * FROM v UNION ALL SELECT clusterID, a_pos, a_strand, way, CASE WHEN x = 0 THEN 'p' ELSE 'np' END, 0 FROM g WHERE x = 0 OR y = 0),
c AS (SELECT clusterID, a_pos, a_strand, way, abun, count(*) FILTER (WHERE label = 'p') AS x, count(*) AS t FROM e GROUP BY 1, 2, 3, 4, 5),
k AS (SELECT *, coalesce(sum(t) OVER (PARTITION BY clusterID, a_pos, a_strand, way ORDER BY abun ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2.0 AS mid FROM c),
q AS (SELECT clusterID, a_pos, a_strand, way, sum(x) AS n, sum(t) - sum(x) AS m, sum(x * mid) - sum(x) * (sum(x) + 1) / 2.0 AS u, sum(CAST(t AS DOUBLE) ** 3 - t) AS ties FROM k GROUP BY 1, 2, 3, 4),
i AS (SELECT DISTINCT clusterID, a_pos, a_strand FROM l WHERE f IS NOT NULL OR r IS NOT NULL)
SELECT i.*, CAST(coalesce(gf.x, 0) AS BIGINT) AS X_f, CAST(coalesce(gf.x + gf.y, 0) AS BIGINT) AS N_f, CAST(coalesce(gr.x, 0) AS BIGINT) AS X_r, CAST(coalesce(gr.x + gr.y, 0) AS BIGINT) AS N_r,
  CAST(qf.n AS BIGINT) AS size_f, CAST(qf.m AS BIGINT) AS others_f, CAST(qf.u AS DOUBLE) AS u_f, CAST(qf.ties AS DOUBLE) AS ties_f,
  CAST(qr.n AS BIGINT) AS size_r, CAST(qr.m AS BIGINT) AS others_r, CAST(qr.u AS DOUBLE) AS u_r, CAST(qr.ties AS DOUBLE) AS ties_r
FROM i LEFT JOIN g gf ON gf.clusterID = i.clusterID AND gf.a_pos = i.a_pos AND gf.a_strand = i.a_strand AND gf.way = 'f' LEFT JOIN g gr ON gr.clusterID = i.clusterID AND gr.a_pos = i.a_pos AND gr.a_strand = i.a_strand AND gr.way = 'r'
LEFT JOIN q qf ON qf.clusterID = i.clusterID AND qf.a_pos = i.a_pos AND qf.a_strand = i.a_strand AND qf.way = 'f' LEFT JOIN q qr ON qr.clusterID = i.clusterID AND qr.a_pos = i.a_pos AND qr.a_strand = i.a_strand AND qr.way = 'r'""",
    "n5_site_labels": f"""WITH {READS}, s AS (SELECT DISTINCT clusterID, pos, strand FROM reads WHERE clusterID IS NOT NULL AND strand IS NOT NULL),
x AS (SELECT a.clusterID, a.pos AS a_pos, a.strand AS a_strand, b.strand AS b_strand, b.pos - a.pos AS d, (b.pos > a.pos OR (b.pos = a.pos AND b.strand <= a.strand)) AS fw, (b.pos < a.pos OR (b.pos = a.pos AND b.strand >= a.strand)) AS rv
  FROM s a JOIN s b ON a.clusterID = b.clusterID AND b.pos BETWEEN a.pos - 298 AND a.pos + 298),
l AS (SELECT *, CASE WHEN NOT fw THEN NULL WHEN CASE WHEN a_strand = b_strand THEN {_ON("d")} WHEN a_strand = 'w' THEN {_ON("(d + 3)")} ELSE {_ON("(d - 3)")} END THEN 'p'
    WHEN d <= CASE a_strand WHEN 'w' THEN 295 ELSE 298 END THEN 'np' END AS f,
  CASE WHEN NOT rv THEN NULL WHEN CASE WHEN a_strand = b_strand THEN {_ON("(-d)")} WHEN a_strand = 'w' THEN {_ON("(-d - 3)")} ELSE {_ON("(3 - d)")} END THEN 'p'
    WHEN d >= CASE a_strand WHEN 'w' THEN -298 ELSE -295 END THEN 'np' END AS r FROM x)
SELECT clusterID, a_pos, a_strand, count(*) FILTER (WHERE f = 'p') AS X_f, count(f) AS N_f, count(*) FILTER (WHERE r = 'p') AS X_r, count(r) AS N_r
FROM l WHERE f IS NOT NULL OR r IS NOT NULL GROUP BY 1, 2, 3""",
}
