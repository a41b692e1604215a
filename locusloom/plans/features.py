"""Queries over cluster features: scores, calls, evidence, reports and plot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.functions.loci import gff_attributes, known, locus_parts
from locusloom.operators import classify as CL
from locusloom.operators import features as FE
from locusloom.operators.numbering import absent_cell, dense_cells
from locusloom.operators.windows import cluster_scores, score_cutoff
from locusloom.plans.common import PHASE, READS, reads
from locusloom.session import table

SCORE, PEAK, COMPLEXITY = 50.0, 12.5, 0.3


def _features(spark: SparkSession, d: str) -> DataFrame:
    """Feature rows with their keys, identical repeats once whenever they were loaded; loads that differ are rows of their own."""
    rows = table(spark, d, "features").where("identifier is not null and alib is not null and cID is not null")
    return rows.drop("loaded_at").distinct()


def a13_cluster_features(spark: SparkSession, d: str) -> DataFrame:
    rows = FE.cluster_features(reads(spark, d).where("clusterID is not null"), "clusterID", PHASE)
    return rows.select("clusterID", "start", "end", "total_abund", *(F.round(c, 9).alias(c) for c in ("strand_bias", "ratio_abund_len_phase", "log_clust_len_norm_counts", "complexity")))


def a14_phase_positions(spark: SparkSession, d: str) -> DataFrame:
    return FE.phase_positions(reads(spark, d), "clusterID", PHASE)


def w8_best_rows(spark: SparkSession, d: str) -> DataFrame:
    """The best feature row of each identifier and library; a score that is NaN is unknown."""
    scores = (known(F.col(c)).alias(c) for c in ("Howell_exact_support_score", "Peak_Howell_score", "phase_score"))
    return FE.best_rows(_features(spark, d), ["identifier", "alib"]).select("identifier", "alib", "cID", *scores)


def w9_longest_empty_run(spark: SparkSession, d: str) -> DataFrame:
    return FE.longest_empty_run(a14_phase_positions(spark, d), "clusterID", PHASE)


def j4_identifiers(spark: SparkSession, d: str) -> DataFrame:
    """Scoring windows of the clusters that have an identifier, counted per identifier."""
    ids = table(spark, d, "phas_to_detect").where("clusterID is not null").select(F.col("clusterID").alias("cluster_id"), "identifier").distinct()
    windows = table(spark, d, "clusters_windows_to_score").where("cluster_id is not null").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("windows"))
    return windows.join(ids, "cluster_id").groupBy("identifier").agg(F.sum("windows").alias("windows"), F.count_distinct("cluster_id").alias("clusters"))


def j6_feature_scores(spark: SparkSession, d: str) -> DataFrame:
    """Feature rows with the score of their cluster's windows, 0 where it has none."""
    scores = cluster_scores(table(spark, d, "clusters_windows_to_score"), "cluster_id", "combined_window_p_value")
    rows = _features(spark, d).select("identifier", "alib", "cID").distinct()
    joined = rows.join(scores, rows["cID"] == F.col("cluster_id"), "left")
    return joined.select("identifier", "alib", "cID", F.round(F.coalesce("phase_score", F.lit(0.0)), 6).alias("score"))


def j6_scores_by_any_id(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the windows for cluster ids with a file name in front: by the id as it is, by the bare one, by the place of its locus, else 0."""
    scores = cluster_scores(table(spark, d, "clusters_windows_to_score"), "cluster_id", "combined_window_p_value")
    ids = table(spark, d, "phas_to_detect").where("clusterID is not null and identifier is not null").groupBy("clusterID").agg(F.min("identifier").alias("place"))
    rows = _features(spark, d).select("alib", "cID", "identifier").distinct()
    given = F.when(F.pmod(F.length("cID"), F.lit(2)) == 0, F.concat(F.col("alib"), F.lit(f".{PHASE}-PHAS.candidate.clusters"), F.col("alib"), F.lit("-"), F.col("cID"))).otherwise(F.col("cID"))
    return FE.scores_by_any_id(rows.select("alib", given.alias("cID"), "identifier"), scores, ids, PHASE).select("alib", "cID", "identifier", "found_by", F.round("score", 6).alias("score"))


def _calls(spark: SparkSession, d: str) -> DataFrame:
    rows = FE.best_rows(_features(spark, d), ["identifier", "alib"])
    label = CL.filtered_label(F.lit("PHAS"), score_cutoff(PHASE, SCORE), PEAK, COMPLEXITY)
    return rows.withColumn("label", label).withColumn("__e", CL.evidence(F.col("label"))).select("*", "__e.*").drop("__e")


def f10_filtered_labels(spark: SparkSession, d: str) -> DataFrame:
    return _calls(spark, d).select("identifier", "alib", "cID", "label")


def f11_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Class and deciding rule of the best row of each identifier and library."""
    return _calls(spark, d).select("identifier", "alib", "final_class", "evidence_reason")


def j11_overrides(spark: SparkSession, d: str) -> DataFrame:
    """Calls with overrides: the ambiguous origins of strong peaks are named PHAS-like, in another spelling."""
    calls = _calls(spark, d)
    given = calls.where((F.col("Howell_origin_class") == "ambiguous_origin") & (known(F.col("Peak_Howell_score")) >= 20)).select("identifier", "alib", F.lit(" phas_like ").alias("final_class"))
    return CL.with_overrides(calls.select("identifier", "alib", "final_class", "evidence_reason"), given)


def n13_mixture_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of a two-component mixture over the scaled features."""
    rows = _features(spark, d)
    return CL.mixture_labels(rows.select("identifier", "alib", "cID", "Peak_Howell_score", *CL.MODEL_FEATURES))


def a16_mixture_means(spark: SparkSession, d: str) -> DataFrame:
    return n13_mixture_labels(spark, d).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg("phase_score").alias("phase_score"))


def a17_detections(spark: SparkSession, d: str) -> DataFrame:
    """Loci and detections of each library by final class."""
    return f11_evidence(spark, d).groupBy("alib", "final_class").agg(F.count(F.lit(1)).alias("detections"), F.count_distinct("identifier").alias("loci"))


def a22_pooled(spark: SparkSession, d: str) -> DataFrame:
    """Rows by library mode: pooled only if every row is of the pool."""
    rows = table(spark, d, "features")
    return rows.groupBy().agg(F.count(F.lit(1)).alias("n"), F.count_distinct("alib").alias("libraries"), F.coalesce(F.bool_and(F.col("alib") == "ALL_LIBS"), F.lit(False)).alias("pooled"))


def a25_scaled(spark: SparkSession, d: str) -> DataFrame:
    out = CL.scaled(_features(spark, d), CL.MODEL_FEATURES)
    return out.select("identifier", "alib", "cID", *(F.round(f"{c}_scaled", 9).alias(c) for c in CL.MODEL_FEATURES))


def k6_gff_lines(spark: SparkSession, d: str) -> DataFrame:
    """GFF lines, one for each identifier: of its best call over all libraries."""
    rows = FE.best_rows(_features(spark, d), ["identifier"])
    contig, start, end = locus_parts(F.col("identifier"))
    attributes = gff_attributes({"ID": F.col("identifier"), "library": F.col("alib"), "cluster": F.col("cID")})
    line = F.concat_ws("\t", contig, F.lit("locusloom"), F.lit(f"{PHASE}-PHAS"), start.cast("string"), end.cast("string"), F.lit("."), F.lit("."), F.lit("."), attributes)
    return rows.where(contig.isNotNull()).select("identifier", line.alias("line"))


def _report(spark: SparkSession, d: str) -> DataFrame:
    """Calls of the identifiers that are PHAS in at least one library."""
    calls = _calls(spark, d)
    return calls.join(calls.where("final_class = 'PHAS'").select("identifier").distinct(), "identifier", "left_semi")


def v1_report_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the report: 2 where PHAS, 1 where not, for identifiers with a PHAS call; absent cells are left out."""
    return _report(spark, d).groupBy("identifier", "alib").agg(F.min(F.when(F.col("final_class") == "PHAS", 2).otherwise(1)).alias("cell"))


def v1_report_grid(spark: SparkSession, d: str) -> DataFrame:
    """The dense report: each identifier with a PHAS call by each library, 0 where the library has no cell."""
    calls = _calls(spark, d)
    return dense_cells(v1_report_cells(spark, d), calls, "identifier", "alib", "cell", absent_cell(PHASE))


def j12_plot_rows(spark: SparkSession, d: str) -> DataFrame:
    """Aligned tags of each PHAS call: those of its cluster, and only where there are none those of its identifier."""
    calls = f11_evidence(spark, d).where("final_class = 'PHAS'")
    best = w8_best_rows(spark, d).join(calls, ["identifier", "alib"]).select("identifier", "alib", "cID")
    rows = reads(spark, d).groupBy("clusterID", "identifier").agg(F.count(F.lit(1)).alias("n"), F.sum("abun").alias("abun"))
    sums = lambda key: rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.sum("n").alias("n"), F.sum("abun").alias("abun"))
    by_cluster = best.join(sums("clusterID"), F.col("cID") == F.col("__k"), "left").drop("__k")
    found = by_cluster.where("n is not null").select("identifier", "alib", F.lit("cluster").alias("by"), "n", "abun")
    rest = by_cluster.where("n is null").select("identifier", "alib").join(sums("identifier"), F.col("identifier") == F.col("__k"))
    return found.unionByName(rest.select("identifier", "alib", F.lit("identifier").alias("by"), "n", "abun"))


def v2_abundance_cells(spark: SparkSession, d: str) -> DataFrame:
    """Normalised and total abundance (logarithm, 0 as the least) of PHAS cells."""
    rows = _report(spark, d).where("final_class = 'PHAS'")
    total = F.coalesce(known(F.col("total_abund")), F.lit(0.0))
    return rows.groupBy("identifier", "alib").agg(
        F.max(known(F.col("log_clust_len_norm_counts"))).alias("clnc"), F.round(F.max(F.log10(F.when(total > 0, total).otherwise(1e-10))), 9).alias("log_total")
    )


def v3_total_abundance_cells(spark: SparkSession, d: str) -> DataFrame:
    """Total abundance (logarithm, 0 as the least) of all cells, PHAS or not; that of a PHAS cell is of its PHAS rows."""
    rows = _report(spark, d)
    total, phas = F.coalesce(known(F.col("total_abund")), F.lit(0.0)), F.col("final_class") == "PHAS"
    value = F.log10(F.when(total > 0, total).otherwise(1e-10))
    return rows.groupBy("identifier", "alib").agg(F.coalesce(F.bool_or(phas), F.lit(False)).alias("is_phas"), F.round(F.coalesce(F.max(F.when(phas, value)), F.max(value)), 9).alias("log_total"))


def v4_peak_cells(spark: SparkSession, d: str) -> DataFrame:
    """Peak scores, relaxed and strict, with the PHAS mask."""
    rows = _report(spark, d)
    return rows.groupBy("identifier", "alib").agg(
        F.max(known(F.col("Peak_Howell_score"))).alias("peak"), F.max(known(F.col("Peak_Howell_score_strict"))).alias("strict"), F.bool_or(F.col("final_class") == "PHAS").alias("is_phas")
    )


def v5_abundance_track(spark: SparkSession, d: str) -> DataFrame:
    """Signed abundance by position of each cluster, and whether a tag there has several hits."""
    rows = reads(spark, d).where("clusterID is not null and strand is not null and abun is not null")
    signed = F.when(F.col("strand") == "w", F.col("abun")).otherwise(-F.col("abun"))
    return rows.groupBy("clusterID", "pos", "strand", "len").agg(F.sum(signed).alias("y"), F.coalesce(F.bool_or(F.col("hits") > 1), F.lit(False)).alias("multi"))


def f13_plot_sources(spark: SparkSession, d: str) -> DataFrame:
    """Aligned tags behind the PHAS calls, by cluster or by identifier, counted per cluster."""
    calls = f11_evidence(spark, d).where("final_class = 'PHAS'")
    best = w8_best_rows(spark, d).join(calls, ["identifier", "alib"]).select("cID", "identifier")
    rows = reads(spark, d).where("clusterID is not null").groupBy("clusterID", "identifier").agg(F.count(F.lit(1)).alias("n"), F.sum("abun").alias("abun"))
    by_cluster = rows.join(best.select(F.col("cID").alias("clusterID")).distinct(), "clusterID", "left_semi").select("clusterID", "identifier", "n", "abun")
    by_identifier = rows.join(best.select("identifier").distinct(), "identifier", "left_semi").select("clusterID", "identifier", "n", "abun")
    return by_cluster.unionByName(by_identifier).distinct()


QUERIES = {
    f.__name__: f
    for f in (
        a13_cluster_features, a14_phase_positions, w8_best_rows, w9_longest_empty_run, j4_identifiers, j6_feature_scores, j6_scores_by_any_id, f10_filtered_labels,
        f11_evidence, j11_overrides, n13_mixture_labels, a16_mixture_means, a17_detections, a22_pooled, a25_scaled, k6_gff_lines,
        v1_report_cells, v1_report_grid, j12_plot_rows, v2_abundance_cells, v3_total_abundance_cells, v4_peak_cells, v5_abundance_track, f13_plot_sources,
    )
}

_N = lambda c: f"CASE WHEN NOT isnan({c}) THEN {c} END"
_ROWS = "f AS (SELECT DISTINCT * EXCLUDE (loaded_at) FROM features WHERE identifier IS NOT NULL AND alib IS NOT NULL AND cID IS NOT NULL)"
_RANK = f"""{_N('Howell_exact_support_score')} DESC NULLS LAST, {_N('Peak_Howell_score')} DESC NULLS LAST, {_N('phase_score')} DESC NULLS LAST, cID"""
_BEST = f"""{_ROWS}, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY identifier, alib ORDER BY {_RANK}) AS r FROM f) WHERE r = 1)"""
# fixed values: the thresholds of the filters and of the evidence rules, as operators/classify.py has them
_CALLS = f"""{_BEST},
lab AS (SELECT *, CASE WHEN coalesce({_N('phase_score')} < 50 OR {_N('Peak_Howell_score')} < 12.5, false) OR coalesce({_N('complexity')} > 0.3, false) THEN 'non-PHAS' ELSE 'PHAS' END AS label,
  {_N('Howell_exact_support_score')} AS ex, {_N('Peak_Howell_score')} AS pk, {_N('Peak_Howell_score_strict')} AS st, coalesce({_N('Howell_crowding_window_count')}, 0) AS cr,
  coalesce({_N('Howell_overlapping_alt_count')}, 0) AS al, {_N('Howell_overlapping_alt_best_score')} AS ab, {_N('complexity')} AS cx, coalesce(trim(Howell_origin_class), '') AS oc FROM best),
rs AS (SELECT *, CASE WHEN label <> 'PHAS' THEN 'classifier_non_phas' WHEN ex IS NULL OR ex <= 0 OR oc = 'insufficient_exact_support' THEN 'insufficient_exact_support'
  WHEN ex < 5 THEN 'weak_exact_support' WHEN coalesce(pk > 12.5 AND pk < 20, false) AND cr >= 5 THEN 'low_score_crowded_window_context'
  WHEN coalesce(pk >= 20 AND pk < 30, false) AND (coalesce(pk > 0 AND ex / pk < 0.2, false) OR coalesce(pk > 0 AND st / pk < 0.4, false))
    AND (oc IN ('ambiguous_origin', 'mixed_extension_and_ambiguity') OR cr >= 7 OR al >= 2 OR coalesce(pk - ab <= 4, false) OR coalesce(cx >= 0.2, false)) THEN 'weak_scaffold_alternative_context'
  ELSE 'pass' END AS evidence_reason FROM lab),
calls AS (SELECT *, CASE WHEN evidence_reason IN ('classifier_non_phas', 'insufficient_exact_support') THEN 'non-PHAS' WHEN evidence_reason = 'pass' THEN 'PHAS' ELSE 'PHAS-like' END AS final_class FROM rs)"""
_REPORT = f"{_CALLS}, rep AS (SELECT * FROM calls WHERE identifier IN (SELECT identifier FROM calls WHERE final_class = 'PHAS'))"
_FISHER = """c AS (SELECT cluster_id, -sum(ln(least(greatest(p, 1e-300), 1.0))) AS x, count(p) AS k FROM (SELECT cluster_id, CASE WHEN NOT isnan(combined_window_p_value) THEN combined_window_p_value END AS p
  FROM clusters_windows_to_score WHERE cluster_id IS NOT NULL) GROUP BY 1),
tt AS (SELECT cluster_id, x, k, CASE WHEN i = 0 THEN 0.0 ELSE i * ln(greatest(x, 1e-300)) - lgamma(i + 1) END AS l FROM (SELECT *, unnest(range(0, greatest(k, 1))) AS i FROM c)),
mm AS (SELECT cluster_id, any_value(x) AS x, any_value(k) AS k, max(l) AS top FROM tt GROUP BY 1),
sc AS (SELECT mm.cluster_id, CASE WHEN mm.k = 0 THEN 0 ELSE least(300.0, (mm.x - mm.top - ln(sum(exp(tt.l - mm.top)))) / ln(10)) END AS score FROM mm JOIN tt USING (cluster_id) GROUP BY mm.cluster_id, mm.k, mm.x, mm.top)"""
_SCALE = lambda c: f"""round(CASE WHEN max({_N(c)}) OVER () > min({_N(c)}) OVER () THEN ({_N(c)} - min({_N(c)}) OVER ()) / (max({_N(c)}) OVER () - min({_N(c)}) OVER ()) WHEN {_N(c)} IS NOT NULL THEN 0 END, 9) AS {c}"""

SQL = {
    "a13_cluster_features": f"""WITH {READS}, g AS (SELECT clusterID, min(pos) AS s, max(pos) AS e, sum(coalesce(abun, 0)) AS total, count(*) FILTER (WHERE strand = 'w') AS w, count(*) FILTER (WHERE strand = 'c') AS c,
  coalesce(sum(coalesce(abun, 0)) FILTER (WHERE len = 21), 0) AS on_, coalesce(sum(coalesce(abun, 0)) FILTER (WHERE len <> 21), 0) AS off_,
  coalesce(sum(coalesce(abun, 0)) FILTER (WHERE len = 21 AND strand IS NOT NULL), 0) AS os, count(DISTINCT tag_seq) AS tags FROM reads WHERE clusterID IS NOT NULL GROUP BY 1)
SELECT clusterID, s AS "start", e AS "end", CAST(total AS DOUBLE) AS total_abund, round(CASE WHEN w + c > 0 THEN CAST(w AS DOUBLE) / (w + c) ELSE 1 END, 9) AS strand_bias,
  round(CASE WHEN off_ > 0 THEN CAST(on_ AS DOUBLE) / CAST(off_ AS DOUBLE) ELSE 1 END, 9) AS ratio_abund_len_phase,
  round(log10(CASE WHEN e - s - 21 > 0 THEN CAST(os AS DOUBLE) / (e - s - 21) ELSE 0 END + 1), 9) AS log_clust_len_norm_counts,
  round(CASE WHEN total > 0 THEN CAST(tags AS DOUBLE) / CAST(total AS DOUBLE) ELSE 0 END, 9) AS complexity FROM g""",
    "a14_phase_positions": f"WITH {READS} SELECT clusterID, strand, pos, CAST(sum(coalesce(abun, 0)) AS BIGINT) AS abun FROM reads WHERE len = 21 AND strand IS NOT NULL AND clusterID IS NOT NULL GROUP BY 1, 2, 3",
    "w8_best_rows": f"WITH {_BEST} SELECT identifier, alib, cID, {', '.join(f'{_N(c)} AS {c}' for c in ('Howell_exact_support_score', 'Peak_Howell_score', 'phase_score'))} FROM best",
    "w9_longest_empty_run": f"""WITH {READS}, c AS (SELECT DISTINCT clusterID, pos % 21 AS register, pos // 21 AS cycle FROM reads WHERE len = 21 AND strand = 'w' AND clusterID IS NOT NULL),
g AS (SELECT *, coalesce(cycle - lag(cycle) OVER (PARTITION BY clusterID, register ORDER BY cycle) - 1, 0) AS empty FROM c)
SELECT clusterID, register, count(*) AS supported, max(empty) AS longest_empty FROM g GROUP BY 1, 2""",
    "j4_identifiers": """WITH i AS (SELECT DISTINCT clusterID, identifier FROM phas_to_detect WHERE clusterID IS NOT NULL), w AS (SELECT cluster_id, count(*) AS n FROM clusters_windows_to_score WHERE cluster_id IS NOT NULL GROUP BY 1)
SELECT identifier, CAST(sum(n) AS BIGINT) AS windows, count(DISTINCT cluster_id) AS clusters FROM w JOIN i ON cluster_id = clusterID GROUP BY 1""",
    "j6_feature_scores": f"WITH {_ROWS}, {_FISHER}, k AS (SELECT DISTINCT identifier, alib, cID FROM f) SELECT identifier, alib, cID, round(coalesce(score, 0), 6) AS score FROM k LEFT JOIN sc ON cID = cluster_id",
    "j6_scores_by_any_id": f"""WITH {_ROWS}, {_FISHER}, i AS (SELECT clusterID, min(identifier) AS place FROM phas_to_detect WHERE clusterID IS NOT NULL AND identifier IS NOT NULL GROUP BY 1),
pl AS (SELECT place, max(score) AS score FROM sc JOIN i ON cluster_id = clusterID GROUP BY 1), k AS (SELECT DISTINCT alib, cID, identifier FROM f),
g AS (SELECT alib, identifier, cID AS bare, CASE WHEN length(cID) % 2 = 0 THEN alib || '.21-PHAS.candidate.clusters' || alib || '-' || cID ELSE cID END AS cID FROM k)
SELECT alib, cID, g.identifier, CASE WHEN a.score IS NOT NULL THEN 'id' WHEN b.score IS NOT NULL THEN 'bare id' WHEN pl.score IS NOT NULL THEN 'place' END AS found_by, round(coalesce(a.score, b.score, pl.score, 0), 6) AS score
FROM g LEFT JOIN sc a ON a.cluster_id = g.cID LEFT JOIN sc b ON b.cluster_id = g.bare LEFT JOIN pl ON pl.place = g.identifier""",
    "f10_filtered_labels": f"WITH {_CALLS} SELECT identifier, alib, cID, label FROM calls",
    "f11_evidence": f"WITH {_CALLS} SELECT identifier, alib, final_class, evidence_reason FROM calls",
    "j11_overrides": f"""WITH {_CALLS} SELECT identifier, alib, CASE WHEN Howell_origin_class = 'ambiguous_origin' AND pk >= 20 THEN 'PHAS-like' ELSE final_class END AS final_class,
CASE WHEN Howell_origin_class = 'ambiguous_origin' AND pk >= 20 THEN 'manual_override' ELSE evidence_reason END AS evidence_reason FROM calls""",
    "a17_detections": f"WITH {_CALLS} SELECT alib, final_class, count(*) AS detections, count(DISTINCT identifier) AS loci FROM calls GROUP BY 1, 2",
    "a22_pooled": "SELECT count(*) AS n, count(DISTINCT alib) AS libraries, coalesce(bool_and(alib = 'ALL_LIBS'), false) AS pooled FROM features",
    "a25_scaled": f"WITH {_ROWS} SELECT identifier, alib, cID, {', '.join(_SCALE(c) for c in CL.MODEL_FEATURES)} FROM f",
    "k6_gff_lines": f"""WITH {_ROWS}, b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY {_RANK}) AS r FROM f) WHERE r = 1)
SELECT identifier, concat_ws(chr(9), split_part(identifier, ':', 1), 'locusloom', '21-PHAS', split_part(split_part(identifier, ':', 2), '..', 1), split_part(identifier, '..', 2), '.', '.', '.',
  'ID=' || identifier || ';library=' || alib || ';cluster=' || cID) AS line FROM b""",
    "v1_report_cells": f"WITH {_REPORT} SELECT identifier, alib, min(CASE final_class WHEN 'PHAS' THEN 2 ELSE 1 END) AS cell FROM rep GROUP BY 1, 2",
    "v1_report_grid": f"""WITH {_REPORT}, c AS (SELECT identifier, alib, min(CASE final_class WHEN 'PHAS' THEN 2 ELSE 1 END) AS cell FROM rep GROUP BY 1, 2)
SELECT i.identifier, l.alib, coalesce(cell, 0) AS cell FROM (SELECT DISTINCT identifier FROM rep) i CROSS JOIN (SELECT DISTINCT alib FROM calls) l LEFT JOIN c ON c.identifier = i.identifier AND c.alib = l.alib""",
    "j12_plot_rows": f"""WITH {READS}, {_CALLS}, p AS (SELECT identifier, alib, cID FROM calls WHERE final_class = 'PHAS'),
bc AS (SELECT clusterID, count(*) AS n, CAST(sum(abun) AS BIGINT) AS abun FROM reads WHERE clusterID IS NOT NULL GROUP BY 1), bi AS (SELECT identifier, count(*) AS n, CAST(sum(abun) AS BIGINT) AS abun FROM reads WHERE identifier IS NOT NULL GROUP BY 1)
SELECT p.identifier, p.alib, CASE WHEN bc.n IS NOT NULL THEN 'cluster' ELSE 'identifier' END AS "by", coalesce(bc.n, bi.n) AS n, CASE WHEN bc.n IS NOT NULL THEN bc.abun ELSE bi.abun END AS abun
FROM p LEFT JOIN bc ON bc.clusterID = p.cID LEFT JOIN bi ON bi.identifier = p.identifier WHERE bc.n IS NOT NULL OR bi.n IS NOT NULL""",
    "v2_abundance_cells": f"""WITH {_REPORT} SELECT identifier, alib, max({_N('log_clust_len_norm_counts')}) AS clnc,
round(max(log10(CASE WHEN coalesce({_N('total_abund')}, 0) > 0 THEN total_abund ELSE 1e-10 END)), 9) AS log_total FROM rep WHERE final_class = 'PHAS' GROUP BY 1, 2""",
    "v3_total_abundance_cells": f"""WITH {_REPORT}, t AS (SELECT *, log10(CASE WHEN coalesce({_N('total_abund')}, 0) > 0 THEN total_abund ELSE 1e-10 END) AS v FROM rep)
SELECT identifier, alib, coalesce(bool_or(final_class = 'PHAS'), false) AS is_phas, round(coalesce(max(v) FILTER (WHERE final_class = 'PHAS'), max(v)), 9) AS log_total FROM t GROUP BY 1, 2""",
    "v4_peak_cells": f"WITH {_REPORT} SELECT identifier, alib, max({_N('Peak_Howell_score')}) AS peak, max({_N('Peak_Howell_score_strict')}) AS strict, bool_or(final_class = 'PHAS') AS is_phas FROM rep GROUP BY 1, 2",
    "v5_abundance_track": f"""WITH {READS} SELECT clusterID, pos, strand, len, CAST(sum(CASE strand WHEN 'w' THEN abun ELSE -abun END) AS BIGINT) AS y, coalesce(bool_or(hits > 1), false) AS multi
FROM reads WHERE clusterID IS NOT NULL AND strand IS NOT NULL AND abun IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "f13_plot_sources": f"""WITH {READS}, {_CALLS}, p AS (SELECT cID, identifier FROM calls WHERE final_class = 'PHAS')
SELECT clusterID, identifier, count(*) AS n, CAST(sum(abun) AS BIGINT) AS abun FROM reads WHERE clusterID IS NOT NULL
AND (clusterID IN (SELECT cID FROM p) OR identifier IN (SELECT identifier FROM p)) GROUP BY 1, 2""",
}
