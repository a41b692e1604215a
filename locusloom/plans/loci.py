"""Queries over loci: groups across libraries, comparison of runs, matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.functions.loci import locus_id, overlap_nt
from locusloom.operators import compare as CP
from locusloom.operators.overlaps import overlap_groups, overlap_join
from locusloom.plans.common import BUFFER, READS
from locusloom.plans.reads import a10_cluster_loci
from locusloom.session import table
from locusloom.sources.alignments import parse_calls

FLANK = 250
_RUN = ["comparison_id"]
_KEYS = ["comparison_id", "chromosome"]


def _loci(spark: SparkSession, d: str, run: str) -> DataFrame:
    """Distinct loci of one run, contigs in one spelling, ends in order."""
    loci, contigs = table(spark, d, "locus"), table(spark, d, "contigs")
    named = loci.where(F.col("run") == run).join(contigs.select("old_id", "clean_id"), F.col("chromosome") == F.col("old_id"))
    ends = named.select("comparison_id", F.col("clean_id").alias("chromosome"), "identifier", F.least("start", "end").alias("start"), F.greatest("start", "end").alias("end"), F.col("start").alias("s"), F.col("end").alias("e"))
    return ends.dropna().drop("s", "e").distinct()


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return CP.run_overlaps(_loci(spark, d, "run_a"), _loci(spark, d, "run_b"), _KEYS)


def j2_locus_groups(spark: SparkSession, d: str) -> DataFrame:
    """Cluster loci of all libraries with the extent of their overlap group."""
    loci = a10_cluster_loci(spark, d).select("clusterID", "chromosome", "start", "end")
    groups = overlap_groups(loci, ["chromosome"], BUFFER)
    return groups.select("clusterID", locus_id(F.col("chromosome"), F.col("group_start"), F.col("group_end")).alias("identifier"))


def a23_group_members(spark: SparkSession, d: str) -> DataFrame:
    """Members of each overlap group: how many, the first and the last."""
    return j2_locus_groups(spark, d).groupBy("identifier").agg(F.count_distinct("clusterID").alias("members"), F.min("clusterID").alias("first_member"), F.max("clusterID").alias("last_member"))


def j2_locus_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of cluster loci within the buffer of each other."""
    loci = a10_cluster_loci(spark, d)
    a = loci.select("chromosome", F.col("clusterID").alias("cluster_a"), "start", "end")
    b = loci.select("chromosome", F.col("clusterID").alias("cluster_b"), "start", "end")
    pairs = overlap_join(a, b, ["chromosome"], BUFFER).where("cluster_a < cluster_b")
    return pairs.select("chromosome", "cluster_a", "cluster_b", overlap_nt(F.col("start_a"), F.col("end_a"), F.col("start_b"), F.col("end_b")).alias("overlap_nt"))


def j8_run_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d)


def a20_overlap_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Shapes of the relationships between both runs of each comparison."""
    shaped = CP.overlap_shapes(_pairs(spark, d), _RUN)
    return shaped.groupBy("comparison_id", "shape").agg(F.count(F.lit(1)).alias("pairs"), F.sum("overlap_nt").alias("overlap_nt"), F.max("matches_a").alias("most_a"), F.max("matches_b").alias("most_b"))


def j9_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Loci of the second run that overlap none of the first."""
    matched = _pairs(spark, d).select("comparison_id", F.col("id_b").alias("identifier")).distinct()
    return _loci(spark, d, "run_b").join(matched, ["comparison_id", "identifier"], "left_anti").select(*_KEYS, "identifier", "start", "end")


def u6_combined_loci(spark: SparkSession, d: str) -> DataFrame:
    """All loci of the first run and the unmatched ones of the second."""
    a, b = _loci(spark, d, "run_a"), _loci(spark, d, "run_b")
    return CP.combined_loci(a, b, CP.run_overlaps(a, b, _KEYS), _RUN, "id_b")


def a21_combined_summary(spark: SparkSession, d: str) -> DataFrame:
    return u6_combined_loci(spark, d).groupBy("comparison_id", "origin").agg(F.count(F.lit(1)).alias("loci"), F.sum(F.col("end") - F.col("start") + 1).alias("covered"))


def a20_overlap_audit(spark: SparkSession, d: str) -> DataFrame:
    """The stored overlaps of each comparison against the computed ones: repeated, without or with a wrong length."""
    stored, contigs = table(spark, d, "overlap"), table(spark, d, "contigs")
    rows = stored.join(contigs.select("old_id", "clean_id"), F.col("chromosome") == F.col("old_id"), "left")
    rows = rows.groupBy("comparison_id", "run_a_identifier", "run_b_identifier").agg(F.count(F.lit(1)).alias("n"), F.max("overlap_nt").alias("nt"))
    real = _pairs(spark, d).groupBy("comparison_id", F.col("id_a").alias("run_a_identifier"), F.col("id_b").alias("run_b_identifier")).agg(F.max("overlap_nt").alias("real"))
    both = rows.join(real, ["comparison_id", "run_a_identifier", "run_b_identifier"], "full")
    return both.groupBy("comparison_id").agg(
        F.count("n").alias("stored"), F.count("real").alias("computed"), F.count_if(F.col("n") > 1).alias("repeated"),
        F.count_if(F.col("n").isNotNull() & F.col("nt").isNull()).alias("without_length"), F.count_if(F.col("nt") != F.col("real")).alias("wrong_length"),
        F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("real").isNull()).alias("without_loci"),
    )


def _sources(spark: SparkSession, d: str, prefer: str = "run_a") -> DataFrame:
    a, b = _loci(spark, d, "run_a"), _loci(spark, d, "run_b")
    return CP.source_map(a, b, CP.run_overlaps(a, b, _KEYS), _RUN, prefer)


def k8_source_map(spark: SparkSession, d: str) -> DataFrame:
    """Combined loci of each comparison with the loci of either run behind them."""
    return _sources(spark, d)


def k8_combined_rows(spark: SparkSession, d: str) -> DataFrame:
    """Combined loci of each comparison where the second run is preferred, with their category and support."""
    return CP.combined_rows(_sources(spark, d, "run_b"), _RUN)


def k8_summary(spark: SparkSession, d: str) -> DataFrame:
    a, b = _loci(spark, d, "run_a"), _loci(spark, d, "run_b")
    pairs = CP.run_overlaps(a, b, _KEYS)
    return CP.comparison_summary(a, b, pairs, CP.source_map(a, b, pairs, _RUN), _RUN)


def k8_canonical_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the loci as they were loaded that stand for a combined locus."""
    rows = table(spark, d, "locus").where("identifier is not null")
    run = lambda r: rows.where(F.col("run") == r).drop("run")
    return CP.canonical_rows(run("run_a"), run("run_b"), _sources(spark, d), _RUN).groupBy("comparison_id", "source_run", "identifier").agg(F.count(F.lit(1)).alias("rows"))


def s14_text_calls(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a table of calls with the loci as they were loaded, read back as half-open intervals; bad rows are skipped."""
    loci = table(spark, d, "locus")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    header = "identifier\talib\tachr\tstart\tend"
    lines = loci.select(F.concat_ws("\t", text("identifier"), text("run"), text("chromosome"), text("start"), text("end")).alias("value"))
    return parse_calls(lines, header).distinct()


def j10_matches(spark: SparkSession, d: str) -> DataFrame:
    """Calls of the first run against the loci of the second, within a flank."""
    return CP.match_calls(_loci(spark, d, "run_a"), _loci(spark, d, "run_b"), _KEYS, FLANK)


def a19_match_metrics(spark: SparkSession, d: str) -> DataFrame:
    return CP.match_metrics(j10_matches(spark, d), _RUN, "chromosome")


def u5_shared_contigs(spark: SparkSession, d: str) -> DataFrame:
    """Contigs on which both runs of a comparison have loci."""
    at = lambda run: _loci(spark, d, run).select(*_KEYS).distinct()
    return at("run_a").intersect(at("run_b"))


def u4_absent_partners(spark: SparkSession, d: str) -> DataFrame:
    """Clusters named in pairs that no aligned tag belongs to."""
    pairs, tags = table(spark, d, "merged_pairs"), table(spark, d, "phas_to_detect")
    bare = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    named = pairs.select(F.explode(F.array(bare("cluster_a"), bare("cluster_b"))).alias("cluster_id")).where("cluster_id is not null and cluster_id <> 'singleLibOccurrence'")
    return named.distinct().join(tags.select(F.col("clusterID").alias("cluster_id")).distinct(), "cluster_id", "left_anti")


QUERIES = {
    f.__name__: f
    for f in (
        j2_locus_groups, a23_group_members, j2_locus_pairs, j8_run_overlaps, a20_overlap_shapes, j9_unmatched, u6_combined_loci,
        a21_combined_summary, k8_source_map, k8_combined_rows, k8_summary, k8_canonical_rows, s14_text_calls, a20_overlap_audit, j10_matches, a19_match_metrics, u5_shared_contigs, u4_absent_partners,
    )
}

_L10 = f"""{READS}, loci AS (SELECT clusterID, chromosome, min(pos) AS s, max(pos) AS e FROM reads WHERE clusterID IS NOT NULL GROUP BY 1, 2 HAVING max(pos) - min(pos) >= 350)"""
_GROUPS = f"""WITH {_L10}, b AS (SELECT *, max(e) OVER (PARTITION BY chromosome ORDER BY s, e, clusterID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM loci),
i AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe + 300 THEN 1 ELSE 0 END) OVER (PARTITION BY chromosome ORDER BY s, e, clusterID) AS g FROM b),
x AS (SELECT clusterID, chromosome || ':' || min(s) OVER (PARTITION BY chromosome, g) || '..' || max(e) OVER (PARTITION BY chromosome, g) AS identifier FROM i)"""
_AB = """l AS (SELECT DISTINCT comparison_id, run, clean_id AS chromosome, identifier, least("start", "end") AS s, greatest("start", "end") AS e
  FROM locus JOIN contigs ON chromosome = old_id WHERE "start" IS NOT NULL AND "end" IS NOT NULL AND identifier IS NOT NULL AND comparison_id IS NOT NULL),
pairs AS (SELECT a.comparison_id, a.chromosome, a.identifier AS id_a, b.identifier AS id_b, a.s AS start_a, a.e AS end_a, b.s AS start_b, b.e AS end_b, least(a.e, b.e) - greatest(a.s, b.s) + 1 AS overlap_nt
  FROM l a JOIN l b ON a.comparison_id = b.comparison_id AND a.chromosome = b.chromosome AND a.s <= b.e AND b.s <= a.e WHERE a.run = 'run_a' AND b.run = 'run_b')"""
_COMBINED = f"""WITH {_AB}, u AS (SELECT comparison_id, chromosome, identifier, s AS "start", e AS "end", 'preferred' AS origin FROM l WHERE run = 'run_a'
UNION ALL SELECT comparison_id, chromosome, identifier, s, e, 'other_only' FROM l WHERE run = 'run_b' AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.comparison_id = l.comparison_id AND p.id_b = l.identifier))"""
_MATCH = f"""WITH {_AB}, c AS (SELECT DISTINCT comparison_id, chromosome, identifier, s, e, greatest(s - 250, 0) AS qs, e + 250 AS qe FROM l WHERE run = 'run_a'),
r AS (SELECT DISTINCT comparison_id, chromosome, identifier, s, e FROM l WHERE run = 'run_b'),
t AS (SELECT c.comparison_id, c.chromosome, 'TP' AS status, c.identifier AS id_a, r.identifier AS id_b, r.s AS start_b, r.e AS end_b FROM c JOIN r
  ON c.comparison_id = r.comparison_id AND c.chromosome = r.chromosome AND c.qs <= r.e AND r.s <= c.qe),
m AS (SELECT * FROM t UNION ALL
SELECT comparison_id, chromosome, 'FP', identifier, NULL, NULL, NULL FROM c WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.comparison_id = c.comparison_id AND t.chromosome = c.chromosome AND t.id_a = c.identifier) UNION ALL
SELECT comparison_id, chromosome, 'FN', NULL, identifier, s, e FROM r WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.comparison_id = r.comparison_id AND t.chromosome = r.chromosome AND t.start_b = r.s AND t.end_b = r.e))"""

_SOURCES = lambda mine, theirs: f"""{_AB}, met AS (SELECT DISTINCT comparison_id, 'run_a' AS run, id_a AS identifier FROM pairs UNION SELECT DISTINCT comparison_id, 'run_b', id_b FROM pairs),
one AS (SELECT l.*, m.identifier IS NOT NULL AS hit FROM l LEFT JOIN met m ON m.comparison_id = l.comparison_id AND m.run = l.run AND m.identifier = l.identifier WHERE l.run IN ('run_a', 'run_b')),
src AS (SELECT comparison_id, chromosome, identifier AS combined_id, s AS combined_start, e AS combined_end, CASE WHEN hit THEN 'shared' ELSE run || '_only' END AS category, run AS source_run,
    identifier AS source_id, s AS source_start, e AS source_end, true AS is_representative, e - s + 1 AS overlap_nt FROM one WHERE run = 'run_{mine}' OR NOT hit
  UNION ALL SELECT comparison_id, chromosome, id_{mine}, start_{mine}, end_{mine}, 'shared', 'run_{theirs}', id_{theirs}, start_{theirs}, end_{theirs}, false, overlap_nt FROM pairs)"""  # noqa: E731

SQL = {
    "k8_source_map": f"WITH {_SOURCES('a', 'b')} SELECT * FROM src",
    "k8_combined_rows": f"""WITH {_SOURCES('b', 'a')} SELECT comparison_id, chromosome, combined_id, combined_start, combined_end, category, max(source_run) FILTER (WHERE is_representative) AS representative_run,
  count(*) FILTER (WHERE source_run = 'run_a') AS run_a_loci, count(*) FILTER (WHERE source_run = 'run_b') AS run_b_loci FROM src GROUP BY ALL""",
    "k8_summary": f"""WITH {_SOURCES('a', 'b')}, k AS (SELECT comparison_id, count(*) AS n, count(*) FILTER (WHERE category = 'shared') AS sh, count(*) FILTER (WHERE category = 'run_a_only') AS oa, count(*) FILTER (WHERE category = 'run_b_only') AS ob
  FROM src WHERE is_representative GROUP BY 1), c AS (SELECT comparison_id, count(*) FILTER (WHERE run = 'run_a') AS a, count(*) FILTER (WHERE run = 'run_b') AS b FROM l GROUP BY 1), q AS (SELECT comparison_id, count(*) AS p FROM pairs GROUP BY 1)
SELECT comparison_id, a AS input_loci_a, b AS input_loci_b, coalesce(p, 0) AS overlap_pairs, sh AS shared_loci, oa AS run_a_only_loci, ob AS run_b_only_loci, n AS combined_loci, a + b - n AS collapsed_source_loci
FROM k JOIN c USING (comparison_id) LEFT JOIN q USING (comparison_id)""",
    "k8_canonical_rows": f"""WITH {_SOURCES('a', 'b')} SELECT comparison_id, run AS source_run, identifier, count(*) AS rows FROM locus
WHERE EXISTS (SELECT 1 FROM src WHERE is_representative AND src.comparison_id = locus.comparison_id AND source_run = run AND source_id = locus.identifier) GROUP BY 1, 2, 3""",
    "s14_text_calls": """SELECT DISTINCT coalesce(identifier, '') AS identifier, coalesce(run, '') AS alib, coalesce(chromosome, '') AS chromosome, "start" - 1 AS "start", "end" FROM locus WHERE "start" IS NOT NULL AND "end" IS NOT NULL""",
    "j2_locus_groups": f"{_GROUPS} SELECT * FROM x",
    "a23_group_members": f"{_GROUPS} SELECT identifier, count(DISTINCT clusterID) AS members, min(clusterID) AS first_member, max(clusterID) AS last_member FROM x GROUP BY 1",
    "j2_locus_pairs": f"""WITH {_L10} SELECT a.chromosome, a.clusterID AS cluster_a, b.clusterID AS cluster_b, greatest(0, least(a.e, b.e) - greatest(a.s, b.s) + 1) AS overlap_nt
FROM loci a JOIN loci b ON a.chromosome = b.chromosome AND a.clusterID < b.clusterID AND a.s <= b.e + 300 AND b.s <= a.e + 300""",
    "j8_run_overlaps": f"WITH {_AB} SELECT * FROM pairs",
    "a20_overlap_shapes": f"""WITH {_AB}, x AS (SELECT *, count(*) OVER (PARTITION BY comparison_id, id_a) AS ma, count(*) OVER (PARTITION BY comparison_id, id_b) AS mb FROM pairs)
SELECT comparison_id, CASE WHEN ma > 1 AND mb > 1 THEN 'many_to_many' WHEN ma > 1 THEN 'run_a_one_to_many_run_b' WHEN mb > 1 THEN 'run_a_many_to_one_run_b' ELSE 'one_to_one' END AS shape,
  count(*) AS pairs, CAST(sum(overlap_nt) AS BIGINT) AS overlap_nt, max(ma) AS most_a, max(mb) AS most_b FROM x GROUP BY 1, 2""",
    "j9_unmatched": f"""WITH {_AB} SELECT comparison_id, chromosome, identifier, s AS "start", e AS "end" FROM l WHERE run = 'run_b'
AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.comparison_id = l.comparison_id AND p.id_b = l.identifier)""",
    "u6_combined_loci": f"{_COMBINED} SELECT * FROM u",
    "a21_combined_summary": f'{_COMBINED} SELECT comparison_id, origin, count(*) AS loci, CAST(sum("end" - "start" + 1) AS BIGINT) AS covered FROM u GROUP BY 1, 2',
    "a20_overlap_audit": f"""WITH {_AB}, o AS (SELECT comparison_id, run_a_identifier AS id_a, run_b_identifier AS id_b, count(*) AS n, max(overlap_nt) AS nt FROM overlap GROUP BY 1, 2, 3),
q AS (SELECT comparison_id, id_a, id_b, max(overlap_nt) AS r FROM pairs GROUP BY 1, 2, 3),
f AS (SELECT coalesce(o.comparison_id, q.comparison_id) AS comparison_id, n, nt, r FROM o FULL JOIN q ON o.comparison_id = q.comparison_id AND o.id_a = q.id_a AND o.id_b = q.id_b)
SELECT comparison_id, count(n) AS stored, count(r) AS computed, count(*) FILTER (WHERE n > 1) AS repeated, count(*) FILTER (WHERE n IS NOT NULL AND nt IS NULL) AS without_length,
  count(*) FILTER (WHERE nt <> r) AS wrong_length, count(*) FILTER (WHERE n IS NULL) AS missing, count(*) FILTER (WHERE r IS NULL) AS without_loci FROM f GROUP BY 1""",
    "j10_matches": f"{_MATCH} SELECT * FROM m",
    "a19_match_metrics": f"""{_MATCH}, x AS (SELECT comparison_id, count(DISTINCT CASE WHEN status = 'TP' THEN id_a END) AS tp_ids, count(DISTINCT id_a) AS ids,
  count(DISTINCT CASE WHEN status = 'TP' THEN chromosome || ':' || start_b || '-' || end_b END) AS tp_ref, count(DISTINCT CASE WHEN status = 'FN' THEN chromosome || ':' || start_b || '-' || end_b END) AS fn_ref FROM m GROUP BY 1),
y AS (SELECT *, ids - tp_ids AS fp_ids FROM x),
z AS (SELECT comparison_id, tp_ids, tp_ref, fn_ref, fp_ids, coalesce(tp_ids / nullif(CAST(tp_ids + fp_ids AS DOUBLE), 0), 0) AS precision_id, coalesce(tp_ids / nullif(CAST(tp_ids + fn_ref AS DOUBLE), 0), 0) AS recall_id,
  coalesce(tp_ref / nullif(CAST(tp_ref + fp_ids AS DOUBLE), 0), 0) AS precision_ref, coalesce(tp_ref / nullif(CAST(tp_ref + fn_ref AS DOUBLE), 0), 0) AS recall_ref FROM y)
SELECT *, coalesce(2 * precision_id * recall_id / nullif(precision_id + recall_id, 0), 0) AS f1_id, coalesce(2 * precision_ref * recall_ref / nullif(precision_ref + recall_ref, 0), 0) AS f1_ref FROM z""",
    "u5_shared_contigs": f"WITH {_AB} SELECT comparison_id, chromosome FROM l WHERE run = 'run_a' INTERSECT SELECT comparison_id, chromosome FROM l WHERE run = 'run_b'",
    "u4_absent_partners": """WITH n AS (SELECT regexp_replace(cluster_a, '^\\s+|\\s+$', '', 'g') AS cluster_id FROM merged_pairs UNION SELECT regexp_replace(cluster_b, '^\\s+|\\s+$', '', 'g') FROM merged_pairs)
SELECT cluster_id FROM n WHERE cluster_id IS NOT NULL AND cluster_id <> 'singleLibOccurrence' EXCEPT SELECT clusterID FROM phas_to_detect""",
}
