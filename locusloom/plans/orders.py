"""Queries on order: dense numbers, ranks, representatives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.functions.loci import locus_parts, natural_key, register_relation
from locusloom.operators.numbering import dense_numbers
from locusloom.plans.common import PHASE, READS, reads
from locusloom.plans.loci import u6_combined_loci
from locusloom.session import table

TOP = 20


def w11_tag_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Number of each molecule in its library, the most abundant first."""
    tags = reads(spark, d).where("tag_seq is not null").groupBy("alib", "tag_seq").agg(F.coalesce(F.sum("abun"), F.lit(0)).alias("abun"))
    return dense_numbers(tags, ["alib"], [F.col("abun").desc(), F.col("tag_seq").asc()])


def t3_identifier_parts(spark: SparkSession, d: str) -> DataFrame:
    """Distinct identifiers of the features with what they sort by: natural contig, start, end."""
    ids = table(spark, d, "features").where("identifier is not null").select("identifier").distinct()
    contig, start, end = locus_parts(F.col("identifier"))
    return ids.select("identifier", natural_key(contig).alias("contig_key"), start.alias("start"), end.alias("end"))


def t5_top_features(spark: SparkSession, d: str) -> DataFrame:
    """The report of the highest peaks over all libraries."""
    rows = table(spark, d, "features").where("cID is not null and Peak_Howell_score is not null and not isnan(Peak_Howell_score)").select("cID", "alib", "Peak_Howell_score").distinct()
    return rows.orderBy(F.desc("Peak_Howell_score"), "cID", "alib").limit(TOP)


def f14_register_relations(spark: SparkSession, d: str) -> DataFrame:
    """Tags of each cluster by their register against the cluster's first position."""
    rows = reads(spark, d).where("clusterID is not null")
    first = rows.groupBy("clusterID").agg(F.min("pos").alias("first"))
    at = rows.groupBy("clusterID", "pos").agg(F.count(F.lit(1)).alias("n")).join(first, "clusterID")
    return at.groupBy("clusterID", register_relation(F.col("pos"), F.col("first"), PHASE).alias("relation")).agg(F.sum("n").alias("tags"), F.count(F.lit(1)).alias("positions"))


def f15_representatives(spark: SparkSession, d: str) -> DataFrame:
    """Combined loci of each comparison in the order of contig and place, by their number in it."""
    rows = u6_combined_loci(spark, d).groupBy("comparison_id", "chromosome", "identifier", "start", "end").agg(F.min("origin").alias("origin"))
    order = [natural_key(F.col("chromosome")).asc(), F.col("start").asc(), F.col("end").asc(), F.col("identifier").asc()]
    return dense_numbers(rows, ["comparison_id"], order, "place").select("comparison_id", "identifier", "chromosome", "start", "end", "place")


def u1_all_intervals(spark: SparkSession, d: str) -> DataFrame:
    """Loci and stored overlaps of each comparison and contig in one table, counted by kind."""
    loci = table(spark, d, "locus").select("comparison_id", "chromosome", F.col("run").alias("kind"), (F.abs(F.col("end") - F.col("start")) + 1).alias("nt"))
    overlaps = table(spark, d, "overlap").select("comparison_id", "chromosome", F.lit("overlap").alias("kind"), F.col("overlap_nt").alias("nt"))
    contigs = table(spark, d, "contigs").select("old_id", "clean_id")
    both = loci.unionByName(overlaps).join(contigs, F.col("chromosome") == F.col("old_id"))
    return both.groupBy("comparison_id", F.col("clean_id").alias("chromosome"), "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("nt").alias("nt"))


QUERIES = {f.__name__: f for f in (w11_tag_numbers, t3_identifier_parts, t5_top_features, f14_register_relations, f15_representatives, u1_all_intervals)}

_COMBINED = """l AS (SELECT DISTINCT comparison_id, run, clean_id AS chromosome, identifier, least("start", "end") AS s, greatest("start", "end") AS e
  FROM locus JOIN contigs ON chromosome = old_id WHERE "start" IS NOT NULL AND "end" IS NOT NULL AND identifier IS NOT NULL AND comparison_id IS NOT NULL),
m AS (SELECT DISTINCT b.comparison_id, b.identifier FROM l a JOIN l b ON a.comparison_id = b.comparison_id AND a.chromosome = b.chromosome AND a.s <= b.e AND b.s <= a.e WHERE a.run = 'run_a' AND b.run = 'run_b'),
u AS (SELECT comparison_id, chromosome, identifier, s, e FROM l WHERE run = 'run_a' UNION
  SELECT comparison_id, chromosome, identifier, s, e FROM l WHERE run = 'run_b' AND NOT EXISTS (SELECT 1 FROM m WHERE m.comparison_id = l.comparison_id AND m.identifier = l.identifier))"""
_PAD = "lower(regexp_replace({0}, '[0-9]+$', '')) || CASE WHEN regexp_extract({0}, '([0-9]+)$', 1) = '' THEN '' ELSE lpad(regexp_extract({0}, '([0-9]+)$', 1), 20, '0') END"

SQL = {
    "w11_tag_numbers": f"""WITH {READS}, t AS (SELECT alib, tag_seq, CAST(coalesce(sum(abun), 0) AS BIGINT) AS abun FROM reads WHERE tag_seq IS NOT NULL GROUP BY 1, 2)
SELECT alib, tag_seq, abun, row_number() OVER (PARTITION BY alib ORDER BY abun DESC, tag_seq) AS number FROM t""",
    "t3_identifier_parts": f"""WITH i AS (SELECT DISTINCT identifier, split_part(identifier, ':', 1) AS c FROM features WHERE identifier IS NOT NULL)
SELECT identifier, {_PAD.format('c')} AS contig_key, CAST(split_part(split_part(identifier, ':', 2), '..', 1) AS BIGINT) AS "start", CAST(split_part(identifier, '..', 2) AS BIGINT) AS "end" FROM i""",
    "t5_top_features": """SELECT DISTINCT cID, alib, Peak_Howell_score FROM features WHERE cID IS NOT NULL AND Peak_Howell_score IS NOT NULL AND NOT isnan(Peak_Howell_score)
ORDER BY Peak_Howell_score DESC, cID, alib LIMIT 20""",
    "f14_register_relations": f"""WITH {READS}, p AS (SELECT clusterID, pos, count(*) AS n, min(pos) OVER (PARTITION BY clusterID) AS first_ FROM reads WHERE clusterID IS NOT NULL GROUP BY clusterID, pos)
SELECT clusterID, CASE (pos - first_) % 21 WHEN 0 THEN 'exact' WHEN 1 THEN 'offset' WHEN 20 THEN 'offset' ELSE 'other' END AS relation, CAST(sum(n) AS BIGINT) AS tags, count(*) AS positions FROM p GROUP BY 1, 2""",
    "f15_representatives": f"""WITH {_COMBINED} SELECT comparison_id, identifier, chromosome, s AS "start", e AS "end",
row_number() OVER (PARTITION BY comparison_id ORDER BY {_PAD.format('chromosome')}, s, e, identifier) AS place FROM u""",
    "u1_all_intervals": """WITH u AS (SELECT comparison_id, chromosome, run AS kind, abs("end" - "start") + 1 AS nt FROM locus UNION ALL SELECT comparison_id, chromosome, 'overlap', overlap_nt FROM overlap)
SELECT comparison_id, clean_id AS chromosome, kind, count(*) AS n, CAST(sum(nt) AS BIGINT) AS nt FROM u JOIN contigs ON chromosome = old_id GROUP BY 1, 2, 3""",
}
