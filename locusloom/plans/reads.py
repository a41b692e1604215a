"""Queries over aligned reads: counts, gap clusters, cluster filters, loci."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.functions.loci import cluster_parts, locus_id, locus_parts, natural_key, per_ten_million
from locusloom.functions.sequences import chop_at_n, read_verdict
from locusloom.operators import clusters as C
from locusloom.plans.common import BUFFER, LOCUS_LENGTH, PHASE, READS, reads
from locusloom.session import table

MIN_DEPTH = 2
_KEYS = ["alib", "chromosome"]


def a1_tag_counts(spark: SparkSession, d: str) -> DataFrame:
    """Copies of each molecule in each library, of at least the least depth."""
    return reads(spark, d).where("tag_seq is not null").groupBy("alib", "tag_seq").agg(F.count(F.lit(1)).alias("abun")).where(F.col("abun") >= MIN_DEPTH)


def a3_pooled_tags(spark: SparkSession, d: str) -> DataFrame:
    """Molecules of all libraries together, filtered on the pooled depth."""
    tags = reads(spark, d).where("tag_seq is not null").groupBy("tag_seq").agg(F.sum("abun").alias("abun"), F.count_distinct("alib").alias("n_libs"))
    return tags.where(F.col("abun") >= MIN_DEPTH)


def a4_position_counts(spark: SparkSession, d: str) -> DataFrame:
    return reads(spark, d).groupBy(*_KEYS, "pos").agg(F.count(F.lit(1)).alias("n_reads"))


def a5_normalised_abundance(spark: SparkSession, d: str) -> DataFrame:
    """Abundance per ten million of the library's total, at least 1, by library and position."""
    rows = reads(spark, d).where("abun is not null")
    total = C.library_totals(rows)
    at = rows.groupBy("alib", "chromosome", "pos").agg(F.sum("abun").alias("abun"))
    return at.join(total, "alib").select("alib", "chromosome", "pos", per_ten_million(F.col("abun"), F.col("total_abun")).alias("cp10m"))


def a6_strand_positions(spark: SparkSession, d: str) -> DataFrame:
    rows = reads(spark, d).where("clusterID is not null and strand is not null")
    return C.position_counts(rows, ["clusterID", "strand"], PHASE)


def a7_length_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Tags and abundance by length of each cluster, and its dominant length (most tags, then abundance, then short)."""
    by_len = reads(spark, d).where("clusterID is not null").groupBy("clusterID", "len").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("abun", F.lit(0))).alias("a"))
    return by_len.groupBy("clusterID").agg(
        F.count(F.lit(1)).alias("lengths"), F.sum("n").alias("tags"), F.percentile("n", 0.5).alias("median_tags"),
        F.max_by("len", F.struct("n", "a", -F.col("len"))).alias("dominant"),
    )


def w1_gap_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Gap clusters of the positions of each library and contig."""
    at = reads(spark, d).groupBy(*_KEYS, "pos").agg(F.count(F.lit(1)).alias("n_reads"))
    return C.cluster_spans(C.gap_clusters(at, _KEYS, C.cluster_gap(PHASE, BUFFER)), _KEYS)


def f6_long_clusters(spark: SparkSession, d: str) -> DataFrame:
    return C.long_enough(w1_gap_clusters(spark, d), PHASE)


def f7_cluster_quality(spark: SparkSession, d: str) -> DataFrame:
    rows = reads(spark, d).where("clusterID is not null")
    return C.cluster_quality(rows, "clusterID", PHASE).select("clusterID", "tags", "abun", "unique_tags", "phase_tags", "phase_abun", "count_cut", "passes")


def a10_cluster_loci(spark: SparkSession, d: str) -> DataFrame:
    """Loci of the clusters that are long enough."""
    loci = C.cluster_loci(reads(spark, d).where("clusterID is not null"), "clusterID", LOCUS_LENGTH)
    return loci.withColumn("identifier", locus_id(F.col("chromosome"), F.col("start"), F.col("end")))


def f1_clean_reads(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned reads that stay, with their copies, over all tag sequences as they are."""
    tags = table(spark, d, "phas_to_detect").select("tag_seq")
    kept = tags.where(read_verdict(F.col("tag_seq")) == "retained").select(chop_at_n(F.col("tag_seq")).alias("seq"))
    return kept.groupBy("seq").agg(F.count(F.lit(1)).alias("n"))


def f3_read_accounting(spark: SparkSession, d: str) -> DataFrame:
    """By library: reads examined, retained, rejected for either reason, cut at N, and distinct reads."""
    tags = table(spark, d, "phas_to_detect").where("tag_seq is not null").select("alib", "tag_seq", read_verdict(F.col("tag_seq")).alias("v"), chop_at_n(F.col("tag_seq")).alias("s"))
    return tags.groupBy("alib").agg(
        F.count(F.lit(1)).alias("examined"),
        *(F.count_if(F.col("v") == v).alias(v) for v in ("retained", "rejected_length", "rejected_ambiguous")),
        F.count_if(F.length("s") < F.length(F.trim("tag_seq"))).alias("chopped"),
        F.count_distinct(F.when(F.col("v") == "retained", F.col("s"))).alias("unique_tags"),
    )


def s6_read_lengths(spark: SparkSession, d: str) -> DataFrame:
    """By library: share of reads longer than small RNAs are, and the verdict of the preflight."""
    tags = table(spark, d, "phas_to_detect").where("tag_seq is not null")
    long = F.avg((F.length(F.trim("tag_seq")) > 35).cast("double"))
    return tags.groupBy("alib").agg(long.alias("long_share"), (long >= 0.8).alias("looks_raw"))


def c4_cluster_names(spark: SparkSession, d: str) -> DataFrame:
    """Library, contig and number inside each cluster id, and its rows."""
    rows = table(spark, d, "phas_to_detect").where("clusterID is not null").groupBy("clusterID").agg(F.count(F.lit(1)).alias("n"))
    lib, contig, number = cluster_parts(F.col("clusterID"))
    return rows.select("clusterID", lib.alias("lib"), contig.alias("contig"), number.alias("number"), "n")


def c5_identifier_parts(spark: SparkSession, d: str) -> DataFrame:
    """Contig, start and end inside each identifier, with its rows and spread."""
    rows = table(spark, d, "phas_to_detect").groupBy("identifier").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    contig, start, end = locus_parts(F.col("identifier"))
    return rows.select("identifier", contig.alias("contig"), start.alias("start"), end.alias("end"), "n", ((F.col("lo") >= start) & (F.col("hi") <= end)).alias("inside"))


def c6_strands(spark: SparkSession, d: str) -> DataFrame:
    """Rows, abundance and share of the Watson strand of each cluster."""
    rows = reads(spark, d).where("clusterID is not null")
    return rows.groupBy("clusterID").agg(
        F.count_if(F.col("strand") == "w").alias("n_w"), F.count_if(F.col("strand") == "c").alias("n_c"),
        F.coalesce(F.avg(F.when(F.col("strand").isNotNull(), (F.col("strand") == "w").cast("double"))), F.lit(1.0)).alias("strand_bias"),
    )


def t2_natural_order(spark: SparkSession, d: str) -> DataFrame:
    """Contigs by rows, with their place in natural order."""
    from pyspark.sql import Window

    rows = reads(spark, d).groupBy("chromosome").agg(F.count(F.lit(1)).alias("n"))  # one row per contig
    return rows.withColumn("place", F.row_number().over(Window.orderBy(natural_key(F.col("chromosome")), "chromosome")))


QUERIES = {
    f.__name__: f
    for f in (
        w1_gap_clusters, a1_tag_counts, a3_pooled_tags, a4_position_counts, a5_normalised_abundance, a6_strand_positions,
        a7_length_histogram, f6_long_clusters, f7_cluster_quality, a10_cluster_loci, f1_clean_reads, f3_read_accounting,
        s6_read_lengths, c4_cluster_names, c5_identifier_parts, c6_strands, t2_natural_order,
    )
}

_CLUSTERS = f"""WITH {READS},
spots AS (SELECT alib, chromosome, pos, count(*) AS n_reads FROM reads GROUP BY ALL),
g AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY alib, chromosome ORDER BY pos) <= 300 THEN 0 ELSE 1 END AS new FROM spots),
k AS (SELECT *, sum(new) OVER (PARTITION BY alib, chromosome ORDER BY pos) AS cluster_no FROM g),
spans AS (SELECT alib, chromosome, CAST(cluster_no AS BIGINT) AS cluster_no, min(pos) AS "start", max(pos) AS "end", count(*) AS n_pos, CAST(sum(n_reads) AS BIGINT) AS n_reads
          FROM k GROUP BY ALL)"""
_CHOP = """CASE WHEN instr(upper(trim(tag_seq)), 'N') > 0 AND instr(upper(trim(tag_seq)), 'N') <= length(trim(tag_seq)) // 2
  THEN substring(upper(trim(tag_seq)), 1, instr(upper(trim(tag_seq)), 'N') - 1) ELSE upper(trim(tag_seq)) END"""
_VERDICT = "CASE WHEN NOT regexp_full_match(s, '[ACGT]*') THEN 'rejected_ambiguous' WHEN length(s) NOT BETWEEN 18 AND 35 THEN 'rejected_length' ELSE 'retained' END"
_CHOPPED = f"t AS (SELECT alib, tag_seq, {_CHOP} AS s FROM phas_to_detect WHERE tag_seq IS NOT NULL), v AS (SELECT *, {_VERDICT} AS v FROM t)"

SQL = {
    "a1_tag_counts": f"WITH {READS} SELECT alib, tag_seq, count(*) AS abun FROM reads WHERE tag_seq IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2",
    "a3_pooled_tags": f"WITH {READS} SELECT tag_seq, CAST(sum(abun) AS BIGINT) AS abun, count(DISTINCT alib) AS n_libs FROM reads WHERE tag_seq IS NOT NULL GROUP BY 1 HAVING sum(abun) >= 2",
    "a4_position_counts": f"WITH {READS} SELECT alib, chromosome, pos, count(*) AS n_reads FROM reads GROUP BY 1, 2, 3",
    "a5_normalised_abundance": f"""WITH {READS}, t AS (SELECT alib, sum(abun) AS total FROM reads GROUP BY 1),
a AS (SELECT alib, chromosome, pos, sum(abun) AS abun FROM reads WHERE abun IS NOT NULL GROUP BY 1, 2, 3)
SELECT alib, chromosome, pos, CAST(greatest(round_even(CAST(abun AS DOUBLE) / CAST(total AS DOUBLE) * 1e7, 0), 1) AS BIGINT) AS cp10m FROM a JOIN t USING (alib)""",
    "a6_strand_positions": f"""WITH {READS} SELECT clusterID, strand, pos, count(*) AS n_reads, CAST(sum(abun) AS BIGINT) AS abun, CAST(sum(abun) FILTER (WHERE len = 21) AS BIGINT) AS abun_phase
FROM reads WHERE clusterID IS NOT NULL AND strand IS NOT NULL GROUP BY 1, 2, 3""",
    "a7_length_histogram": f"""WITH {READS}, h AS (SELECT clusterID, len, count(*) AS n, sum(coalesce(abun, 0)) AS a FROM reads WHERE clusterID IS NOT NULL GROUP BY 1, 2)
SELECT clusterID, count(*) AS lengths, CAST(sum(n) AS BIGINT) AS tags, CAST(median(n) AS DOUBLE) AS median_tags, first(len ORDER BY n DESC, a DESC, len) AS dominant FROM h GROUP BY 1""",
    "w1_gap_clusters": f"{_CLUSTERS} SELECT * FROM spans",
    "f6_long_clusters": f'{_CLUSTERS} SELECT * FROM spans WHERE "end" - "start" + 1 > 88',
    "f7_cluster_quality": f"""WITH {READS}, h AS (SELECT clusterID, len, count(*) AS n, sum(coalesce(abun, 0)) AS a, count(*) FILTER (WHERE hits <= 2) AS u FROM reads WHERE clusterID IS NOT NULL GROUP BY 1, 2),
c AS (SELECT clusterID, CAST(sum(n) AS BIGINT) AS tags, CAST(sum(a) AS BIGINT) AS abun, CAST(sum(u) AS BIGINT) AS unique_tags,
  CAST(coalesce(sum(n) FILTER (WHERE len = 21), 0) AS BIGINT) AS phase_tags, CAST(coalesce(sum(a) FILTER (WHERE len = 21), 0) AS BIGINT) AS phase_abun,
  CASE WHEN count(*) <= 4 THEN floor(0.25 * sum(a)) ELSE median(n) END AS count_cut FROM h GROUP BY 1)
SELECT clusterID, tags, abun, unique_tags, phase_tags, phase_abun, CAST(count_cut AS DOUBLE) AS count_cut,
  coalesce(tags >= 10 AND abun > 0 AND phase_tags > count_cut AND round(CAST(unique_tags AS DOUBLE) / tags, 5) >= 0.2
    AND round(CAST(phase_abun AS DOUBLE) / nullif(abun, 0), 5) >= 0.5, false) AS passes FROM c""",
    "a10_cluster_loci": f"""WITH {READS} SELECT clusterID, chromosome, min(pos) AS "start", max(pos) AS "end", chromosome || ':' || min(pos) || '..' || max(pos) AS identifier
FROM reads WHERE clusterID IS NOT NULL GROUP BY 1, 2 HAVING max(pos) - min(pos) >= 350""",
    "f1_clean_reads": f"WITH {_CHOPPED} SELECT s AS seq, count(*) AS n FROM v WHERE v = 'retained' GROUP BY 1",
    "f3_read_accounting": f"""WITH {_CHOPPED} SELECT alib, count(*) AS examined, count(*) FILTER (WHERE v = 'retained') AS retained, count(*) FILTER (WHERE v = 'rejected_length') AS rejected_length,
count(*) FILTER (WHERE v = 'rejected_ambiguous') AS rejected_ambiguous, count(*) FILTER (WHERE length(s) < length(trim(tag_seq))) AS chopped, count(DISTINCT s) FILTER (WHERE v = 'retained') AS unique_tags FROM v GROUP BY 1""",
    "s6_read_lengths": "SELECT alib, avg(CAST(length(trim(tag_seq)) > 35 AS INT)) AS long_share, avg(CAST(length(trim(tag_seq)) > 35 AS INT)) >= 0.8 AS looks_raw FROM phas_to_detect WHERE tag_seq IS NOT NULL GROUP BY 1",
    "c4_cluster_names": """WITH c AS (SELECT clusterID, count(*) AS n, string_split(clusterID, '_') AS p FROM phas_to_detect WHERE clusterID IS NOT NULL GROUP BY 1),
x AS (SELECT clusterID, n, regexp_extract(clusterID, '^.+_([0-9]+)_.+$', 1) AS num, CASE WHEN regexp_matches(clusterID, '-scaf_[0-9]+_[0-9]+_scaf_') THEN regexp_extract(clusterID, '_(scaf_[0-9]+)$', 1) ELSE regexp_extract(clusterID, '_([^_]+)$', 1) END AS contig FROM c)
SELECT clusterID, left(clusterID, length(clusterID) - 2 * length(contig) - length(num) - 3) AS lib, contig, CAST(regexp_extract(clusterID, '_([0-9]+)_' || contig || '$', 1) AS BIGINT) AS number, n
FROM (SELECT clusterID, n, contig, regexp_extract(clusterID, '_([0-9]+)_' || contig || '$', 1) AS num FROM x)""",
    "c5_identifier_parts": """WITH r AS (SELECT identifier, count(*) AS n, min(pos) AS lo, max(pos) AS hi FROM phas_to_detect GROUP BY 1),
p AS (SELECT *, regexp_extract(identifier, '^(.+):([0-9]+)[.][.]([0-9]+)$', 1) AS contig, TRY_CAST(regexp_extract(identifier, '^(.+):([0-9]+)[.][.]([0-9]+)$', 2) AS BIGINT) AS s,
  TRY_CAST(regexp_extract(identifier, '^(.+):([0-9]+)[.][.]([0-9]+)$', 3) AS BIGINT) AS e FROM r)
SELECT identifier, contig, s AS "start", e AS "end", n, lo >= s AND hi <= e AS inside FROM p""",
    "c6_strands": f"""WITH {READS} SELECT clusterID, count(*) FILTER (WHERE strand = 'w') AS n_w, count(*) FILTER (WHERE strand = 'c') AS n_c,
coalesce(avg(CASE strand WHEN 'w' THEN 1.0 WHEN 'c' THEN 0.0 END), 1.0) AS strand_bias FROM reads WHERE clusterID IS NOT NULL GROUP BY 1""",
    "t2_natural_order": f"""WITH {READS}, c AS (SELECT chromosome, count(*) AS n FROM reads GROUP BY 1)
SELECT chromosome, n, CAST(row_number() OVER (ORDER BY lower(regexp_replace(chromosome, '[0-9]+$', '')), CAST(nullif(regexp_extract(chromosome, '([0-9]+)$', 1), '') AS BIGINT), chromosome) AS INT) AS place FROM c""",
}
