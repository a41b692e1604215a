"""Queries that write the tables in the formats of the sources and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.operators.contigs import numbered_contigs
from locusloom.plans.common import READS, reads
from locusloom.session import table
from locusloom.sources import alignments as AL
from locusloom.sources import reads as RD
from locusloom.sources import sinks as SK

MAX_HITS = 5


def _tags(spark: SparkSession, d: str) -> DataFrame:
    return reads(spark, d).where("tag_seq is not null and abun is not null").groupBy("tag_seq").agg(F.sum("abun").alias("abun"))


def s1_tag_counts(spark: SparkSession, d: str) -> DataFrame:
    """Tag-count lines of all molecules, read back from a depth of 10."""
    return RD.parse_tag_counts(SK.tag_counts(_tags(spark, d)), 10)


def s2_fasta_reads(spark: SparkSession, d: str) -> DataFrame:
    """Reads of a FASTA of all tags as they are spelled, counted."""
    tags = table(spark, d, "phas_to_detect").where("tag_seq is not null")
    lines = tags.select(F.explode(F.array(F.concat(F.lit(">"), "tag_id"), F.col("tag_seq"))).alias("value"))
    return RD.parse_fasta_reads(lines, 2)


def s3_fastq_reads(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned reads of a FASTQ of all tags as they are spelled, one file per library."""
    tags = table(spark, d, "phas_to_detect").where("tag_seq is not null and tag_id is not null").select("alib", "tag_id", "tag_seq", F.monotonically_increasing_id().alias("record"))
    four = F.array(F.concat(F.lit("@"), "tag_id"), F.col("tag_seq"), F.lit("+"), F.regexp_replace("tag_seq", ".", "I"))
    records = tags.select(F.coalesce("alib", F.lit("")).alias("file"), "record", F.posexplode(four).alias("k", "value"))
    return RD.clean_fastq(RD.parse_fastq(records.select("file", (F.col("record") * 4 + F.col("k")).alias("line_no"), "value")))


def _fasta_records(tags: DataFrame) -> DataFrame:
    """FASTA records of the tags as they are spelled, in lines of 10."""
    lines = F.regexp_replace("tag_seq", "(.{10})", "$1\n")
    return tags.where("tag_seq is not null").select(F.concat_ws("\n", F.coalesce("tag_id", F.lit("none")), lines).alias("value"))


def f2_fasta_variant(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned reads of a FASTA of all tags as they are spelled, over several lines, in their own case."""
    return RD.parse_fasta_variant(_fasta_records(table(spark, d, "phas_to_detect")))


def k11_fastq_to_fasta(spark: SparkSession, d: str) -> DataFrame:
    """Reads of the FASTA made of a FASTQ of all tags, counted."""
    tags = table(spark, d, "phas_to_detect").where("tag_seq is not null and tag_id is not null").select("tag_id", "tag_seq", F.monotonically_increasing_id().alias("record"))
    four = F.array(F.concat(F.lit("@"), "tag_id"), F.col("tag_seq"), F.lit("+"), F.regexp_replace("tag_seq", ".", "I"))
    lines = tags.select("record", F.posexplode(four).alias("k", "value")).select((F.col("record") * 4 + F.col("k")).alias("line_no"), "value")
    return RD.parse_fasta_reads(SK.fastq_to_fasta(lines))


def k12_renamed_contigs(spark: SparkSession, d: str) -> DataFrame:
    """Records of the loci under the number of their contig in place of its name."""
    loci, contigs = table(spark, d, "locus").where("chromosome is not null"), table(spark, d, "contigs")
    numbers = contigs.select("old_id", "clean_id").join(m1_contig_numbers(spark, d), "clean_id").select("old_id", F.col("number").alias("new_id"))
    records = loci.select(F.concat(F.lit(" "), "chromosome", F.lit(" locus\n"), F.coalesce("identifier", F.lit(""))).alias("value"))
    back = SK.renamed_fasta(records, numbers)
    return back.groupBy(F.substring_index("value", "\n", 1).alias("header")).agg(F.count(F.lit(1)).alias("records"), F.count_distinct(F.substring_index("value", "\n", -1)).alias("bodies"))


def s4_counted_fasta(spark: SparkSession, d: str) -> DataFrame:
    lines = SK.counted_fasta(_tags(spark, d).withColumn("tag_id", F.concat(F.lit("seq_"), F.length("tag_seq").cast("string"))))
    return RD.parse_counted_fasta(lines.select(F.expr("substring(value, 2)").alias("value")))


def s7_reference(spark: SparkSession, d: str) -> DataFrame:
    """Contigs of a FASTA whose sequences are the bases of the documents, in lines of 60; the short ones are dropped."""
    docs = table(spark, d, "documents").where("text is not null")
    seq = F.regexp_replace(F.regexp_replace(F.upper("text"), "[^ACGT]", ""), "(.{60})", "$1\n")
    records = docs.select(F.concat_ws("\n", F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(" of "), F.coalesce("source", F.lit("none"))), seq).alias("value"))
    return RD.parse_reference(records).select("old_id", "len", F.md5("seq").alias("digest"))


def s9_sam_alignments(spark: SparkSession, d: str) -> DataFrame:
    """Alignment lines of the reads, read back, of tags with few hits, by position."""
    rows = reads(spark, d).where("tag_seq is not null and abun is not null and hits is not null and strand is not null and tag_id is not null")
    lines = SK.sam_lines(rows, F.concat("tag_id", F.lit("|"), F.col("abun").cast("string")), F.col("hits") % 2)
    kept = AL.usable_alignments(AL.parse_sam(lines), MAX_HITS, 0)
    return kept.groupBy("chromosome", "strand", "pos", "len").agg(F.count(F.lit(1)).alias("n"), F.sum("abun").alias("abun"), F.max("hits").alias("hits"))


def s9_sam_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Alignment lines of all reads, without mismatches, read back under the default limit of hits, by position."""
    rows = reads(spark, d).where("tag_seq is not null and abun is not null and hits is not null and strand is not null and tag_id is not null")
    lines = SK.sam_lines(rows, F.concat("tag_id", F.lit("|"), F.col("abun").cast("string")), F.lit(0))
    kept = AL.usable_alignments(AL.parse_sam(lines))
    return kept.groupBy("chromosome", "strand", "pos", "len").agg(F.count(F.lit(1)).alias("n"), F.sum("abun").alias("abun"), F.max("hits").alias("hits"))


def s10_cluster_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Candidate-cluster blocks of the reads, read back, by cluster."""
    rows = reads(spark, d).where("clusterID is not null")
    back = AL.parse_cluster_blocks(AL.cluster_block_lines(rows))
    return back.groupBy("clusterID").agg(F.count(F.lit(1)).alias("n"), F.sum("abun").alias("abun"), F.max("pos").alias("last"), F.round(F.sum(F.coalesce(F.nanvl("pval_corr_f", F.lit(None).cast("double")), F.lit(0.0))), 6).alias("p"))


def s13_annotation(spark: SparkSession, d: str) -> DataFrame:
    """GFF lines of the loci, read back as half-open intervals."""
    loci = table(spark, d, "locus").where("start is not null and end is not null and chromosome is not null and identifier is not null")
    lines = loci.select(F.concat_ws("\t", "chromosome", F.col("run"), F.lit("locus"), F.col("start").cast("string"), F.col("end").cast("string"), F.lit("."), F.lit("."), F.lit("."), F.concat(F.lit("Note=x;Name="), "identifier")).alias("value"))
    return AL.parse_annotation(lines, "gff").distinct()


def s17_id_map(spark: SparkSession, d: str) -> DataFrame:
    """Ragged lines of pairs with the contig of both, read back as one row per member."""
    bare = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    pairs = table(spark, d, "merged_pairs").where("cluster_a is not null").select(bare("cluster_a").alias("a"), bare("cluster_b").alias("b"))
    lines = pairs.select(F.concat_ws("\t", F.concat(F.lit("group of "), "a"), "a", "b").alias("value"))
    return AL.parse_id_map(lines).groupBy("identifier").agg(F.count_distinct("clusterID").alias("members"))


def k10_expanded_copies(spark: SparkSession, d: str) -> DataFrame:
    """Records of the FASTA that repeats each molecule as often as it was counted, by length."""
    lines = SK.expanded_fasta(_tags(spark, d))
    return lines.groupBy(F.length(F.substring_index("value", "\n", -1)).alias("len")).agg(F.count(F.lit(1)).alias("records"))


def m1_contig_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers of the contigs that have loci."""
    contigs = table(spark, d, "contigs").groupBy("clean_id").agg(F.min("ord").alias("ord"))
    used = table(spark, d, "locus").select(F.col("chromosome").alias("old_id")).distinct().join(table(spark, d, "contigs").select("old_id", "clean_id"), "old_id").select("clean_id").distinct()
    return numbered_contigs(contigs.join(used, "clean_id", "left_semi"), "clean_id", "ord").select("clean_id", "number")


QUERIES = {
    f.__name__: f
    for f in (s1_tag_counts, s2_fasta_reads, s3_fastq_reads, f2_fasta_variant, k11_fastq_to_fasta, k12_renamed_contigs, s4_counted_fasta, s7_reference, s9_sam_alignments, s9_sam_round_trip, s10_cluster_blocks, s13_annotation, s17_id_map, k10_expanded_copies, m1_contig_numbers)
}

_TAGS = f"{READS}, tags AS (SELECT tag_seq, CAST(sum(abun) AS BIGINT) AS abun FROM reads WHERE tag_seq IS NOT NULL AND abun IS NOT NULL GROUP BY 1)"

SQL = {
    "s1_tag_counts": f"WITH {_TAGS} SELECT * FROM tags WHERE abun >= 10",
    "s2_fasta_reads": "SELECT trim(tag_seq) AS tag_seq, count(*) AS abun FROM phas_to_detect WHERE trim(tag_seq) <> '' GROUP BY 1 HAVING count(*) >= 2",
    "s3_fastq_reads": """WITH t AS (SELECT upper(trim(tag_seq)) AS q FROM phas_to_detect WHERE tag_seq IS NOT NULL AND tag_id IS NOT NULL),
c AS (SELECT CASE WHEN instr(q, 'N') > 0 AND instr(q, 'N') <= length(q) // 2 THEN substring(q, 1, instr(q, 'N') - 1) ELSE q END AS s FROM t)
SELECT s AS tag_seq, count(*) AS abun FROM c WHERE regexp_full_match(s, '[ACGT]*') AND length(s) BETWEEN 18 AND 35 GROUP BY 1""",
    "f2_fasta_variant": """WITH t AS (SELECT regexp_replace(tag_seq, '^\\s+|\\s+$', '', 'g') AS q, tag_seq FROM phas_to_detect WHERE tag_seq IS NOT NULL),
c AS (SELECT CASE WHEN instr(q, 'N') > 0 AND instr(q, 'N') <= length(q) // 2 THEN substring(q, 1, instr(q, 'N') - 1) ELSE q END AS s FROM t)
SELECT s AS tag_seq, count(*) AS abun FROM c WHERE instr(s, 'N') = 0 AND length(s) BETWEEN 18 AND 35 GROUP BY 1""",
    "k11_fastq_to_fasta": "SELECT trim(tag_seq) AS tag_seq, count(*) AS abun FROM phas_to_detect WHERE tag_id IS NOT NULL AND trim(tag_seq) <> '' GROUP BY 1",
    "k12_renamed_contigs": """WITH u AS (SELECT DISTINCT clean_id FROM locus JOIN contigs ON chromosome = old_id), c AS (SELECT clean_id, min(ord) AS ord FROM contigs WHERE clean_id IN (SELECT clean_id FROM u) GROUP BY 1),
o AS (SELECT *, TRY_CAST(regexp_extract(clean_id, '^(chr)?0*([1-9][0-9]*)$', 2) AS BIGINT) AS own FROM c),
n AS (SELECT clean_id, coalesce(own, coalesce(max(own) OVER (), 0) + row_number() OVER (PARTITION BY own IS NULL ORDER BY ord, clean_id)) AS number FROM o)
SELECT '>' || number AS header, count(*) AS records, count(DISTINCT coalesce(identifier, '')) AS bodies FROM locus JOIN contigs ON chromosome = old_id JOIN n USING (clean_id) GROUP BY 1""",
    "s4_counted_fasta": f"WITH {_TAGS} SELECT 'seq_' || length(tag_seq) AS tag_id, tag_seq, abun FROM tags",
    "s7_reference": """WITH t AS (SELECT 'doc' || doc_id AS old_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS q FROM documents WHERE text IS NOT NULL)
SELECT old_id, CAST(length(q) AS INT) AS len, md5(q) AS digest FROM t WHERE length(q) > 200""",
    "s9_sam_alignments": f"""WITH {READS} SELECT chromosome, strand, pos, CAST(length(tag_seq) AS INT) AS len, count(*) AS n, CAST(sum(abun) AS BIGINT) AS abun, max(hits) AS hits FROM reads
WHERE tag_seq IS NOT NULL AND abun IS NOT NULL AND hits < 5 AND hits % 2 = 0 AND strand IS NOT NULL AND tag_id IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "s9_sam_round_trip": f"""WITH {READS} SELECT chromosome, strand, pos, CAST(length(tag_seq) AS INT) AS len, count(*) AS n, CAST(sum(abun) AS BIGINT) AS abun, max(hits) AS hits FROM reads
WHERE tag_seq IS NOT NULL AND abun IS NOT NULL AND hits < 25 AND strand IS NOT NULL AND tag_id IS NOT NULL GROUP BY 1, 2, 3, 4""",
    "s10_cluster_blocks": f"""WITH {READS} SELECT clusterID, count(*) AS n, CAST(sum(abun) AS BIGINT) AS abun, max(pos) AS "last", round(sum(CASE WHEN pval_corr_f IS NOT NULL AND NOT isnan(pval_corr_f) THEN pval_corr_f ELSE 0 END), 6) AS p
FROM reads WHERE clusterID IS NOT NULL GROUP BY 1""",
    "s13_annotation": """SELECT DISTINCT chromosome, "start" - 1 AS "start", "end", identifier AS name FROM locus WHERE "start" IS NOT NULL AND "end" IS NOT NULL AND chromosome IS NOT NULL AND identifier IS NOT NULL""",
    "s17_id_map": """WITH m AS (SELECT regexp_replace(cluster_a, '^\\s+|\\s+$', '', 'g') AS a, regexp_replace(cluster_b, '^\\s+|\\s+$', '', 'g') AS b FROM merged_pairs WHERE cluster_a IS NOT NULL),
c AS (SELECT 'group of ' || a AS identifier, unnest([a, b]) AS c FROM m) SELECT identifier, count(DISTINCT c) AS members FROM c WHERE c <> '' GROUP BY 1""",
    "k10_expanded_copies": f"WITH {_TAGS} SELECT CAST(length(tag_seq) AS INT) AS len, CAST(sum(abun) AS BIGINT) AS records FROM tags GROUP BY 1",
    "m1_contig_numbers": """WITH u AS (SELECT DISTINCT clean_id FROM locus JOIN contigs ON chromosome = old_id), c AS (SELECT clean_id, min(ord) AS ord FROM contigs WHERE clean_id IN (SELECT clean_id FROM u) GROUP BY 1),
o AS (SELECT *, TRY_CAST(regexp_extract(clean_id, '^(chr)?0*([1-9][0-9]*)$', 2) AS BIGINT) AS own FROM c)
SELECT clean_id, coalesce(own, coalesce(max(own) OVER (), 0) + row_number() OVER (PARTITION BY own IS NULL ORDER BY ord, clean_id)) AS number FROM o""",
}
