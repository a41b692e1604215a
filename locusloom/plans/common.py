"""The aligned reads behind the domain queries, in both dialects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.functions.loci import CRICK, WATSON, strand_code
from locusloom.functions.sequences import molecule
from locusloom.session import table

PHASE, BUFFER, LOCUS_LENGTH = 21, 300, 350


def reads(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a library and a contig, in one spelling of contigs, strands and molecules."""
    rows, contigs = table(spark, d, "phas_to_detect"), table(spark, d, "contigs")
    named = rows.join(contigs.select("old_id", "clean_id", "ord"), rows["chromosome"] == F.col("old_id"))
    return named.where(rows["alib"].isNotNull()).select(
        "alib", "clusterID", F.col("clean_id").alias("chromosome"), "ord", strand_code(rows["strand"]).alias("strand"),
        "pos", "len", "hits", "abun", "tag_id", molecule(rows["tag_seq"]).alias("tag_seq"), "identifier",
        "pval_h_f", "N_f", "X_f", "pval_r_f", "pval_corr_f", "pval_h_r", "N_r", "X_r", "pval_r_r", "pval_corr_r",
    )


MOLECULE = "nullif(replace(upper(regexp_replace(tag_seq, '^\\s+|\\s+$', '', 'g')), 'U', 'T'), '')"
READS = f"""reads AS (
  SELECT alib, clusterID, clean_id AS chromosome, ord,
    CASE WHEN lower(trim(strand)) IN {WATSON} THEN 'w' WHEN lower(trim(strand)) IN {CRICK} THEN 'c' END AS strand,
    pos, len, hits, abun, tag_id, {MOLECULE} AS tag_seq, identifier,
    pval_h_f, N_f, X_f, pval_r_f, pval_corr_f, pval_h_r, N_r, X_r, pval_r_r, pval_corr_r
  FROM phas_to_detect JOIN contigs ON chromosome = old_id WHERE alib IS NOT NULL)"""
