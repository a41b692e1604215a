"""Queries of the training-data problems and, where SQL can say it, their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.llm.components import connected_components
from locusloom.llm.frequent import frequent_values
from locusloom.llm.packing import pack
from locusloom.llm.tokenizer import encode_texts, spread, token_count
from locusloom.llm.topn import top_n_per_group
from locusloom.llm.truncation import truncated_texts
from locusloom.session import table

FREQUENT_SHARE = 0.005
CONTAINER = 2048
#: Attention cost of a container: three quarters of that of one text of its full size.
CONTAINER_COST = CONTAINER * CONTAINER * 3 // 4
WINDOWS_PER_CLUSTER, FEATURES_PER_LIBRARY = 3, 10


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The 3 best windows of each cluster and the 10 best feature rows of each library."""
    w, f = table(spark, d, "clusters_windows_to_score"), table(spark, d, "features")
    windows = top_n_per_group(w, w["cluster_id"], w["window_n"], w["combined_window_p_value"], WINDOWS_PER_CLUSTER)
    rows = top_n_per_group(f, f["alib"], f["cID"], f["Peak_Howell_score"], FEATURES_PER_LIBRARY, descending=True)
    return windows.select(F.lit("window").alias("scope"), "group_key", F.col("item_key").cast("string").alias("item_key")).unionByName(
        rows.select(F.lit("feature").alias("scope"), "group_key", "item_key")
    )


def molecule(tag_seq):
    """One spelling of a tag: no surrounding white space, capitals, T for U; null where nothing is left."""
    clean = F.translate(F.upper(F.regexp_replace(tag_seq, r"^\s+|\s+$", "")), "U", "T")
    return F.when(clean != "", clean)


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """Frequent molecules by rows and by abundance, with the sketch's estimate and the verified weight."""
    tags = table(spark, d, "phas_to_detect")
    found = frequent_values(tags, molecule(tags["tag_seq"]), {"rows": F.lit(1), "abun": tags["abun"]}, FREQUENT_SHARE)
    return found.select("measure", F.col("value").alias("tag_seq"), "estimate", "weight")


def p2_weights(spark: SparkSession, d: str) -> DataFrame:
    """The verified weights of the frequent molecules alone."""
    return p2_counts(spark, d).select("measure", "tag_seq", "weight")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Molecules with at least 0.5 % of the rows, or of the abundance."""
    return p2_counts(spark, d).select("measure", "tag_seq")


def cluster_links(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of ``merged_pairs`` whose clusters both occur, on the same contig."""
    tags, pairs, contigs = (table(spark, d, n) for n in ("phas_to_detect", "merged_pairs", "contigs"))
    spelled = tags.select("clusterID", "chromosome").dropna().distinct()
    lies = spelled.join(contigs.select("old_id", "clean_id"), F.col("chromosome") == F.col("old_id")).select("clusterID", "clean_id").distinct()
    bare = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    named = pairs.select(bare("cluster_a").alias("a"), bare("cluster_b").alias("b")).where("a <> b").distinct()
    left = lies.select(F.col("clusterID").alias("a"), F.col("clean_id").alias("contig"))
    right = lies.select(F.col("clusterID").alias("b"), F.col("clean_id").alias("contig"))
    return named.join(left, "a").join(right, ["b", "contig"]).select("a", "b")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Group of every linked cluster."""
    groups = connected_components(cluster_links(spark, d), F.col("a"), F.col("b"))
    return groups.select(F.col("vertex").alias("cluster_id"), F.col("component").alias("group_id"))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of each document."""
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return encode_texts(docs, ["doc_id"], "text").select("doc_id", "ids")


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """All texts in containers of 2,048 tokens, 256 pieces and three quarters of the cost of a full text."""
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    return pack(docs.select("doc_id", token_count(F.col("text")).alias("size")), "doc_id", "size", CONTAINER, max_cost=CONTAINER_COST)


def _ends(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(table(spark, d, "documents").select("doc_id", "text", "source", "tgt_text", "align_score"))
    return truncated_texts(docs, "doc_id", "text", "source", "tgt_text", "align_score")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose text was cut off."""
    return _ends(spark, d).where("is_cut").select("doc_id")


def p8_sources(spark: SparkSession, d: str) -> DataFrame:
    """For each source: texts, cut texts, their share and what showed the cut."""
    counts = {f"by_{e}": F.count_if(F.col("evidence") == e) for e in ("copy", "left_open", "limit", "closing_word", "translation", "unclosed")}
    return _ends(spark, d).groupBy("source").agg(
        F.count(F.lit(1)).alias("texts"), F.count_if("is_cut").alias("cut"), F.avg(F.col("is_cut").cast("double")).alias("share"),
        *(c.alias(n) for n, c in counts.items()),
    )


QUERIES = {
    "p1_found": p1_found, "p2_found": p2_found, "p2_counts": p2_counts, "p2_weights": p2_weights, "p3_found": p3_found,
    "p6_ids": p6_ids, "p7_containers": p7_containers, "p8_found": p8_found, "p8_sources": p8_sources,
}

_MOLECULES = """
m AS (SELECT nullif(replace(upper(regexp_replace(tag_seq, '^\\s+|\\s+$', '', 'g')), 'U', 'T'), '') AS tag_seq, abun FROM phas_to_detect),
t AS (SELECT count(*) AS n, sum(abun) AS a FROM m),
g AS (SELECT tag_seq, count(*) AS n, coalesce(sum(abun), 0) AS a FROM m WHERE tag_seq IS NOT NULL GROUP BY 1)"""

SQL = {
    "p1_found": """
WITH w AS (SELECT DISTINCT cluster_id, window_n, combined_window_p_value AS p FROM clusters_windows_to_score
           WHERE cluster_id IS NOT NULL AND window_n IS NOT NULL AND combined_window_p_value IS NOT NULL AND NOT isnan(combined_window_p_value)),
f AS (SELECT DISTINCT alib, cID, Peak_Howell_score AS s FROM features
      WHERE alib IS NOT NULL AND cID IS NOT NULL AND Peak_Howell_score IS NOT NULL AND NOT isnan(Peak_Howell_score)),
rw AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY p, window_n) AS r FROM w),
rf AS (SELECT *, row_number() OVER (PARTITION BY alib ORDER BY s DESC, cID) AS r FROM f)
SELECT 'window' AS scope, cluster_id AS group_key, CAST(window_n AS VARCHAR) AS item_key FROM rw WHERE r <= 3
UNION ALL SELECT 'feature', alib, cID FROM rf WHERE r <= 10""",
    "p2_found": f"""
WITH {_MOLECULES}
SELECT 'rows' AS measure, tag_seq FROM g, t WHERE g.n >= 0.005 * t.n
UNION ALL SELECT 'abun', tag_seq FROM g, t WHERE t.a > 0 AND g.a >= 0.005 * t.a""",
    "p2_weights": f"""
WITH {_MOLECULES}
SELECT 'rows' AS measure, tag_seq, CAST(g.n AS BIGINT) AS weight FROM g, t WHERE g.n >= 0.005 * t.n
UNION ALL SELECT 'abun', tag_seq, CAST(g.a AS BIGINT) FROM g, t WHERE t.a > 0 AND g.a >= 0.005 * t.a""",
    "p3_found": """
WITH RECURSIVE lies AS (SELECT DISTINCT clusterID AS c, clean_id AS contig FROM phas_to_detect JOIN contigs ON chromosome = old_id WHERE clusterID IS NOT NULL),
named AS (SELECT DISTINCT regexp_replace(cluster_a, '^\\s+|\\s+$', '', 'g') AS a, regexp_replace(cluster_b, '^\\s+|\\s+$', '', 'g') AS b FROM merged_pairs),
one AS (SELECT DISTINCT n.a, n.b FROM named n JOIN lies x ON x.c = n.a JOIN lies y ON y.c = n.b AND x.contig = y.contig WHERE n.a <> n.b),
both_ways AS (SELECT a, b FROM one UNION SELECT b, a FROM one),
reach AS (SELECT a AS v, a AS m FROM both_ways UNION SELECT e.b, r.m FROM reach r JOIN both_ways e ON e.a = r.v WHERE r.m < e.b)
SELECT v AS cluster_id, min(m) AS group_id FROM reach GROUP BY 1""",
}
