"""Queries over phasing windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.operators import howell as H
from locusloom.operators.features import cluster_features, phase_positions
from locusloom.plans.common import PHASE, READS, reads
from locusloom.session import saved

CUTOFF = 12.5


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = reads(spark, d).where("clusterID is not null")
    return phase_positions(rows, "clusterID", PHASE), rows.groupBy("clusterID").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))


def _scan(spark: SparkSession, d: str) -> DataFrame:
    return H.howell_scan(*_inputs(spark, d), "clusterID", PHASE)


def _trace(spark: SparkSession, d: str) -> DataFrame:
    return H.howell_trace(_inputs(spark, d)[0], "clusterID", PHASE)


def _saved_trace(spark: SparkSession, d: str) -> DataFrame:
    """The trace as a table, for queries that read it more than once: its kernel runs once."""
    return saved(_trace(spark, d), "trace")


def _saved_scan(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Positions and their scan, both as tables."""
    positions, spans = _inputs(spark, d)
    positions = saved(positions, "positions")
    return positions, saved(H.howell_scan(positions, spans, "clusterID", PHASE), "scan")


def n7_strict_scan(spark: SparkSession, d: str) -> DataFrame:
    """Best window without wobble of each cluster and strand."""
    return _scan(spark, d).select("clusterID", "strand", F.round("strict_score", 6).alias("score"), F.col("strict_start").alias("window_start"))


def n8_relaxed_scan(spark: SparkSession, d: str) -> DataFrame:
    """Best window with wobble of each cluster and strand."""
    return _scan(spark, d).select("clusterID", "strand", F.round("score", 6).alias("score"), "window_start")


def n9_peak_ambiguity(spark: SparkSession, d: str) -> DataFrame:
    rows = H.peak_ambiguity(*_saved_scan(spark, d), "clusterID", PHASE)
    return rows.withColumns({c: F.round(c, 6) for c in ("exact_support", "overlap_margin", "origin_margin")})


def w6_trace(spark: SparkSession, d: str) -> DataFrame:
    return _trace(spark, d).withColumns({c: F.round(c, 6) for c in ("score", "in_phase", "out_of_phase")})


def w7_trace_groups(spark: SparkSession, d: str) -> DataFrame:
    return H.trace_groups(_trace(spark, d), "clusterID", CUTOFF)


def n10_crowding(spark: SparkSession, d: str) -> DataFrame:
    rows = H.crowding(_saved_trace(spark, d), "clusterID", PHASE)
    return rows.withColumns({c: F.round(c, 6) for c in ("peak_score", "crowding_best", "crowding_gap")})


def n15_register_reads(spark: SparkSession, d: str) -> DataFrame:
    positions = saved(_inputs(spark, d)[0], "positions")
    return H.register_reads(positions, H.trace_peaks(H.howell_trace(positions, "clusterID", PHASE), "clusterID"), "clusterID", PHASE)


def n14_feature_table(spark: SparkSession, d: str) -> DataFrame:
    """Cluster features with peak scores, ambiguity and crowding."""
    positions, scan = _saved_scan(spark, d)
    peaks = scan.groupBy("clusterID").agg(F.max("score").alias("Peak_Howell_score"), F.max("strict_score").alias("Peak_Howell_score_strict"))
    base = cluster_features(reads(spark, d).where("clusterID is not null"), "clusterID", PHASE)
    ambiguity = H.peak_ambiguity(positions, scan, "clusterID", PHASE)
    crowd = H.crowding(saved(H.howell_trace(positions, "clusterID", PHASE), "trace"), "clusterID", PHASE).select("clusterID", "crowding_windows", "crowding_best", "crowding_gap")
    return base.join(peaks, "clusterID", "left").join(ambiguity, "clusterID", "left").join(crowd, "clusterID", "left")


def n11_peak_competitors(spark: SparkSession, d: str) -> DataFrame:
    return H.peak_competitors(*_saved_scan(spark, d), "clusterID", PHASE).withColumn("exact_score", F.round("exact_score", 6))


def n12_trace_group_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Groups of strong windows with their peaks and registers: what the assembly of units starts from."""
    rows = H.trace_group_summaries(_saved_trace(spark, d), "clusterID", PHASE, CUTOFF)
    return rows.withColumn("group_score", F.round("group_score", 6))


def n12_alternative_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping windows of other registers by the shift of their register."""
    rows = H.alternative_candidates(_saved_trace(spark, d), "clusterID", PHASE, CUTOFF)
    return rows.withColumn("best_score", F.round("best_score", 6))


def t4_top_alternatives(spark: SparkSession, d: str) -> DataFrame:
    """The six best overlapping alternatives of each cluster."""
    rows = H.alternative_candidates(_saved_trace(spark, d), "clusterID", PHASE, CUTOFF).withColumn("best_score", F.round("best_score", 6))
    return H.top_alternatives(rows, "clusterID").select("clusterID", "strand", "shift_nt", "best_score", "rank")


def k7_register_tags(spark: SparkSession, d: str) -> DataFrame:
    """The phased tags of each cluster's peak: the rows of the table of phased small RNAs."""
    rows = reads(spark, d).where("clusterID is not null and strand is not null")
    return H.register_tags(n15_register_reads(spark, d), rows, "clusterID", PHASE)


QUERIES = {f.__name__: f for f in (n7_strict_scan, n8_relaxed_scan, n9_peak_ambiguity, w6_trace, w7_trace_groups, n10_crowding, n11_peak_competitors, n12_trace_group_summaries, n12_alternative_candidates, n15_register_reads, t4_top_alternatives, k7_register_tags, n14_feature_table)}

_BASE = f"""{READS}, pa AS (SELECT clusterID, strand, pos, CAST(sum(coalesce(abun, 0)) AS BIGINT) AS abun FROM reads WHERE len = 21 AND strand IS NOT NULL AND clusterID IS NOT NULL GROUP BY 1, 2, 3),
sp AS (SELECT clusterID, min(pos) AS lo, max(pos) AS hi FROM reads WHERE clusterID IS NOT NULL GROUP BY 1),
bo AS (SELECT clusterID, strand, CASE WHEN any_value(hi) - 209 >= any_value(lo) THEN any_value(lo) ELSE min(pos) END AS a, CASE WHEN any_value(hi) - 209 >= any_value(lo) THEN any_value(hi) - 209 ELSE min(pos) END AS b
  FROM pa JOIN sp USING (clusterID) GROUP BY 1, 2)"""
_DENSE = f"""{_BASE}, m AS (SELECT clusterID, strand, pos, abun, unnest(range(greatest(a, pos - 209), least(b, pos) + 1)) AS s FROM pa JOIN bo USING (clusterID, strand))"""
_ANCHORED = f"""{_BASE}, every AS (SELECT clusterID, strand, pos, abun, unnest(range(pos - 209, pos + 1)) AS s FROM pa),
an AS (SELECT clusterID, strand, pos AS anchor, CASE strand WHEN 'w' THEN pos ELSE pos - 209 END AS s FROM pa),
m AS (SELECT every.* FROM every JOIN an USING (clusterID, strand, s))"""
_SCORE = "CASE WHEN n > 3 AND i > 0 THEN (least(n, 10) - 2) * ln(1 + 10 * CAST(i AS DOUBLE) / (1 + greatest(0, t - i))) ELSE 0 END"
_STRICT = f"""tot AS (SELECT clusterID, strand, s, sum(abun) AS t FROM m GROUP BY 1, 2, 3),
rg AS (SELECT clusterID, strand, s, CASE strand WHEN 'w' THEN (pos - s) % 21 ELSE (s + 209 - pos) % 21 END AS r, sum(abun) AS i, count(*) AS n FROM m GROUP BY 1, 2, 3, 4),
pick AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clusterID, strand, s ORDER BY i DESC, r) AS k FROM rg) WHERE k = 1),
sc AS (SELECT clusterID, strand, s, {_SCORE} AS score FROM pick JOIN tot USING (clusterID, strand, s))"""
_RELAXED = f"""tot AS (SELECT clusterID, strand, s, sum(abun) AS t0 FROM m GROUP BY 1, 2, 3),
off AS (SELECT clusterID, strand, s, abun, k, pos - s - k AS e FROM m, (VALUES (-1), (0), (1)) AS v(k) WHERE pos - s - k BETWEEN 0 AND 209),
cy AS (SELECT clusterID, strand, s, e % 21 AS g, e // 21 AS c, max(abun) FILTER (WHERE k = 0) AS x, max(abun) FILTER (WHERE k = -1) AS l, max(abun) FILTER (WHERE k = 1) AS r FROM off GROUP BY 1, 2, 3, 4, 5),
rg AS (SELECT clusterID, strand, s, CASE strand WHEN 'w' THEN g ELSE 20 - g END AS r, sum(coalesce(x, greatest(l, r))) AS i, sum(CASE WHEN x IS NOT NULL THEN coalesce(l, 0) + coalesce(r, 0) WHEN l IS NOT NULL AND r IS NOT NULL THEN least(l, r) ELSE 0 END) AS q, count(*) AS n FROM cy GROUP BY 1, 2, 3, 4),
rs AS (SELECT clusterID, strand, s, r, n, i, greatest(0, t - i) AS o, {_SCORE} AS score FROM (SELECT rg.*, t0 - q AS t FROM rg JOIN tot USING (clusterID, strand, s))),
sc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clusterID, strand, s ORDER BY score DESC, r) AS k FROM rs) WHERE k = 1)"""
_BEST = """SELECT bo.clusterID, bo.strand, round(coalesce(max(score), 0), 6) AS score, CASE WHEN coalesce(max(score), 0) > 0 THEN first(s ORDER BY score DESC, s) ELSE any_value(a) END AS window_start
FROM bo LEFT JOIN sc ON sc.clusterID = bo.clusterID AND sc.strand = bo.strand GROUP BY 1, 2"""
_TRACE = f"""{_ANCHORED}, {_RELAXED}, tr AS (SELECT an.clusterID, an.strand, anchor, s AS window_start, s + 209 AS window_end, score, CASE WHEN score > 0 THEN CAST(i AS DOUBLE) END AS in_phase, CASE WHEN score > 0 THEN CAST(o AS DOUBLE) END AS out_of_phase,
  CASE WHEN score > 0 THEN CAST(n AS INT) END AS occupied_cycles, CASE WHEN score > 0 THEN CAST(r AS INT) END AS register FROM an JOIN sc USING (clusterID, strand, s))"""
_PEAKS = f"""{_TRACE}, pk AS (SELECT clusterID, strand, anchor AS pa_, window_start AS ps, window_end AS pe, score AS psc, CASE strand WHEN 'w' THEN window_start + coalesce(register, 0) ELSE window_end - coalesce(register, 0) END AS origin
  FROM (SELECT *, row_number() OVER (PARTITION BY clusterID ORDER BY score DESC, strand, CASE strand WHEN 'w' THEN -anchor ELSE anchor END) AS k2 FROM tr) WHERE k2 = 1)"""

# the exact scores of all registers of every window, its best register and frame; the peak is the best relaxed window
_EXACT = f"""{_DENSE}, tot AS (SELECT clusterID, strand, s, sum(abun) AS t FROM m GROUP BY 1, 2, 3),
rg AS (SELECT clusterID, strand, s, CASE strand WHEN 'w' THEN (pos - s) % 21 ELSE (s + 209 - pos) % 21 END AS r, sum(abun) AS i, count(*) AS n FROM m GROUP BY 1, 2, 3, 4),
ex AS (SELECT clusterID, strand, s, r, {_SCORE} AS score FROM rg JOIN tot USING (clusterID, strand, s)),
en AS (SELECT clusterID, strand, s, max(score) AS score, first(r ORDER BY score DESC, r) AS best FROM ex GROUP BY 1, 2, 3),
win AS (SELECT clusterID, strand, s, score, CASE strand WHEN 'w' THEN (s + (CASE WHEN score > 0 THEN best ELSE 0 END)) % 21 ELSE (s + 209 - (CASE WHEN score > 0 THEN best ELSE 0 END)) % 21 END AS frame FROM en)"""
_RIVALS = lambda winner: f"""{_EXACT}, {_RELAXED.replace('tot AS', 'tot2 AS').replace('JOIN tot ', 'JOIN tot2 ').replace('rg AS', 'rg2 AS').replace('rg.*', 'rg2.*').replace('FROM rg ', 'FROM rg2 ')},
sb AS ({_BEST.replace('round(coalesce(max(score), 0), 6)', 'coalesce(max(score), 0)')}),
pk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY clusterID ORDER BY score DESC, strand {winner}) AS k4 FROM sb) WHERE k4 = 1),
me AS (SELECT pk.clusterID, pk.strand, window_start AS p0, coalesce(w.score, 0) AS sup, w.frame AS fr FROM pk LEFT JOIN win w ON w.clusterID = pk.clusterID AND w.strand = pk.strand AND w.s = window_start),
rv AS (SELECT me.*, w.s, w.score AS sc, w.frame AS f2 FROM me JOIN win w USING (clusterID, strand) WHERE me.sup > 0 AND w.s <> p0 AND w.s BETWEEN p0 - 209 AND p0 + 209 AND w.score >= 0.9 * me.sup)"""  # noqa: E731

_REGISTER = f"""WITH {_PEAKS}, pl AS (SELECT clusterID, strand, origin, CAST(unnest(range(0, 10)) AS INT) AS cycle FROM pk),
ex AS (SELECT *, origin + cycle * CASE strand WHEN 'w' THEN 21 ELSE -21 END AS expected FROM pl),
fd AS (SELECT ex.*, pa.pos, pa.abun, pa.pos - expected AS o FROM ex JOIN pa ON pa.clusterID = ex.clusterID AND pa.strand = ex.strand AND pa.pos BETWEEN expected - 1 AND expected + 1)
SELECT clusterID, strand, origin, cycle, expected, pos, abun, CASE o WHEN 0 THEN 'core_exact' ELSE 'core_offset' END AS register_class
FROM (SELECT *, row_number() OVER (PARTITION BY clusterID, cycle ORDER BY o <> 0, abun DESC, o) AS k FROM fd) WHERE k = 1"""
_ALTERNATIVES = f"""WITH {_PEAKS}, x AS (SELECT tr.*, (((CASE strand WHEN 'w' THEN window_start + register ELSE window_end - register END) - origin) % 21 + 21) % 21 AS m
  FROM tr JOIN pk USING (clusterID, strand) WHERE anchor <> pa_ AND score >= 12.5 AND ((anchor - origin) % 21 + 21) % 21 NOT IN (0, 1, 20) AND window_start <= pe AND ps <= window_end)
SELECT clusterID, strand, CASE WHEN m > 10.5 THEN m - 21 ELSE m END AS shift_nt, count(*) AS windows, round(max(score), 6) AS best_score, min(window_start) AS min_start, max(window_end) AS max_end
FROM x WHERE m <> 0 GROUP BY 1, 2, 3"""

SQL = {
    "n9_peak_ambiguity": f"""WITH {_RIVALS('DESC')},
al AS (SELECT me.clusterID, count(*) FILTER (WHERE e.score >= 0.9 * sup) - 1 AS alt FROM me JOIN ex e ON e.clusterID = me.clusterID AND e.strand = me.strand AND e.s = p0 WHERE sup > 0 GROUP BY 1),
ag AS (SELECT clusterID, count(*) AS n, max(sc) AS top, count(*) FILTER (WHERE f2 = fr) AS same, count(*) FILTER (WHERE f2 <> fr) AS other, max(sc) FILTER (WHERE f2 <> fr) AS other_top, count(DISTINCT f2) FILTER (WHERE f2 <> fr) AS frames,
  min(s) FILTER (WHERE f2 = fr) AS lo_, max(s) FILTER (WHERE f2 = fr) AS hi_ FROM rv GROUP BY 1)
SELECT me.clusterID, strand AS peak_strand, p0 AS peak_start, round(sup, 6) AS exact_support, CASE WHEN sup > 0 THEN CAST(coalesce(n, 0) AS INT) END AS ambiguity_count, CASE WHEN sup > 0 THEN CAST(alt AS INT) END AS alt_register_count,
  round(sup - top, 6) AS overlap_margin, CASE WHEN sup > 0 THEN CAST(coalesce(same, 0) AS INT) END AS extension_window_count,
  CASE WHEN sup > 0 THEN CAST(greatest(p0, coalesce(hi_, p0)) + 210 - least(p0, coalesce(lo_, p0)) AS BIGINT) END AS extension_span_nt, CASE WHEN sup > 0 THEN CAST(coalesce(other, 0) AS INT) END AS origin_window_count,
  CASE WHEN sup > 0 THEN CAST(coalesce(frames, 0) AS INT) END AS origin_frame_count, round(sup - other_top, 6) AS origin_margin,
  CASE WHEN sup <= 0 THEN 'insufficient_exact_support' WHEN n IS NULL THEN 'unique_origin' WHEN other = 0 THEN 'coherent_extension' WHEN same > 0 THEN 'mixed_extension_and_ambiguity' ELSE 'ambiguous_origin' END AS origin_class
FROM me LEFT JOIN al USING (clusterID) LEFT JOIN ag USING (clusterID)""",
    "n11_peak_competitors": f"""WITH {_RIVALS('ASC')} SELECT clusterID, strand, s AS window_start, s + 209 AS window_end, round(sc, 6) AS exact_score, CAST(f2 AS INT) AS exact_frame FROM rv WHERE f2 <> fr""",
    "n7_strict_scan": f"WITH {_DENSE}, {_STRICT} {_BEST}",
    "n8_relaxed_scan": f"WITH {_DENSE}, {_RELAXED} {_BEST}",
    "w6_trace": f"WITH {_TRACE} SELECT * REPLACE (round(score, 6) AS score, round(in_phase, 6) AS in_phase, round(out_of_phase, 6) AS out_of_phase) FROM tr",
    "w7_trace_groups": f"""WITH {_TRACE}, b AS (SELECT *, max(window_end) OVER (PARTITION BY clusterID, strand ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM tr WHERE score >= 12.5),
i AS (SELECT *, sum(CASE WHEN pe IS NULL OR window_start > pe THEN 1 ELSE 0 END) OVER (PARTITION BY clusterID, strand ORDER BY window_start) AS g FROM b)
SELECT clusterID, strand, min(window_start) AS group_start, max(window_end) AS group_end FROM i GROUP BY clusterID, strand, g""",
    "n10_crowding": f"""WITH {_PEAKS}, x AS (SELECT tr.*, pa_, ps, pe, psc, (anchor <> pa_ AND ((anchor - origin) % 21 + 21) % 21 NOT IN (0, 1, 20) AND window_start <= pe AND ps <= window_end AND abs(psc - score) <= 4) AS near FROM tr JOIN pk USING (clusterID, strand))
SELECT clusterID, strand, pa_ AS peak_anchor, round(psc, 6) AS peak_score, count(*) FILTER (WHERE near) AS crowding_windows, round(max(score) FILTER (WHERE near), 6) AS crowding_best,
  round(psc - max(score) FILTER (WHERE near), 6) AS crowding_gap FROM x GROUP BY clusterID, strand, pa_, psc""",
    "n12_trace_group_summaries": f"""WITH {_PEAKS}, b AS (SELECT *, max(window_end) OVER (PARTITION BY clusterID, strand ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_ FROM tr WHERE score >= 12.5),
i AS (SELECT *, sum(CASE WHEN before_ IS NULL OR window_start > before_ THEN 1 ELSE 0 END) OVER (PARTITION BY clusterID, strand ORDER BY window_start) AS grp FROM b),
q AS (SELECT *, min(window_start) OVER v AS gs, max(window_end) OVER v AS ge, row_number() OVER (PARTITION BY clusterID, strand, grp ORDER BY score DESC, CASE strand WHEN 'w' THEN -anchor ELSE anchor END) AS k3,
  CASE strand WHEN 'w' THEN window_start + register ELSE window_end - register END AS o FROM i WINDOW v AS (PARTITION BY clusterID, strand, grp)),
top AS (SELECT clusterID, strand, grp, gs, ge, anchor AS ga, score AS gsc, o AS go_ FROM q WHERE k3 = 1),
rel AS (SELECT top.*, ((q.anchor - go_) % 21 + 21) % 21 AS m FROM top JOIN q USING (clusterID, strand, grp)),
cnt AS (SELECT clusterID, strand, gs, ge, ga, gsc, go_, count(*) FILTER (WHERE m = 0) AS exact_rows, count(*) FILTER (WHERE m IN (1, 20)) AS offset_rows, count(*) FILTER (WHERE m NOT IN (0, 1, 20)) AS other_rows FROM rel GROUP BY ALL)
SELECT cnt.clusterID, cnt.strand, gs AS group_start, ge AS group_end, ga AS group_anchor, round(gsc, 6) AS group_score, go_ AS group_origin, exact_rows, offset_rows, other_rows,
  CASE WHEN ((go_ - origin) % 21 + 21) % 21 = 0 THEN NULL WHEN ((go_ - origin) % 21 + 21) % 21 > 10.5 THEN ((go_ - origin) % 21 + 21) % 21 - 21 ELSE ((go_ - origin) % 21 + 21) % 21 END AS shift_nt, gs <= pe AND ps <= ge AS overlaps_peak
FROM cnt JOIN pk USING (clusterID)""",
    "n12_alternative_candidates": _ALTERNATIVES,
    "n15_register_reads": _REGISTER,
    "t4_top_alternatives": f"SELECT clusterID, strand, shift_nt, best_score, rank FROM (SELECT *, row_number() OVER (PARTITION BY clusterID ORDER BY best_score DESC, shift_nt) AS rank FROM ({_ALTERNATIVES}) AS c) WHERE rank <= 6",
    "k7_register_tags": f"""SELECT c.clusterID, c.strand, c.origin, c.cycle, c.pos, c.register_class, t.tag_seq, t.abun FROM ({_REGISTER}) AS c
JOIN (WITH {READS} SELECT clusterID, strand, pos, tag_seq, CAST(sum(coalesce(abun, 0)) AS BIGINT) AS abun FROM reads WHERE len = 21 AND tag_seq IS NOT NULL AND clusterID IS NOT NULL AND strand IS NOT NULL GROUP BY 1, 2, 3, 4) AS t
  ON t.clusterID = c.clusterID AND t.strand = c.strand AND t.pos = c.pos""",
}
