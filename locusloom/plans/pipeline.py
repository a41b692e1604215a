"""The pipeline: aligned reads to scored clusters, scored clusters to calls, two runs to one set of loci."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.config import Params
from locusloom.functions.loci import locus_id, locus_parts, per_ten_million
from locusloom.operators import classify as CL
from locusloom.operators import clusters as C
from locusloom.operators import compare as CP
from locusloom.operators import features as FE
from locusloom.operators import howell as H
from locusloom.operators import labelling as LB
from locusloom.operators import windows as W
from locusloom.operators.overlaps import overlap_groups
from locusloom.session import saved

_KEYS = ["alib", "chromosome"]
_ALTERNATIVES = ["Howell_overlapping_alt_count", "Howell_overlapping_alt_best_score"]
_STATS = ["pval_h_f", "N_f", "X_f", "pval_r_f", "pval_corr_f", "pval_h_r", "N_r", "X_r", "pval_r_r", "pval_corr_r"]


def prepared(alignments: DataFrame, p: Params) -> DataFrame:
    """Usable alignments of libraries; pooled into one if asked, and normalised by the library's alignments.

    Tags counted less than ``min_depth`` times in their library are left out before anything else.
    """
    deep = alignments.where(F.col("abun") >= p.min_depth)
    rows = deep.withColumn("alib", F.lit("ALL_LIBS")) if p.pooled else deep
    if p.normalise:
        rows = rows.join(C.library_totals(rows), "alib").withColumn("abun", per_ten_million(F.col("abun"), F.col("total_abun"), p.norm_factor)).drop("total_abun")
    return rows.where((F.col("hits") < p.max_hits) & (F.col("mismatches") <= p.mismatches))


def find(reads: DataFrame, p: Params) -> DataFrame:
    """Reads of the clusters that pass, with the statistics of their positions.

    ``reads``: ``alib``, ``chromosome``, ``strand`` (``w`` or ``c``), ``pos``, ``len``, ``hits``, ``abun``, ``tag_id``,
    ``tag_seq``. A position on both strands has the statistics of Crick.
    """
    at = reads.groupBy(*_KEYS, "pos").agg(F.count(F.lit(1)).alias("n_reads"))
    numbered = C.gap_clusters(at, _KEYS, C.cluster_gap(p.phase, p.cluster_buffer))
    long = C.long_enough(C.cluster_spans(numbered, _KEYS), p.phase).select(*_KEYS, "cluster_no")
    named = numbered.join(long, [*_KEYS, "cluster_no"]).select(*_KEYS, "pos", F.format_string("%s-%s_%d_%s", "alib", "chromosome", "cluster_no", "chromosome").alias("clusterID"))
    rows = reads.join(named, [*_KEYS, "pos"])
    good = C.cluster_quality(rows, "clusterID", p.phase, p.unique_ratio).where("passes").select("clusterID")
    rows = saved(rows.join(good, "clusterID", "left_semi"), "clustered")
    sites = rows.groupBy("clusterID", "pos", "strand").agg(F.sum(F.coalesce("abun", F.lit(0))).alias("abun"))
    stats = LB.site_statistics(sites, "clusterID", p.phase)
    by_place = stats.groupBy("clusterID", F.col("a_pos").alias("pos")).agg(F.max_by(F.struct(*_STATS), (F.col("a_strand") == "c").cast("int")).alias("s"))
    return rows.join(by_place.select("clusterID", "pos", "s.*"), ["clusterID", "pos"])


def identified(scored: DataFrame, p: Params) -> DataFrame:
    """Scored reads with the ``identifier`` of their cluster's overlap group over all libraries.

    A short cluster is a group of its own; in a pool it has no identifier and its rows are dropped.
    """
    spans = scored.groupBy("clusterID", "chromosome").agg(F.min("pos").alias("start"), F.max("pos").alias("end"))
    is_long = F.col("end") - F.col("start") >= p.least_length
    grouped = overlap_groups(spans.where(is_long), ["chromosome"], p.cluster_buffer)
    ids = grouped.select("clusterID", locus_id(F.col("chromosome"), F.col("group_start"), F.col("group_end")).alias("identifier"))
    if not p.pooled:
        ids = ids.unionByName(spans.where(~is_long).select("clusterID", locus_id(F.col("chromosome"), F.col("start"), F.col("end")).alias("identifier")))
    return scored.join(ids, "clusterID")


def cluster_windows(scored: DataFrame, p: Params) -> DataFrame:
    length, step = W.window_shape(p.phase)
    return W.with_combined(W.scoring_windows(scored, "clusterID", "pval_corr_f", "pval_corr_r", length, step, p.least_length))


def feature_table(scored: DataFrame, p: Params) -> DataFrame:
    """One row per cluster: features, scores, ambiguity and crowding of the peak."""
    c = "clusterID"
    positions = FE.phase_positions(scored, c, p.phase)
    spans = scored.groupBy(c).agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    scan = saved(H.howell_scan(positions, spans, c, p.phase), "scan")
    peaks = scan.groupBy(c).agg(F.max("score").alias("Peak_Howell_score"), F.max("strict_score").alias("Peak_Howell_score_strict"))
    ambiguity = H.peak_ambiguity(positions, scan, c, p.phase)
    ambiguity = ambiguity.select(c, F.col("exact_support").alias("Howell_exact_support_score"), *(F.col(n).alias(f"Howell_{n}") for n in ambiguity.columns[4:]))
    crowd = H.crowding(H.howell_trace(positions, c, p.phase), c, p.phase)
    crowd = crowd.select(c, F.col("crowding_windows").cast("double").alias("Howell_crowding_window_count"), F.col("crowding_best").alias("Howell_crowding_best_score"), F.col("crowding_gap").alias("Howell_crowding_score_gap"))
    scores = W.cluster_scores(cluster_windows(scored, p), c, "combined_window_p_value")
    names = scored.groupBy(c).agg(F.min("identifier").alias("identifier"), F.min("alib").alias("alib"))
    out = names.join(FE.cluster_features(scored, c, p.phase).drop("start", "end"), c)
    for part in (scores, peaks, ambiguity, crowd):
        out = out.join(part, c, "left")
    return out.withColumnRenamed(c, "cID").fillna({"phase_score": 0.0, "combined_fishers": 1.0})


def calls(features: DataFrame, p: Params, overrides: DataFrame | None = None) -> DataFrame:
    """``features`` with ``label``, ``final_class`` and ``evidence_reason``.

    :func:`feature_table` does not compute the two columns on overlapping alternatives. Without them (they are null then,
    and a warning says so) the rule ``weak_scaffold_alternative_context`` has three of its five contexts, so a cluster
    with a peak of 20 to 30, weak support and overlapping alternatives alone stays ``PHAS`` where it should be
    ``PHAS-like``.
    """
    absent = [n for n in _ALTERNATIVES if n not in features.columns]
    if absent and not p.legacy:
        warnings.warn(f"{', '.join(absent)} not given: clusters of weak support may be PHAS in place of PHAS-like", stacklevel=2)
    rows = CL.mixture_labels(features)
    label = CL.filtered_label(F.col("label"), W.score_cutoff(p.phase, p.score_cutoff), p.least_peak, p.most_complexity)
    rows = rows.withColumn("label", label)
    for name in absent:
        rows = rows.withColumn(name, F.lit(None).cast("double"))
    if p.legacy:
        rows = rows.withColumn("final_class", F.col("label")).withColumn("evidence_reason", F.lit("legacy_classification"))
    else:
        rows = rows.withColumn("__e", CL.evidence(F.col("label"))).select("*", "__e.*").drop("__e")
    return CL.with_overrides(rows, overrides) if overrides is not None else rows


def classify(scored: DataFrame, p: Params, overrides: DataFrame | None = None) -> DataFrame:
    """Calls of all clusters of one or many libraries."""
    return calls(saved(feature_table(saved(identified(scored, p), "identified"), p), "features"), p, overrides)


def result_tables(called: DataFrame) -> dict[str, DataFrame]:
    """The outputs of a classification: all clusters, the calls by class, and what decided each class."""
    evidence = [c for c in ("identifier", "cID", "alib", "label", "final_class", "evidence_reason") if c in called.columns]
    scores = [c for c in called.columns if c.startswith(("Howell_", "Peak_"))]
    return {
        "calls": called, "phas_calls": called.where("final_class = 'PHAS'"), "phas_like_calls": called.where("final_class = 'PHAS-like'"),
        "classification_evidence": called.select(*evidence, *scores, *(c for c in ("complexity", "phase_score") if c in called.columns)),
    }


def compare_calls(a: DataFrame, b: DataFrame, buffer: int = 0, prefer: str = "auto", labels: tuple[str, str] = ("run_a", "run_b")) -> dict[str, DataFrame]:
    """The bundle of two runs' tables of calls: combined loci by category, their sources, overlaps, kept rows and summary.

    Only PHAS calls take part. The tables must have the same columns; labels must differ and not be blank.
    """
    if buffer < 0 or len({name.strip() for name in labels} - {""}) < 2:
        raise ValueError("the buffer must not be negative, and both labels must be there and differ")
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"the tables differ in columns: {sorted(set(a.columns) ^ set(b.columns))}")
    run, keys = ["run"], ["run", "chromosome"]
    pooled = [bool(df.agg(F.coalesce(F.bool_and(F.col("alib") == "ALL_LIBS"), F.lit(False))).first()[0]) for df in (a, b)]
    chosen = CP.preferred_run(prefer, *pooled)

    def loci(df: DataFrame) -> DataFrame:
        contig, start, end = locus_parts(F.col("identifier"))
        return df.where("final_class = 'PHAS'").select(F.lit(1).alias("run"), contig.alias("chromosome"), "identifier", start.alias("start"), end.alias("end")).dropna().distinct()

    mine, theirs = saved(loci(a), "loci-a"), saved(loci(b), "loci-b")
    pairs = saved(CP.run_overlaps(mine, theirs, keys, buffer), "pairs")
    sources = saved(CP.source_map(mine, theirs, pairs, run, chosen), "sources")
    named = F.when(F.col("source_run") == "run_a", labels[0]).otherwise(labels[1])
    combined = CP.combined_rows(sources, run).drop("run")
    summary = CP.comparison_summary(mine, theirs, pairs, sources, run).drop("run")
    facts = {"label_a": labels[0], "label_b": labels[1], "mode_a": _mode(pooled[0]), "mode_b": _mode(pooled[1]), "preferred_run": chosen, "overlap_buffer": buffer}
    phas = lambda df: df.where("final_class = 'PHAS'").withColumn("run", F.lit(1))
    only = {f"{c}_loci": combined.where(F.col("category") == c) for c in ("shared", "run_a_only", "run_b_only")}
    return {
        "combined": combined, **only, "source_locus_map": sources.drop("run").withColumn("source_label", named), "overlaps": CP.overlap_shapes(pairs, run).drop("run"),
        "calls": CP.canonical_rows(phas(a), phas(b), sources, run).drop("run"), "summary": summary.withColumns({n: F.lit(v) for n, v in facts.items()}),
    }


def _mode(pooled: bool) -> str:
    return "pooled" if pooled else "non-pooled"


def compare(a: DataFrame, b: DataFrame, keys: list[str], buffer: int = 0, prefer: str = "run_a") -> dict[str, DataFrame]:
    """Overlaps of two runs with their shapes, and the union that keeps the preferred run's loci."""
    if prefer not in ("run_a", "run_b"):
        raise ValueError("prefer run_a or run_b")
    pairs = CP.run_overlaps(a, b, keys, buffer)
    run = [k for k in keys if k != "chromosome"]
    first, second, other = (a, b, "id_b") if prefer == "run_a" else (b, a, "id_a")
    return {"overlaps": CP.overlap_shapes(pairs, run), "combined": CP.combined_loci(first, second, pairs, run, other)}
