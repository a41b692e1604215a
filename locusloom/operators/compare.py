"""Comparison of two runs' loci, and matching of calls with known loci."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusloom.functions.loci import overlap_nt
from locusloom.operators.overlaps import overlap_join


def run_overlaps(a: DataFrame, b: DataFrame, keys: Sequence[str], buffer: int = 0) -> DataFrame:
    """Overlapping loci of both runs: ``id_a``, ``id_b``, their ends and ``overlap_nt`` (0 within the buffer only)."""
    pairs = overlap_join(a.withColumnRenamed("identifier", "id_a"), b.withColumnRenamed("identifier", "id_b"), keys, buffer)
    return pairs.withColumn("overlap_nt", overlap_nt(F.col("start_a"), F.col("end_a"), F.col("start_b"), F.col("end_b")))


def overlap_shapes(pairs: DataFrame, run: Sequence[str]) -> DataFrame:
    """``pairs`` with the partners of either side and the shape of the relationship.

    Partners are counted per side and joined back, so no window gathers the pairs of one comparison.
    """
    by_a = pairs.groupBy(*run, "id_a").agg(F.count(F.lit(1)).alias("matches_a"))
    by_b = pairs.groupBy(*run, "id_b").agg(F.count(F.lit(1)).alias("matches_b"))
    many_a, many_b = F.col("matches_a") > 1, F.col("matches_b") > 1
    shape = F.when(many_a & many_b, "many_to_many").when(many_a, "run_a_one_to_many_run_b").when(many_b, "run_a_many_to_one_run_b").otherwise("one_to_one")
    return pairs.join(by_a, [*run, "id_a"]).join(by_b, [*run, "id_b"]).withColumn("shape", shape)


def combined_loci(preferred: DataFrame, other: DataFrame, pairs: DataFrame, run: Sequence[str], other_id: str) -> DataFrame:
    """Union without duplicates: all loci of the preferred run, and those of the other that overlap none of them."""
    matched = pairs.select(*run, F.col(other_id).alias("identifier")).distinct()
    alone = other.join(matched, [*run, "identifier"], "left_anti")
    return preferred.withColumn("origin", F.lit("preferred")).unionByName(alone.withColumn("origin", F.lit("other_only")))


_RUNS = ("run_a", "run_b")


def preferred_run(prefer: str, pooled_a: bool, pooled_b: bool) -> str:
    """``run_a`` or ``run_b`` as given; with ``auto`` the run that is not pooled, and the first one if both are alike."""
    asked = prefer.strip().lower().replace("-", "_")
    named = {"a": "run_a", "run_a": "run_a", "b": "run_b", "run_b": "run_b"}
    if asked == "auto":
        return "run_b" if pooled_a and not pooled_b else "run_a"
    if asked not in named:
        raise ValueError("prefer auto, run_a or run_b")
    return named[asked]


def source_map(a: DataFrame, b: DataFrame, pairs: DataFrame, run: Sequence[str], prefer: str = "run_a") -> DataFrame:
    """One row for each combined locus and each locus behind it: itself, and those of the other run that overlap it.

    ``a`` and ``b`` have ``run``, ``chromosome``, ``identifier``, ``start`` and ``end``; ``pairs`` are their overlaps as
    :func:`run_overlaps` gives them. All loci of the preferred run are combined loci, and those of the other run that
    overlap none. ``category`` is ``shared``, ``run_a_only`` or ``run_b_only``; ``overlap_nt`` counts shared positions.
    """
    first, second = (a, b) if prefer == "run_a" else (b, a)
    mine, theirs = ("a", "b") if prefer == "run_a" else ("b", "a")
    other = _RUNS[1 - _RUNS.index(prefer)]
    run = list(run)
    combined = [F.col(f"{c}_{mine}").alias(f"combined_{c}") for c in ("id", "start", "end")]
    support = pairs.select(
        *run, "chromosome", *combined, F.lit("shared").alias("category"), F.lit(other).alias("source_run"),
        *(F.col(f"{c}_{theirs}").alias(f"source_{c}") for c in ("id", "start", "end")), F.lit(False).alias("is_representative"), "overlap_nt",
    )

    def alone(loci: DataFrame, side: str, name: str) -> DataFrame:
        met = pairs.select(*run, F.col(f"id_{side}").alias("identifier")).distinct().withColumn("__met", F.lit(True))
        rows = loci.join(met, [*run, "identifier"], "left")
        place = {"id": "identifier", "start": "start", "end": "end"}
        return rows.select(
            *run, "chromosome", *(F.col(v).alias(f"combined_{c}") for c, v in place.items()), F.when(F.col("__met"), "shared").otherwise(f"{name}_only").alias("category"),
            F.lit(name).alias("source_run"), *(F.col(v).alias(f"source_{c}") for c, v in place.items()), F.lit(True).alias("is_representative"), (F.col("end") - F.col("start") + 1).alias("overlap_nt"),
        )

    rest = alone(second, theirs, other).where("category <> 'shared'")
    return alone(first, mine, prefer).unionByName(rest).unionByName(support)


def combined_rows(sources: DataFrame, run: Sequence[str]) -> DataFrame:
    """The combined loci of a :func:`source_map`, with how many loci of each run stand behind them."""
    keys = [*run, "chromosome", "combined_id", "combined_start", "combined_end", "category"]
    counts = (F.count_if(F.col("source_run") == r).alias(f"{r}_loci") for r in _RUNS)
    return sources.groupBy(*keys).agg(F.max(F.when(F.col("is_representative"), F.col("source_run"))).alias("representative_run"), *counts)


def comparison_summary(a: DataFrame, b: DataFrame, pairs: DataFrame, sources: DataFrame, run: Sequence[str]) -> DataFrame:
    """Per comparison: loci of both runs, overlapping pairs, combined loci by category, and how many loci were collapsed."""
    run = list(run)
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    count = lambda rows, name: rows.groupBy(*run).agg(F.count(F.lit(1)).alias(name))
    kept = sources.where("is_representative").groupBy(*run).agg(
        F.count(F.lit(1)).alias("combined_loci"), *(F.count_if(F.col("category") == c).alias(f"{c}_loci") for c in ("shared", "run_a_only", "run_b_only"))
    )
    out = kept.join(count(a, "input_loci_a"), run, "left").join(count(b, "input_loci_b"), run, "left").join(count(pairs, "overlap_pairs"), run, "left")
    out = out.select(*run, *(zero(c) for c in ("input_loci_a", "input_loci_b", "overlap_pairs")), "shared_loci", "run_a_only_loci", "run_b_only_loci", "combined_loci")
    return out.withColumn("collapsed_source_loci", F.col("input_loci_a") + F.col("input_loci_b") - F.col("combined_loci"))


def canonical_rows(table_a: DataFrame, table_b: DataFrame, sources: DataFrame, run: Sequence[str]) -> DataFrame:
    """Rows of both runs' tables (of one schema, with ``identifier``) whose locus stands for a combined one, with ``source_run``."""
    if sorted(table_a.columns) != sorted(table_b.columns):
        raise ValueError(f"the tables differ in columns: {sorted(set(table_a.columns) ^ set(table_b.columns))}")
    chosen = sources.where("is_representative").select(*run, "source_run", F.col("source_id").alias("identifier")).distinct()
    both = table_a.withColumn("source_run", F.lit("run_a")).unionByName(table_b.withColumn("source_run", F.lit("run_b")))
    return both.join(chosen, [*run, "source_run", "identifier"], "left_semi")


def share(a: Column, b: Column) -> Column:
    """``a / (a + b)``, 0 where both are 0."""
    return F.coalesce(F.try_divide(a, a + b), F.lit(0.0))


def harmonic(p: Column, r: Column) -> Column:
    return F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))


def match_calls(calls: DataFrame, truth: DataFrame, keys: Sequence[str], flank: int) -> DataFrame:
    """``TP`` rows of calls within ``flank`` of a known locus, ``FP`` rows of the other calls, ``FN`` rows of loci not met.

    Both sides have ``keys``, ``identifier``, ``start`` and ``end``; a locus is its place, whatever it is called.
    """
    keys = list(keys)
    a = calls.select(*keys, F.col("identifier").alias("id_a"), "start", "end").distinct()
    b = truth.select(*keys, F.col("identifier").alias("id_b"), "start", "end").distinct()
    met = overlap_join(a.withColumn("start", F.greatest(F.col("start") - flank, F.lit(0))).withColumn("end", F.col("end") + flank), b, keys)
    met = met.select(*keys, "id_a", (F.col("start_a")).alias("__qs"), F.col("end_a").alias("__qe"), "id_b", "start_b", "end_b")
    tp = met.select(*keys, F.lit("TP").alias("status"), "id_a", "id_b", "start_b", "end_b")
    fp = a.join(met.select(*keys, "id_a").distinct(), [*keys, "id_a"], "left_anti").select(*keys, F.lit("FP").alias("status"), "id_a", *(F.lit(None).cast(t).alias(n) for n, t in (("id_b", "string"), ("start_b", "long"), ("end_b", "long"))))
    fn = b.withColumnsRenamed({"start": "start_b", "end": "end_b"}).join(met.select(*keys, "start_b", "end_b").distinct(), [*keys, "start_b", "end_b"], "left_anti")
    fn = fn.select(*keys, F.lit("FN").alias("status"), F.lit(None).cast("string").alias("id_a"), "id_b", "start_b", "end_b")
    return tp.unionByName(fp).unionByName(fn)


def match_metrics(matches: DataFrame, run: Sequence[str], contig: str) -> DataFrame:
    """Precision, recall and F1 by call and by known locus, per run."""
    is_ = lambda s: F.col("status") == s
    place = F.struct(contig, "start_b", "end_b")
    out = matches.groupBy(*run).agg(
        F.count_distinct(F.when(is_("TP"), F.col("id_a"))).alias("tp_ids"),
        F.count_distinct("id_a").alias("all_ids"),
        F.count_distinct(F.when(is_("TP"), place)).alias("tp_ref"),
        F.count_distinct(F.when(is_("FN"), place)).alias("fn_ref"),
    )
    out = out.withColumn("fp_ids", F.col("all_ids") - F.col("tp_ids"))
    out = out.withColumn("precision_id", share(F.col("tp_ids"), F.col("fp_ids"))).withColumn("recall_id", share(F.col("tp_ids"), F.col("fn_ref")))
    out = out.withColumn("precision_ref", share(F.col("tp_ref"), F.col("fp_ids"))).withColumn("recall_ref", share(F.col("tp_ref"), F.col("fn_ref")))
    return out.withColumn("f1_id", harmonic(F.col("precision_id"), F.col("recall_id"))).withColumn("f1_ref", harmonic(F.col("precision_ref"), F.col("recall_ref"))).drop("all_ids")
