import random
import warnings

import pytest
from pyspark.sql import functions as F

from locusloom.__main__ import main
from locusloom.config import Params
from locusloom.plans import pipeline


def alignment(name, strand, contig, pos, seq, hits):
    return "\t".join([name, "0" if strand == "w" else "16", contig, str(pos), "255", f"{len(seq)}M", "*", "0", "0", seq, "*", "AS:i:0", "XM:i:0", f"NH:i:{hits}"])


def library(path, seed):
    """A phased locus, a scattered one, and stray reads."""
    rng = random.Random(seed)
    tag = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    lines = ["@HD\tVN:1.0"]
    for cycle in range(20):
        for pos, strand, abun in ((1000 + 21 * cycle, "w", 40 + cycle), (998 + 21 * cycle, "c", 30)):
            lines.append(alignment(f"s{cycle}|{abun}", strand, "chr1", pos, tag(21), 1))
    for n in (19, 20, 22, 23, 24):
        lines.append(alignment("o|2", "w", "chr1", 1010 + n, tag(n), 1))
    for _ in range(60):
        lines.append(alignment("r|3", rng.choice("wc"), "chr1", 9000 + rng.randrange(450), tag(rng.choice([20, 21, 21, 22, 23, 24])), rng.choice([1, 2, 9])))
    lines += [alignment("far|1", "w", "chr2", 5, tag(21), 1), alignment("many|1", "w", "chr1", 1005, tag(21), 25), "broken"]
    path.write_text("\n".join(lines) + "\n")


def _truth(folder):
    (folder / "truth.bed").write_text("chr1\t1000\t1100\tt1\nchr5\t1\t9\tt2\n")
    return folder / "truth.bed"


def test_from_alignments_to_calls(spark, tmp_path):
    for i, name in enumerate(("libA", "libB")):
        library(tmp_path / f"{name}.sam", i)
    main(["find", str(tmp_path / "libA.sam"), str(tmp_path / "libB.sam"), "--out", str(tmp_path / "f")], spark)
    scored = spark.read.parquet(str(tmp_path / "f/scored"))
    assert {r.alib for r in scored.select("alib").distinct().collect()} == {"libA", "libB"}
    phased = scored.where("pos = 1000 and strand = 'w'")
    assert phased.count() == 2 and phased.where("pval_h_f < 1e-6 and N_f >= 28").count() == 2
    assert scored.where("hits >= 25").count() == 0

    main(["classify", str(tmp_path / "f/scored"), "--out", str(tmp_path / "c"), "--score-cutoff", "1"], spark)
    calls = spark.read.parquet(str(tmp_path / "c/calls"))
    best = calls.where("Peak_Howell_score > 20").collect()
    assert {r.alib for r in best} == {"libA", "libB"} and len({r.identifier for r in best}) == 1
    assert all(r.Howell_origin_class is not None for r in best)

    # two libraries are too few for the mixture: the phased locus is named PHAS here
    named = str(tmp_path / "named")
    calls.withColumn("final_class", F.when(F.col("Peak_Howell_score") > 20, "PHAS").otherwise("non-PHAS")).write.parquet(named)
    calls = spark.read.parquet(named)
    main(["compare", named, named, "--out", str(tmp_path / "m")], spark)
    combined = spark.read.parquet(str(tmp_path / "m/combined"))
    phas = calls.where("final_class = 'PHAS'").select("identifier").distinct().count()
    assert phas and combined.count() == combined.where("category = 'shared' and representative_run = 'run_a'").count() == phas
    assert spark.read.parquet(str(tmp_path / "m/run_b_only_loci")).count() == 0
    summary = spark.read.parquet(str(tmp_path / "m/summary")).first()
    assert (summary.shared_loci, summary.collapsed_source_loci, summary.mode_a, summary.preferred_run) == (phas, phas, "non-pooled", "run_a")
    kept = spark.read.parquet(str(tmp_path / "m/calls"))
    assert set(kept.columns) == {*calls.columns, "source_run"} and kept.where("source_run <> 'run_a'").count() == 0
    assert spark.read.parquet(str(tmp_path / "c/classification_evidence")).count() == calls.count()
    with pytest.raises(ValueError):
        main(["compare", named, named, "--out", f"{named}/x"], spark)
    with pytest.raises(ValueError):
        pipeline.compare_calls(calls, calls.drop("complexity"))
    (tmp_path / "calls.tsv").write_text("identifier\talib\tachr\tstart\tend\nx\tl\tchr1\t1000\t1100\nbad\tl\tchr1\tno\t5\n")
    main(["match", str(tmp_path / "calls.tsv"), str(_truth(tmp_path)), "--out", str(tmp_path / "t2"), "--text-calls"], spark)
    assert {r.status for r in spark.read.parquet(str(tmp_path / "t2/matches")).collect()} == {"TP", "FN"}
    main(["match", str(tmp_path / "c/calls"), str(_truth(tmp_path)), "--out", str(tmp_path / "t"), "--text"], spark)


def test_pooled_and_normalised(spark):
    rows = [("a", "1", "w", p, 21, 1, 0, 10, "t", "ACGT") for p in (1, 2)] + [("b", "1", "w", 3, 21, 1, 0, 30, "t", "ACGT"), ("b", "1", "w", 3, 21, 30, 0, 30, "t", "ACGT")]
    df = spark.createDataFrame(rows, "alib string, chromosome string, strand string, pos long, len int, hits int, mismatches int, abun long, tag_id string, tag_seq string")
    pooled = pipeline.prepared(df, Params(pooled=True, normalise=True, norm_factor=80))
    assert sorted((r.alib, r.abun) for r in pooled.collect()) == [("ALL_LIBS", 10), ("ALL_LIBS", 10), ("ALL_LIBS", 30)]
    alone = pipeline.prepared(df, Params(normalise=True, norm_factor=20))
    assert sorted((r.alib, r.abun) for r in alone.collect()) == [("a", 10), ("a", 10), ("b", 10)]


def test_least_depth(spark):
    rows = [(a, "1", "w", 1, 21, 1, 0, n, "t", "ACGT") for a, n in (("a", 1), ("a", 2), ("b", 3), ("b", 1))]
    df = spark.createDataFrame(rows, "alib string, chromosome string, strand string, pos long, len int, hits int, mismatches int, abun long, tag_id string, tag_seq string")
    depths = lambda **given: sorted((r.alib, r.abun) for r in pipeline.prepared(df, Params(**given)).collect())
    assert depths() == [("a", 1), ("a", 2), ("b", 1), ("b", 3)]
    assert depths(min_depth=2) == [("a", 2), ("b", 3)]
    assert depths(min_depth=2, normalise=True, norm_factor=10) == [("a", 10), ("b", 10)]  # of what is left
    assert depths(min_depth=3, pooled=True) == [("ALL_LIBS", 3)]


def test_absent_alternatives_are_told(spark):
    names = ("complexity", "strand_bias", "log_clust_len_norm_counts", "ratio_abund_len_phase", "phase_score", "Peak_Howell_score")
    more = {"Peak_Howell_score_strict": 25.0, "Howell_exact_support_score": 5.0, "Howell_crowding_window_count": 0.0}
    rows = [(f"i{i}", "l", *(0.1, 0.5, 2.0, 3.0, 200.0 + i, 25.0)) for i in range(6)] + [(f"j{i}", "l", *(0.2, 0.4, 0.1, 0.2, 1.0 + i, 1.0)) for i in range(6)]
    df = spark.createDataFrame(rows, "identifier string, alib string, " + ", ".join(f"{n} double" for n in names)).withColumns({n: F.lit(v) for n, v in more.items()})
    df = df.withColumn("Howell_origin_class", F.lit("unique_origin"))
    with pytest.warns(UserWarning, match="Howell_overlapping_alt_count"):
        pipeline.calls(df, Params())
    given = df.withColumns({"Howell_overlapping_alt_count": F.lit(2.0), "Howell_overlapping_alt_best_score": F.lit(10.0)})
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        pipeline.calls(given, Params())


def test_legacy_labels(spark):
    names = ("complexity", "strand_bias", "log_clust_len_norm_counts", "ratio_abund_len_phase", "phase_score", "Peak_Howell_score")
    rows = [(f"i{i}", "l", *(0.1, 0.5, 2.0, 3.0, 200.0 + i, 30.0)) for i in range(6)] + [(f"j{i}", "l", *(0.2, 0.4, 0.1, 0.2, 1.0 + i, 1.0)) for i in range(6)]
    df = spark.createDataFrame(rows, "identifier string, alib string, " + ", ".join(f"{n} double" for n in names))
    got = pipeline.calls(df, Params(legacy=True))
    assert {r.identifier[0]: r.final_class for r in got.select("identifier", "final_class").collect()} == {"i": "PHAS", "j": "non-PHAS"}
    assert got.where(F.col("evidence_reason") != "legacy_classification").count() == 0
