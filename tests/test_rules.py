import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from locusloom.functions import loci as L
from locusloom.operators import clusters as C
from locusloom.operators.classify import evidence, filtered_label, with_overrides
from locusloom.operators.compare import combined_loci, combined_rows, overlap_shapes, preferred_run, run_overlaps, source_map
from locusloom.operators.contigs import numbered_contigs
from locusloom.operators.numbering import absent_cell, dense_cells
from locusloom.operators.windows import score_cutoff, scoring_windows, window_shape

ROW = {
    "label": "PHAS", "Howell_exact_support_score": 18.0, "Peak_Howell_score": 20.0, "Peak_Howell_score_strict": 10.1, "Howell_origin_class": "coherent_extension",
    "Howell_crowding_window_count": 0.0, "Howell_overlapping_alt_count": 0.0, "Howell_overlapping_alt_best_score": None, "complexity": 0.05, "phase_score": 300.0,
}
CASES = [
    ({}, "PHAS", "pass"), ({"label": "non-PHAS"}, "non-PHAS", "classifier_non_phas"), ({"Howell_exact_support_score": 0.0}, "non-PHAS", "insufficient_exact_support"),
    ({"Howell_exact_support_score": None}, "non-PHAS", "insufficient_exact_support"), ({"Howell_exact_support_score": float("nan")}, "non-PHAS", "insufficient_exact_support"),
    ({"Howell_exact_support_score": 4.9}, "PHAS-like", "weak_exact_support"), ({"Howell_exact_support_score": 5.0, "Peak_Howell_score": 35.0}, "PHAS", "pass"),
    ({"Peak_Howell_score": 15.0, "Howell_crowding_window_count": 5.0}, "PHAS-like", "low_score_crowded_window_context"),
    ({"Howell_origin_class": "ambiguous_origin"}, "PHAS", "pass"),
    ({"Peak_Howell_score": 29.0, "Peak_Howell_score_strict": 5.0, "complexity": 0.2}, "PHAS-like", "weak_scaffold_alternative_context"),
    ({"Peak_Howell_score": 30.0, "Peak_Howell_score_strict": 5.0, "complexity": 0.2}, "PHAS", "pass"),
]


def test_evidence_rules(spark):
    names = list(ROW)
    schema = ", ".join(f"{n} {'string' if n in ('label', 'Howell_origin_class') else 'double'}" for n in names) + ", i int"
    rows = [(*({**ROW, **change}[n] for n in names), i) for i, (change, _, _) in enumerate(CASES)]
    got = spark.createDataFrame(rows, schema).select("i", evidence(F.col("label")).alias("e")).orderBy("i").collect()
    assert [(r.e.final_class, r.e.evidence_reason) for r in got] == [(c, reason) for _, c, reason in CASES]


def test_filters_ignore_missing_values(spark):
    rows = [(49.9, 20.0, 0.1), (50.0, 12.4, 0.1), (50.0, 12.5, 0.31), (50.0, 12.5, 0.3), (float("nan"), None, float("nan"))]
    df = spark.createDataFrame(rows, "phase_score double, Peak_Howell_score double, complexity double")
    assert [r[0] for r in df.select(filtered_label(F.lit("PHAS"), 50.0, 12.5, 0.3)).collect()] == ["non-PHAS"] * 3 + ["PHAS"] * 2


def test_overrides(spark):
    calls = spark.createDataFrame([("i", "l", "PHAS", "pass"), ("j", "l", "PHAS", "pass")], "identifier string, alib string, final_class string, evidence_reason string")
    named = lambda *rows: spark.createDataFrame(rows, "identifier string, alib string, final_class string")
    got = {r.identifier: (r.final_class, r.evidence_reason) for r in with_overrides(calls, named(("i", "l", " Phas_Like "))).collect()}
    assert got == {"i": ("PHAS-like", "manual_override"), "j": ("PHAS", "pass")}
    for bad in (named(("i", "l", "PHAS"), ("i", "l", "non-PHAS")), named(("i", "l", "what")), named(("i", "l", "pass")), named(("i", "l", "1"))):
        with pytest.raises(PySparkException, match="override"):
            with_overrides(calls, bad).collect()


def test_preferred_run_and_source_map(spark):
    assert [preferred_run("auto", *p) for p in ((True, False), (False, True), (True, True))] == ["run_b", "run_a", "run_a"]
    assert preferred_run("B", False, False) == "run_b" and preferred_run("run-a", True, False) == "run_a"
    with pytest.raises(ValueError):
        preferred_run("c", False, False)
    loci = lambda *rows: spark.createDataFrame(rows, "run int, chromosome string, identifier string, start long, end long")
    a, b = loci((1, "1", "A", 10, 50), (1, "1", "B", 100, 120)), loci((1, "1", "x", 40, 60), (1, "1", "y", 45, 47), (1, "1", "z", 300, 310))
    pairs = run_overlaps(a, b, ["run", "chromosome"])
    rows = {(r.combined_id, r.source_id): (r.category, r.source_run, r.is_representative, r.overlap_nt) for r in source_map(a, b, pairs, ["run"]).collect()}
    assert rows == {
        ("A", "A"): ("shared", "run_a", True, 41), ("A", "x"): ("shared", "run_b", False, 11), ("A", "y"): ("shared", "run_b", False, 3),
        ("B", "B"): ("run_a_only", "run_a", True, 21), ("z", "z"): ("run_b_only", "run_b", True, 11),
    }
    swapped = combined_rows(source_map(a, b, pairs, ["run"], "run_b"), ["run"]).collect()
    assert {(r.combined_id, r.category, r.run_a_loci, r.run_b_loci) for r in swapped} == {("x", "shared", 1, 1), ("y", "shared", 1, 1), ("z", "run_b_only", 0, 1), ("B", "run_a_only", 1, 0)}


def test_dense_cells(spark):
    cells = spark.createDataFrame([("i", "l", 2), ("j", "m", 1)], "row string, col string, cell int")
    every = spark.createDataFrame([("l",), ("m",), ("k",), (None,)], "col string")
    got = {(r.row, r.col): r.cell for r in dense_cells(cells, every, "row", "col", "cell", absent_cell(24)).collect()}
    assert got == {("i", "l"): 2, ("i", "m"): 1, ("i", "k"): 1, ("j", "l"): 1, ("j", "m"): 1, ("j", "k"): 1} and absent_cell(21) == 0


def test_gap_clusters_over_tiles(spark):
    rows = [("l", p, 1) for p in (1, 10, 15, 40, 64, 65, 200, 230, 500)] + [("m", 7, 1)]
    df = spark.createDataFrame(rows, "k string, pos long, n_reads long")
    for tile in (16, 1000):
        got = {(r.k, r.pos): r.cluster_no for r in C.gap_clusters(df, ["k"], 25, tile).collect()}
        assert [got["l", p] for p in (1, 10, 15, 40, 64, 65, 200, 230, 500)] == [1, 1, 1, 1, 1, 1, 2, 3, 4] and got["m", 7] == 1
    assert C.cluster_gap(21, 300) == 300 and C.cluster_gap(21, 5) == 25


def test_windows(spark):
    rows = [("c", p, 0.5, 0.25) for p in range(100, 160, 3)] + [("short", 1, 0.1, 0.1), ("short", 20, 0.1, 0.1)]
    df = spark.createDataFrame(rows, "clusterID string, pos long, f double, r double")
    got = {r.window_n for r in scoring_windows(df, "clusterID", "f", "r", 23, 5, 48).collect()}
    assert got == set(range(1 + (57 - 23) // 5))
    assert window_shape(21) == (23, 5) and window_shape(24) == (26, 8)
    assert score_cutoff(21, 50) == 50 and score_cutoff(24, 50) == 250 and score_cutoff(24, 400) == 300


def test_comparison(spark):
    schema = "r long, chromosome string, identifier string, start long, end long"
    a = spark.createDataFrame([(1, "chr10", "a1", 100, 250), (1, "chr2", "a2", 5000, 5500), (1, "chr1", "a3", 100, 1000)], schema)
    b = spark.createDataFrame([(1, "chr10", "b1", 1000, 1200), (1, "chr1", "b2", 700, 900), (1, "chr2", "b3", 5000, 5500), (1, "chr1", "b4", 120, 300)], schema)
    pairs = run_overlaps(a, b, ["r", "chromosome"])
    assert sorted((r.id_a, r.id_b, r.overlap_nt) for r in pairs.collect()) == [("a2", "b3", 501), ("a3", "b2", 201), ("a3", "b4", 181)]
    assert {(r.id_b, r["shape"]) for r in overlap_shapes(pairs, ["r"]).collect()} == {("b3", "one_to_one"), ("b2", "run_a_one_to_many_run_b"), ("b4", "run_a_one_to_many_run_b")}
    assert {r.identifier for r in combined_loci(b, a, pairs, ["r"], "id_a").collect()} == {"b1", "b2", "b3", "b4", "a1"}


def test_contig_numbers(spark):
    rows = [("chr01", 1), ("Mt", 2), ("2", 3), ("chr1", 4), ("chr0", 5)]
    got = {r.name: r.number for r in numbered_contigs(spark.createDataFrame(rows, "name string, ord int"), "name", "ord").collect()}
    assert got == {"chr01": 1, "2": 2, "Mt": 3, "chr1": 4, "chr0": 5}


def test_small_functions(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("x")).first().x
    assert value(L.phase_shift(F.lit(100), F.lit(121), 21)) is None
    assert value(L.phase_shift(F.lit(100), F.lit(119), 21)) == -2 and value(L.phase_shift(F.lit(100), F.lit(110), 21)) == 10
    assert [value(L.register_relation(F.lit(p), F.lit(100), 21)) for p in (121, 122, 99, 110)] == ["exact", "offset", "offset", "other"]
    assert value(L.file_stem(F.lit("/x/lib.one.fastq.gz"))) == "lib.one"
    assert value(L.per_ten_million(F.lit(0), F.lit(10))) == 1 and value(L.per_ten_million(F.lit(5.0), F.lit(2e7))) == 2
    ids = {
        "ALL_LIBS.21-PHAS.candidate.clustersALL_LIBS-10_120402_10": "10_120402_10", "s.S3.1_Pre_1.21-PHAS.candidate.clusters1006_18": "1006_18", " 1:5..9 ": "1:5..9", " plain-1_2_1": "plain-1_2_1",
        "l.PHAS.candidate.clustersl-7_1": "7_1", "l.m.PHAS.candidate.clusters7_1": "7_1", "l.24-PHAS.candidate.clustersl-7_1": "l.24-PHAS.candidate.clustersl-7_1",
    }
    for given, want in ids.items():
        assert value(L.bare_cluster_id(F.lit(given), 21)) == want, given
    assert value(L.bare_cluster_id(F.lit("a-b.21-PHAS.candidate.clustersa-b-7_1_7"), 21, F.lit("a-b"))) == "7_1_7"
    assert [value(c) for c in L.cluster_parts(F.lit("a_b-scaf_016_12_scaf_016"))] == ["a_b", "scaf_016", 12]
    assert [value(c) for c in L.locus_parts(F.lit("scaf:1:3..9"))] == ["scaf:1", 3, 9] and value(L.locus_parts(F.lit("x"))[1]) is None
    assert value(L.howell_score(F.lit(10.0), F.lit(10.0), F.lit(3))) == 0.0
    names = spark.createDataFrame([("chr10",), ("chr2",), ("Chr1",)], "n string").orderBy(L.natural_key(F.col("n"))).collect()
    assert [r.n for r in names] == ["Chr1", "chr2", "chr10"]
