import gzip
import os
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from locusloom.functions.sequences import read_verdict
from locusloom.plans.common import reads
from locusloom.plans.sources import QUERIES
from locusloom.sources import alignments as AL
from locusloom.sources import reads as RD
from locusloom.sources import sinks as SK
from locusloom.sources.lines import numbered_lines

DATA = Path(os.environ.get("LOCUSLOOM_TEST_DATA", "/root/testdata/sf0.001"))


def fastq(seqs):
    return "".join(f"@r{i}\n{s}\n+\n{'I' * len(s)}\n" for i, s in enumerate(seqs))


@pytest.mark.parametrize("name", ["a.fastq", "a.fq.gz"])
def test_fastq(spark, tmp_path, name):
    text = fastq(["A" * 21, "C" * 24, "A" * 21, "G" * 17, "T" * 36, "A" * 20 + "R"])
    path = tmp_path / name
    (gzip.open if name.endswith("gz") else open)(path, "wt").write(text)
    records = RD.read_fastq(spark, str(path))
    assert {r.tag_seq: r.abun for r in RD.clean_fastq(records).collect()} == {"A" * 21: 2, "C" * 24: 1}
    assert {r[0] for r in records.where("problem is not null").collect()} == set()
    assert RD.sniff(spark, str(path)) == "fastq" and not RD.looks_raw(spark, str(path))


def test_broken_fastq(spark, tmp_path):
    (tmp_path / "b.fastq").write_text("@read\nACGT\n+\n")
    with pytest.raises(PySparkException, match="incomplete"):
        RD.clean_fastq(RD.read_fastq(spark, str(tmp_path / "b.fastq"))).collect()
    assert RD.clean_fastq(RD.read_fastq(spark, str(tmp_path / "b.fastq")), strict=False).count() == 0


def test_raw_reads_are_seen(spark, tmp_path):
    (tmp_path / "raw.fastq").write_text(fastq(["A" * 76] * 4))
    assert RD.looks_raw(spark, str(tmp_path / "raw.fastq"))


def test_lines_keep_their_numbers_over_splits(spark, tmp_path):
    (tmp_path / "n.txt").write_text("".join(f"{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = numbered_lines(spark, str(tmp_path / "n.txt"))
        assert rows.where("line_no <> cast(value as long)").count() == 0 and rows.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_verdicts(spark):
    rows = [("A" * 21,), ("  acgt" + "a" * 17,), ("ACGTN" + "A" * 20,), ("A" * 20 + "NAA",), ("A" * 17,), (None,), ("",)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(read_verdict(F.col("s"))).collect()]
    assert got == ["retained", "retained", "rejected_length", "rejected_ambiguous", "rejected_length", None, "rejected_length"]


def test_reference_and_counted_fasta(spark, tmp_path):
    (tmp_path / "r.fa").write_text(">chr01 first\n" + "A" * 120 + "\n" + "C" * 120 + "\n>short\nACGT\n")
    assert [(r.old_id, r.len) for r in RD.read_reference(spark, str(tmp_path / "r.fa")).collect()] == [("chr01", 240)]
    tags = spark.createDataFrame([("seq_1", "ACGT", 3), ("seq_2", "GGG", 1)], "tag_id string, tag_seq string, abun long")
    SK.write_lines(SK.counted_fasta(tags), str(tmp_path / "c"))
    assert sorted(map(tuple, RD.read_counted_fasta(spark, str(tmp_path / "c")).collect())) == [("seq_1", "ACGT", 3), ("seq_2", "GGG", 1)]
    (tmp_path / "bad.fa").write_text(">nocount\nACGT\n")
    with pytest.raises(PySparkException, match="malformed"):
        RD.read_counted_fasta(spark, str(tmp_path / "bad.fa")).collect()


def test_sam_fields(spark):
    line = lambda flag, nh, xm: "\t".join(["t|7", flag, "chr1", "100", "255", "4M", "*", "0", "0", "ACGT", "IIII", "AS:i:0", f"XM:i:{xm}", f"NH:i:{nh}"])
    lines = [("@SQ\tx",), (line("0", 2, 0),), (line("272", 25, 0),), (line("4", 1, 0),), (line("16", 1, 1),), ("x\t0\tc\tz\t0\t*\t*\t0\t0\tA\tI",)]
    got = AL.parse_sam(spark.createDataFrame(lines, "value string"))
    assert sorted((r.strand, r.hits, r.mismatches, r.abun) for r in got.collect()) == [("c", 1, 1, 7), ("c", 25, 0, 7), ("w", 2, 0, 7)]
    assert AL.usable_alignments(got).count() == 1


def test_mismatch_and_hit_limits(spark):
    rows = [(h, m) for h in (1, 2, 3, 24, 25) for m in (0, 1, 2)]
    df = spark.createDataFrame(rows, "hits int, mismatches int")
    kept = lambda *limits: sorted((r.hits, r.mismatches) for r in AL.usable_alignments(df, *limits).collect())
    assert kept() == [(1, 0), (2, 0), (3, 0), (24, 0)]
    assert kept(3, 1) == [(1, 0), (1, 1), (2, 0), (2, 1)]


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
def test_sam_reads_the_whole_table_back(spark):
    every = reads(spark, str(DATA)).where("tag_seq is not null and abun is not null and hits is not null and strand is not null and tag_id is not null")
    want = every.agg(F.count(F.lit(1)), F.sum("abun"), F.max("hits")).head()
    got = QUERIES["s9_sam_round_trip"](spark, str(DATA)).agg(F.sum("n"), F.sum("abun"), F.max("hits")).head()
    assert every.where("hits % 2 = 1").count() > 0 and tuple(got) == tuple(want)


def test_annotations(spark):
    gff = [("#x",), ("1\ts\tg\t11\t20\t.\t+\t.\tID=a;Name=b",), ("1\ts\tg\tx\t20\t.\t+\t.\tID=a",), ('2\ts\tg\t5\t6\t.\t+\t.\tgene_id "q"; x "y"',)]
    assert [tuple(r) for r in AL.parse_annotation(spark.createDataFrame(gff, "value string"), "gff").collect()] == [("1", 10, 20, "a"), ("2", 4, 6, "q")]
    bed = [("1\t10\t20\tn",), ("1\t10",), ("2\t3\t4",)]
    assert [tuple(r) for r in AL.parse_annotation(spark.createDataFrame(bed, "value string"), "bed").collect()] == [("1", 10, 20, "n"), ("2", 3, 4, "2:3-4")]


def test_cluster_files(spark, tmp_path):
    row = lambda p, t: "\t".join(["001", "w", str(p), "21", "1", "10", *["0.1", "3", "2", "0.1", "0.1"] * 2, t, "NA"])
    (tmp_path / "alpha.21-PHAS.candidate.clusters").write_text(f">cluster = B\n{row(200, 'a')}\nshort\trow\n>cluster = A\n{row(120, 'b')}\n{row(100, 'c')}\n")
    got = AL.read_cluster_blocks(spark, str(tmp_path)).orderBy("clusterID", "pos").collect()
    assert [(r.alib, r.clusterID, r.chromosome, r.pos, r.tag_seq) for r in got] == [("alpha", "A", "001", 100, "NA"), ("alpha", "A", "001", 120, "NA"), ("alpha", "B", "001", 200, "NA")]


def test_result_table_header(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("a\tb\n001\tNA\n")
    assert [tuple(r) for r in AL.read_result_table(spark, str(tmp_path / "t.tsv"), ["a"]).collect()] == [("001", "NA")]
    with pytest.raises(ValueError):
        AL.read_result_table(spark, str(tmp_path / "t.tsv"), ["c"])
