"""Raw libraries: tag counts, FASTA, FASTQ. Each reader is a parser over lines or records, so that it composes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.functions.sequences import MAX_READ, MIN_READ, chop_at_n, cut_at_n, read_verdict
from locusloom.sources.lines import chunks, numbered_lines


def parse_tag_counts(lines: DataFrame, least: int = 1) -> DataFrame:
    """``tag_seq`` and ``abun`` of ``sequence<TAB>count`` lines with at least ``least`` copies; other lines are skipped."""
    parts = F.split("value", "\t")
    rows = lines.where(F.size(parts) == 2).select(F.get(parts, F.lit(0)).alias("tag_seq"), F.trim(F.get(parts, F.lit(1))).try_cast("long").alias("abun"))
    return rows.where((F.col("tag_seq") != "") & (F.col("abun") >= least))


def parse_fasta_reads(lines: DataFrame, least: int = 1) -> DataFrame:
    """``tag_seq`` and ``abun``: every line that is no header is one read; equal ones are counted."""
    rows = lines.where(~F.col("value").startswith(">") & (F.trim("value") != ""))
    return rows.groupBy(F.trim("value").alias("tag_seq")).agg(F.count(F.lit(1)).alias("abun")).where(F.col("abun") >= least)


def parse_fasta_variant(records: DataFrame) -> DataFrame:
    """``tag_seq`` and ``abun`` of FASTA records whose sequences may run over lines, cleaned without a change of case.

    The lines of a record are joined, cut before the first ``N`` of the first half, and kept at 18 to 35 letters
    without another ``N``; no other letter is looked at.
    """
    lines = F.split(F.expr("substring(value, instr(value, '\n') + 1)"), "\n")
    joined = F.array_join(F.transform(lines, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), "")
    rows = records.where(F.instr("value", "\n") > 0).select(cut_at_n(joined).alias("tag_seq"))
    kept = rows.where(F.length("tag_seq").between(MIN_READ, MAX_READ) & (F.instr("tag_seq", "N") == 0))
    return kept.groupBy("tag_seq").agg(F.count(F.lit(1)).alias("abun"))


def parse_counted_fasta(records: DataFrame) -> DataFrame:
    """``tag_id``, ``tag_seq`` and ``abun`` of ``name|count`` headers and their sequences.

    A malformed header is an error when its row is used; a record without sequence is skipped.
    """
    head, body = F.substring_index("value", "\n", 1), F.regexp_replace(F.expr("substring(value, instr(value, '\n') + 1)"), r"\s", "")
    rows = records.where(F.instr("value", "\n") > 0).select(F.trim(head).alias("__h"), body.alias("tag_seq")).where("tag_seq <> ''")
    count = F.regexp_extract("__h", r"\|(\d+)$", 1).try_cast("long")
    return rows.select(F.regexp_extract("__h", r"^([^|]*)", 1).alias("tag_id"), "tag_seq", F.coalesce(count, F.raise_error(F.concat(F.lit("malformed header: "), F.col("__h"))).cast("long")).alias("abun"))


def parse_fastq(lines: DataFrame) -> DataFrame:
    """``file``, ``record``, ``seq``, ``quality`` and ``problem`` of four-line records (``file``, ``line_no``, ``value``).

    ``problem`` is null for a sound record, else ``incomplete``, ``header``, ``separator`` or ``length``.
    """
    part = lambda i: F.max(F.when(F.col("line_no") % 4 == i, F.col("value")))
    rows = lines.groupBy("file", F.floor(F.col("line_no") / 4).alias("record")).agg(*(part(i).alias(n) for i, n in enumerate(("header", "seq", "plus", "quality"))), F.count(F.lit(1)).alias("n"))
    problem = (
        F.when(F.col("n") < 4, "incomplete").when(~F.col("header").startswith("@"), "header").when(~F.col("plus").startswith("+"), "separator")
        .when(F.length("seq") != F.length("quality"), "length")
    )
    return rows.select("file", "record", "seq", "quality", problem.alias("problem"))


def clean_fastq(records: DataFrame, strict: bool = True) -> DataFrame:
    """``tag_seq`` and ``abun`` of the reads that stay after cleaning; with ``strict`` a broken record is an error."""
    checked = records
    if strict:
        broken = F.raise_error(F.concat_ws(" ", F.lit("broken FASTQ record:"), "problem", F.col("record").cast("string"))).cast("string")
        checked = records.withColumn("seq", F.when(F.col("problem").isNotNull(), broken).otherwise(F.col("seq")))
    kept = checked.where("problem is null" if not strict else "true").where(read_verdict(F.col("seq")) == "retained")
    return kept.groupBy(chop_at_n(F.col("seq")).alias("tag_seq")).agg(F.count(F.lit(1)).alias("abun"))


def parse_reference(records: DataFrame, longer_than: int = 200) -> DataFrame:
    """``old_id`` (first word of the header), ``seq`` and ``len`` of the contigs longer than ``longer_than``."""
    head = F.regexp_extract(F.substring_index("value", "\n", 1), r"^\s*(\S+)", 1)
    seq = F.when(F.instr("value", "\n") > 0, F.regexp_replace(F.expr("substring(value, instr(value, '\n') + 1)"), r"\s", "")).otherwise("")
    return records.select(head.alias("old_id"), seq.alias("seq"), F.length(seq).alias("len")).where((F.col("len") > longer_than) & (F.col("old_id") != ""))


def read_tag_counts(spark: SparkSession, path: str, least: int = 1) -> DataFrame:
    return parse_tag_counts(spark.read.text(path), least)


def read_fasta(spark: SparkSession, path: str, least: int = 1) -> DataFrame:
    return parse_fasta_reads(spark.read.text(path), least)


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    return parse_fastq(numbered_lines(spark, path))


def read_counted_fasta(spark: SparkSession, path: str) -> DataFrame:
    return parse_counted_fasta(chunks(spark, path))


def read_reference(spark: SparkSession, path: str, longer_than: int = 200) -> DataFrame:
    return parse_reference(chunks(spark, path), longer_than)


def sniff(spark: SparkSession, path: str) -> str:
    """``fasta``, ``fastq``, ``tags`` or ``unknown`` by the first lines of a file."""
    lines = [r.value for r in spark.read.text(path).head(4)]
    if not lines:
        return "unknown"
    if lines[0].startswith(">"):
        return "fasta"
    if lines[0].startswith("@") and len(lines) > 2 and lines[2].startswith("+"):
        return "fastq"
    parts = lines[0].split("\t")
    return "tags" if len(parts) == 2 and parts[1].strip().isdigit() else "unknown"


def looks_raw(spark: SparkSession, path: str, sample: int = 1000, longest: int = 35, share: float = 0.8) -> bool:
    """True if most of the first ``sample`` reads of a file are longer than small RNAs: adapters were not trimmed.

    Only the head of the file is read; a preflight looks at no more.
    """
    reads = [r.value for r in spark.read.text(path).head(4 * sample)][1::4]
    return bool(reads) and sum(len(r) > longest for r in reads) >= share * len(reads)
