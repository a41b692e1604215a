"""Writers: text forms as one column of lines, tables as tab-separated files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted_fasta(tags: DataFrame) -> DataFrame:
    """Lines ``>tag_id|abun`` and the sequence below."""
    return tags.select(F.concat(F.lit(">"), "tag_id", F.lit("|"), F.col("abun").cast("string"), F.lit("\n"), "tag_seq").alias("value"))


#: Copies that one row is made into at a time.
COPIES = 10_000


def expanded_fasta(tags: DataFrame, prefix: str = "read") -> DataFrame:
    """One record per copy of a tag, numbered within the tag. Tags of very many copies are divided over tasks first."""
    few = tags.where(F.col("abun").between(1, COPIES)).select("tag_seq", F.explode(F.sequence(F.lit(1).cast("long"), F.col("abun"))).alias("copy"))
    parts = tags.where(F.col("abun") > COPIES).select("tag_seq", "abun", F.explode(F.sequence(F.lit(1).cast("long"), F.col("abun"), F.lit(COPIES).cast("long"))).alias("from"))
    many = parts.repartition("tag_seq", "from").select("tag_seq", F.explode(F.sequence("from", F.least("abun", F.col("from") + (COPIES - 1)))).alias("copy"))
    return few.unionByName(many).select(F.concat(F.lit(f">{prefix}_"), "tag_seq", F.lit("_"), F.col("copy").cast("string"), F.lit("\n"), "tag_seq").alias("value"))


def fastq_to_fasta(lines: DataFrame) -> DataFrame:
    """Header and sequence lines (``file``, ``line_no``, ``value``) of four-line records, as FASTA lines."""
    place = F.col("line_no") % 4
    return lines.where(place < 2).withColumn("value", F.when(place == 0, F.concat(F.lit(">"), F.expr("substring(value, 2)"))).otherwise(F.col("value")))


def renamed_fasta(records: DataFrame, names: DataFrame) -> DataFrame:
    """FASTA records (:func:`chunks`) with the first word of the header replaced by ``new_id`` of ``names`` (``old_id``, ``new_id``).

    The rest of the header goes. A record whose name is not in ``names`` is an error when its row is used.
    """
    head = F.regexp_extract(F.substring_index("value", "\n", 1), r"^\s*(\S+)", 1)
    body = F.when(F.instr("value", "\n") > 0, F.expr("substring(value, instr(value, '\n'))")).otherwise("")
    named = records.select(head.alias("old_id"), body.alias("__body")).join(names.select("old_id", F.col("new_id").cast("string").alias("new_id")), "old_id", "left")
    new = F.coalesce("new_id", F.raise_error(F.concat(F.lit("no new name for "), "old_id")).cast("string"))
    return named.select(F.concat(F.lit(">"), new, "__body").alias("value"))


def tag_counts(tags: DataFrame) -> DataFrame:
    """Lines ``sequence<TAB>count``, the most frequent first."""
    return tags.orderBy(F.desc("abun"), "tag_seq").select(F.concat_ws("\t", "tag_seq", F.col("abun").cast("string")).alias("value"))


def sam_lines(reads: DataFrame, name: Column, mismatches: Column) -> DataFrame:
    """Alignment lines of reads with ``strand``, ``chromosome``, ``pos``, ``tag_seq`` and ``hits``."""
    f = [name, F.when(F.col("strand") == "w", "0").otherwise("16"), F.col("chromosome"), F.col("pos").cast("string"), F.lit("255"), F.concat(F.length("tag_seq").cast("string"), F.lit("M")), F.lit("*"), F.lit("0"), F.lit("0"), F.col("tag_seq"), F.lit("*")]
    tail = [F.lit("AS:i:0"), F.concat(F.lit("XM:i:"), mismatches.cast("string")), F.concat(F.lit("NH:i:"), F.col("hits").cast("string"))]
    return reads.select(F.concat_ws("\t", *f, *tail).alias("value"))


def write_lines(lines: DataFrame, path: str, compression: str = "gzip") -> None:
    lines.select("value").write.option("compression", compression).text(path)


def write_table(df: DataFrame, path: str, compression: str = "gzip") -> None:
    df.write.option("sep", "\t").option("header", True).option("compression", compression).option("nullValue", "").csv(path)
