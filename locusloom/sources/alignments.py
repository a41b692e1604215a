"""Alignments, candidate-cluster files, annotations and result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusloom.functions.loci import gff_attribute
from locusloom.sources.lines import chunks

_CLUSTER_FIELDS = (
    ("chromosome", "string"), ("strand", "string"), ("pos", "long"), ("len", "int"), ("hits", "int"), ("abun", "long"), ("pval_h_f", "double"), ("N_f", "int"),
    ("X_f", "int"), ("pval_r_f", "double"), ("pval_corr_f", "double"), ("pval_h_r", "double"), ("N_r", "int"), ("X_r", "int"), ("pval_r_r", "double"),
    ("pval_corr_r", "double"), ("tag_id", "string"), ("tag_seq", "string"),
)


def _optional(fields: Column, name: str, place: int) -> Column:
    """Value of an optional SAM field by its name, else the one at its usual place."""
    named = F.try_element_at(F.filter(fields, lambda x: x.startswith(name + ":")), F.lit(1))
    at = F.try_element_at(fields, F.lit(place))
    return F.substring_index(F.coalesce(named, at), ":", -1).try_cast("int")


def parse_sam(lines: DataFrame) -> DataFrame:
    """``name``, ``strand``, ``chromosome``, ``pos``, ``tag_seq``, ``len``, ``abun``, ``mismatches`` and ``hits`` of alignments.

    Kept are mapped lines with flag 0, 256 (Watson), 16 or 272 (Crick). Abundance stands behind the last bar of the
    name; mismatches are in ``XM`` and hits in ``NH``. Lines where a number cannot be read are skipped. Further columns of
    ``lines`` stay.
    """
    f = F.split("value", "\t")
    kept = [c for c in lines.columns if c != "value"]
    rows = lines.where(~F.col("value").startswith("@") & (F.size(f) >= 11)).select(*kept, f.alias("f"))
    at = lambda i: F.get("f", F.lit(i))
    out = rows.where(at(1).isin("0", "256", "16", "272")).select(
        *kept,
        at(0).alias("name"), F.when(at(1).isin("0", "256"), "w").otherwise("c").alias("strand"), at(2).alias("chromosome"), at(3).try_cast("long").alias("pos"),
        at(9).alias("tag_seq"), F.length(at(9)).alias("len"), F.substring_index(at(0), "|", -1).try_cast("long").alias("abun"),
        _optional(F.col("f"), "XM", -7).alias("mismatches"), _optional(F.col("f"), "NH", -1).alias("hits"),
    )
    return out.dropna(subset=["pos", "abun", "mismatches", "hits"])


def usable_alignments(alignments: DataFrame, max_hits: int = 25, mismatches: int = 0) -> DataFrame:
    """Alignments of tags with fewer than ``max_hits`` hits and at most ``mismatches``."""
    return alignments.where((F.col("hits") < max_hits) & (F.col("mismatches") <= mismatches))


def parse_cluster_blocks(records: DataFrame) -> DataFrame:
    """The rows of ``cluster = <id>`` blocks, each with its ``clusterID``; rows with fewer fields are skipped."""
    lines = F.split("value", "\n")
    ids = F.regexp_extract(F.get(lines, F.lit(0)), r"^\s*cluster\s*=\s*(.*?)\s*$", 1)
    rows = records.select(*(c for c in records.columns if c != "value"), ids.alias("clusterID"), F.explode(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))).alias("__row"))
    f = F.split("__row", "\t")
    kept = rows.where((F.col("clusterID") != "") & (F.size(f) >= len(_CLUSTER_FIELDS)))
    return kept.select(*(c for c in rows.columns if c != "__row"), *((F.get(f, F.lit(i)) if t == "string" else F.trim(F.get(f, F.lit(i))).try_cast(t)).alias(n) for i, (n, t) in enumerate(_CLUSTER_FIELDS)))


def cluster_block_lines(rows: DataFrame) -> DataFrame:
    """One ``value`` per row that :func:`parse_cluster_blocks` reads back."""
    fields = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n, _ in _CLUSTER_FIELDS]
    return rows.select(F.concat(F.lit("cluster = "), "clusterID", F.lit("\n"), F.concat_ws("\t", *fields)).alias("value"))


def read_cluster_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Rows of candidate-cluster files, with the library from the file name."""
    name = F.regexp_extract("file", r"([^/]+?)\.\d+-PHAS\.candidate\.clusters(?:\.gz)?$", 1)
    return parse_cluster_blocks(chunks(spark, path).select(name.alias("alib"), "value"))


def parse_annotation(lines: DataFrame, form: str) -> DataFrame:
    """``chromosome``, ``start``, ``end`` (half-open, from 0) and ``name`` of ``bed`` or ``gff`` lines; malformed ones are skipped."""
    f = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#")).select(f.alias("f"))
    at = lambda i: F.try_element_at("f", F.lit(i + 1))
    if form == "bed":
        out = rows.select(at(0).alias("chromosome"), at(1).try_cast("long").alias("start"), at(2).try_cast("long").alias("end"), at(3).alias("name"))
    elif form == "gff":
        name = gff_attribute(at(8), "ID", "Name", "gene_id", "transcript_id")
        out = rows.where(F.size("f") >= 9).select(at(0).alias("chromosome"), (at(3).try_cast("long") - 1).alias("start"), at(4).try_cast("long").alias("end"), name.alias("name"))
    else:
        raise ValueError(f"unknown form {form!r}")
    out = out.where("chromosome <> '' and start is not null and end is not null")
    return out.withColumn("name", F.coalesce("name", F.format_string("%s:%d-%d", "chromosome", "start", "end")))


def parse_id_map(lines: DataFrame) -> DataFrame:
    """``identifier`` and ``clusterID`` of ragged lines ``identifier<TAB>id<TAB>id...``."""
    f = F.split("value", "\t")
    rows = lines.where(F.size(f) > 1).select(F.get(f, F.lit(0)).alias("identifier"), F.explode(F.slice(f, 2, F.size(f) - 1)).alias("clusterID"))
    return rows.where("identifier <> '' and clusterID <> ''")


def read_result_table(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A tab-separated result table, all columns text; missing or repeated columns are an error."""
    head = spark.read.text(path).head(1)
    names = head[0].value.split("\t") if head else []
    if len(set(names)) != len(names) or "" in names or not set(required) <= set(names):
        raise ValueError(f"{path}: columns {names} lack some of {required}, or repeat")
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.option("sep", "\t").option("header", True).option("quote", "").schema(schema).csv(path)


CALL_COLUMNS = ["identifier", "alib", "achr", "start", "end"]
OVERRIDE_COLUMNS = ["identifier", "alib", "final_class"]


def parse_calls(lines: DataFrame, header: str, one_based: bool = True) -> DataFrame:
    """``identifier``, ``alib``, ``chromosome``, ``start`` and ``end`` (half-open, from 0) of the rows below ``header``.

    A header without one of ``CALL_COLUMNS`` is an error; rows whose positions cannot be read are skipped.
    """
    names = header.split("\t")
    if missing := set(CALL_COLUMNS) - set(names):
        raise ValueError(f"columns {sorted(missing)} are missing")
    f = F.split("value", "\t")
    text = {n: F.get(f, F.lit(names.index(n))) for n in CALL_COLUMNS}
    number = lambda n: F.trim(text[n]).try_cast("long")
    rows = lines.where(F.col("value") != header).select(
        text["identifier"].alias("identifier"), text["alib"].alias("alib"), text["achr"].alias("chromosome"), (number("start") - int(one_based)).alias("start"), number("end").alias("end")
    )
    return rows.dropna(subset=["chromosome", "start", "end"])


def read_calls(spark: SparkSession, path: str, one_based: bool = True) -> DataFrame:
    """:func:`parse_calls` of a file, or of a folder of files with the same header."""
    head = spark.read.text(path).head(1)
    if not head:
        raise ValueError(f"{path} is empty")
    return parse_calls(spark.read.text(path), head[0].value, one_based)


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Overrides of classes; without one of ``OVERRIDE_COLUMNS`` an error."""
    return read_result_table(spark, path, OVERRIDE_COLUMNS)
