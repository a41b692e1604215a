"""Column functions for identifiers, strands, coordinates and scores of loci."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


#: The spellings of the two strands.
WATSON, CRICK = ("w", "+", "watson", "1", "true"), ("c", "-", "crick", "0", "false")


def strand_code(strand: Column) -> Column:
    """``w`` or ``c`` for the spellings of a strand, else null."""
    s = F.lower(F.trim(strand))
    return F.when(s.isin(*WATSON), "w").when(s.isin(*CRICK), "c")


def locus_id(chromosome: Column, start: Column, end: Column) -> Column:
    return F.format_string("%s:%d..%d", chromosome, start, end)


def locus_parts(identifier: Column) -> tuple[Column, Column, Column]:
    """Contig, start and end of ``contig:start..end``; nulls for any other text."""
    form = r"^\s*(.+):(\d+)\.\.(\d+)\s*$"
    part = lambda i: F.nullif(F.regexp_extract(identifier, form, i), F.lit(""))
    return part(1), part(2).try_cast("long"), part(3).try_cast("long")


def file_stem(path: Column) -> Column:
    """File name without directories and the endings of read files, compressed or not."""
    name = F.regexp_replace(path, r"^.*/", "")
    return F.regexp_replace(F.regexp_replace(name, r"(?i)\.gz$", ""), r"(?i)\.(fastq|fq|fasta|fa|fas|tag|txt)$", "")


def bare_cluster_id(cluster: Column, phase: int, library: Column | None = None) -> Column:
    """Cluster id without the name of its file in front, in the forms in which such names are glued to ids.

    The first form that fits decides. Ids that are places (``contig:start..end``) and all others stay, without white
    space around.
    """
    s = F.trim(cluster)
    # fixed values: the forms of file names, in their order
    forms = [rf"^[^.]+\.{phase}-PHAS\.candidate\.clusters[^-]*-(.+)$", rf"\.{phase}-PHAS\.candidate\.clusters(.+)$", r"^.+?\.PHAS\.candidate\.clusters[^-]*-(.+)$", r"^.+?\.PHAS\.candidate\.clusters(.+)$"]
    bare = [F.nullif(F.regexp_extract(s, form, 1), F.lit("")) for form in forms]
    if library is not None:
        head = F.concat(library, F.lit(f".{phase}-PHAS.candidate.clusters"), library, F.lit("-"))
        bare = [F.when(s.startswith(head) & (F.length(s) > F.length(head)), F.substring(s, F.length(head) + 1, F.length(s))), *bare]
    return F.when(s.contains(":") & s.contains(".."), s).otherwise(F.trim(F.coalesce(*bare, s)))


def cluster_parts(cluster: Column) -> tuple[Column, Column, Column]:
    """Library, contig and number of ``<library>-<contig>_<n>_<contig>``; nulls for any other text."""
    form = r"^(.+)-(.+)_(\d+)_(\2)$"
    part = lambda i: F.nullif(F.regexp_extract(cluster, form, i), F.lit(""))
    return part(1), part(2), part(3).try_cast("long")


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` where ``b`` is positive, else null."""
    return F.when(b > 0, a / b)


def known(value: Column) -> Column:
    """NaN becomes null, so that comparisons with it are never true."""
    return F.when(~F.isnan(value), value)


def per_ten_million(abun: Column, total: Column, factor: float = 1e7) -> Column:
    """Abundance per ``factor``, rounded half to even, at least 1."""
    return F.greatest(F.bround(abun / total * F.lit(factor)), F.lit(1.0)).cast("long")


def overlap_nt(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Shared positions of two inclusive intervals."""
    return F.greatest(F.lit(0), F.least(end_a, end_b) - F.greatest(start_a, start_b) + 1)


def phase_shift(a: Column, b: Column, phase: int) -> Column:
    """Signed shortest shift from ``a`` to ``b`` modulo the phase; null if they share the register."""
    d = F.pmod(b - a, F.lit(phase))
    return F.when(d == 0, None).when(d > phase / 2, d - phase).otherwise(d)


def register_relation(pos: Column, origin: Column, phase: int) -> Column:
    """``exact``, ``offset`` (one off) or ``other``."""
    d = F.pmod(pos - origin, F.lit(phase))
    return F.when(d == 0, "exact").when(d.isin(1, phase - 1), "offset").otherwise("other")


def howell_score(in_phase: Column, total: Column, filled: Column, cycles: int = 10) -> Column:
    """Phasing score of one register: 0 unless more than three cycles are filled."""
    out = F.greatest(F.lit(0.0), total - in_phase)
    score = (F.least(filled, F.lit(cycles)) - 2) * F.log1p(10 * in_phase / (1 + out))
    return F.when((filled > 3) & (in_phase > 0), score).otherwise(0.0)


def final_class(label: Column) -> Column:
    """One spelling of a class name; null for an unknown one."""
    s = F.regexp_replace(F.lower(F.trim(label)), r"[\s_]+", "-")
    return (
        F.when(s.isin("phas", "pass", "positive", "true", "1"), "PHAS")
        .when(s.isin("phas-like", "phaslike", "like"), "PHAS-like")
        .when(s.isin("non-phas", "nonphas", "negative", "false", "0"), "non-PHAS")
    )


def gff_attributes(values: dict[str, Column]) -> Column:
    """``key=value;...`` of the values that are present."""
    return F.concat_ws(";", *(F.concat(F.lit(k + "="), v.cast("string")) for k, v in values.items()))


def gff_attribute(attributes: Column, *names: str) -> Column:
    """The first of the named attributes that is present, of GFF3 (``k=v``) or GTF (``k "v"``) text."""
    found = [F.nullif(F.regexp_extract(attributes, rf'(?:^|;)\s*{n}[= ]\s*"?([^";]+)"?', 1), F.lit("")) for n in names]
    return reduce(lambda a, b: F.coalesce(a, b), found)


def natural_key(name: Column) -> Column:
    """Sort key by which ``chr2`` comes before ``chr10``: runs of digits compare as numbers, text without case."""
    parts = F.regexp_extract_all(name, F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 20, "0")).otherwise(F.lower(p))), "")
