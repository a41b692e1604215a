"""Column functions for sequences: cleaning of reads and spellings of molecules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_READ, MAX_READ = 18, 35


def molecule(seq: Column) -> Column:
    """One spelling of a sequence: bare, in capitals, T for U; null where nothing is left."""
    clean = F.translate(F.upper(F.regexp_replace(seq, r"^\s+|\s+$", "")), "U", "T")
    return F.when(clean != "", clean)


def cut_at_n(seq: Column) -> Column:
    """The sequence, cut before the first N if that lies in the first half."""
    at = F.instr(seq, "N")
    return F.when((at > 0) & (at <= F.floor(F.length(seq) / 2)), F.substring(seq, F.lit(1), at - 1)).otherwise(seq)


def chop_at_n(seq: Column) -> Column:
    """Bare capitals, cut before the first N if that lies in the first half."""
    return cut_at_n(F.upper(F.trim(seq)))


def read_verdict(seq: Column) -> Column:
    """``retained``, ``rejected_ambiguous`` (tested first) or ``rejected_length``; null for a null read."""
    s = chop_at_n(seq)
    return (
        F.when(seq.isNull(), None)
        .when(~s.rlike("^[ACGT]*$"), "rejected_ambiguous")
        .when(~F.length(s).between(MIN_READ, MAX_READ), "rejected_length")
        .otherwise("retained")
    )
