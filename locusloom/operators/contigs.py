"""Contig names: numbers for contigs in the order of their file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered_contigs(contigs: DataFrame, name: str, order: str) -> DataFrame:
    """``contigs`` with ``number``: that in the name (``chr01`` -> 1), else the next ones behind the largest.

    A number that is 0 or taken by an earlier contig does not count. Contigs of a reference are few: one window holds
    them all.
    """
    own = F.regexp_extract(F.lower(F.trim(name)), r"^(?:chr)?0*([1-9][0-9]*)$", 1).try_cast("long")
    rows = contigs.withColumn("__own", own)
    first = F.row_number().over(Window.partitionBy("__own").orderBy(order, name)) == 1
    rows = rows.withColumn("__own", F.when(F.col("__own").isNotNull() & first, F.col("__own")))
    place = F.row_number().over(Window.partitionBy(F.col("__own").isNull()).orderBy(order, name))
    most = F.coalesce(F.max("__own").over(Window.partitionBy()), F.lit(0))
    return rows.withColumn("number", F.coalesce("__own", most + place)).drop("__own")
