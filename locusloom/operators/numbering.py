"""Dense numbers and dense grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusloom.session import saved


def dense_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "number") -> DataFrame:
    """``df`` with 1, 2, 3, ... for the rows of each key in ``order``, which must tell all rows of a key apart.

    Rows are put in ranges of key and order, so a key with most rows spreads over many; numbers are given within a
    range and shifted by the rows of the ranges before. Only one row per key and range is gathered for that.
    """
    keys = list(keys)
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = saved(df.repartitionByRange(int(parts), *(F.col(k) for k in keys), *order).withColumn("__range", F.spark_partition_id()), "ranged")
    inside = ranged.withColumn("__n", F.row_number().over(Window.partitionBy(*keys, "__range").orderBy(*order)))
    sizes = ranged.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__size"))
    line = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*keys, "__range", F.coalesce(F.sum("__size").over(line), F.lit(0)).alias("__before"))
    return inside.join(before, [*keys, "__range"]).withColumn(name, F.col("__before") + F.col("__n")).drop("__range", "__n", "__before")


def grid(cells: DataFrame, row: str, column: str, value: str, columns: Sequence[str], fill: float | None = None) -> DataFrame:
    """One row per ``row`` with a column for each of ``columns``; absent cells are ``fill``, equal ones the least value.

    The columns are given, so their number is fixed before the plan is; cells of other columns are left out.
    """
    out = cells.groupBy(row).agg(*(F.min(F.when(F.col(column) == c, F.col(value))).alias(c) for c in columns))
    return out.fillna(fill, list(columns)) if fill is not None else out


def absent_cell(phase: int) -> int:
    """What a library without a call of a locus counts as: nothing, but a call that is not PHAS at phase 24."""
    return 1 if phase == 24 else 0


def dense_cells(cells: DataFrame, every: DataFrame, row: str, column: str, value: str, fill: int) -> DataFrame:
    """``cells`` with a row for each of their ``row`` values by each ``column`` value of ``every``; absent ones are ``fill``.

    The distinct columns (libraries) are one list, which goes to every row value; cells find their place by a join.
    """
    names = every.groupBy(F.lit(1).alias("__one")).agg(F.collect_set(column).alias("__names"))
    rows = cells.select(row).distinct().withColumn("__one", F.lit(1)).join(names, "__one").select(row, F.explode("__names").alias(column))
    return rows.join(cells, [row, column], "left").withColumn(value, F.coalesce(value, F.lit(fill)))
