"""The best N items of every group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


#: Parts of a group that are cut on their own first.
PARTS = 16


def _present(df: DataFrame, name: str) -> Column:
    ok = F.col(name).isNotNull()
    return ok & ~F.isnan(name) if isinstance(df.schema[name].dataType, (DoubleType, FloatType)) else ok


def top_n_per_group(df: DataFrame, group: Column, item: Column, score: Column, n: int, descending: bool = False, tie: Sequence[Column] = ()) -> DataFrame:
    """``group_key``, ``item_key``, ``score`` and ``rank`` (1..n) of the best ``n`` items of each group.

    Order: ``score`` (ascending, or descending), then ``tie`` expressions, then ``item``, ascending; text compares by
    bytes. Equal scores are therefore always cut in the same way. A null group, item or score, or a NaN score, never
    counts. Identical repeats of (group, item, score, tie) count once. A smaller group gives what it has, ``n < 1``
    and an empty table give no rows. Only the picked expressions leave the scan, so other columns and their names do
    not matter.

    Three steps. First each part of a group, as the tasks hold it, keeps its ``n`` first distinct values (a dense rank in
    ``PARTS`` parts of every group, of which a task feeds one), so a large group shrinks before it is shuffled. Then the
    repeats go in a map-side combined aggregation spread over all columns, so not even a much repeated row gathers in one
    task. At last the rank filter on ``row_number`` cuts the group; the optimiser puts its group limit on both sides of
    both shuffles by group.
    """
    ties = [f"__tie_{i}" for i in range(len(tie))]
    picked = df.select(group.alias("group_key"), item.alias("item_key"), score.alias("score"), *(c.alias(t) for c, t in zip(tie, ties)))
    rows = picked.where(_present(picked, "group_key") & _present(picked, "item_key") & _present(picked, "score"))
    best = F.col("score").desc() if descending else F.col("score").asc()
    order = (best, *ties, "item_key")
    part = Window.partitionBy("group_key", "__part").orderBy(*order)
    first = rows.withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(PARTS))).withColumn("rank", F.dense_rank().over(part)).where(F.col("rank") <= n)
    rows = first.drop("rank", "__part").distinct()
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("group_key").orderBy(*order))).where(F.col("rank") <= n).drop(*ties)
