"""Aggregation pushed below a join, so that no heavy key delays its task.

A join whose result is only counted and summed never needs its rows: each side is first reduced to one compact
state per join key and group (map-side combined before the shuffle, so a key that holds most rows costs one row per
map task), the states are joined, and counts and sums are combined algebraically and rolled up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY, _LN, _RN = "__key", "__left_rows", "__right_rows"


def _state(df: DataFrame, key: str | Column, groups: Mapping[str, Column], sums: Mapping[str, Column], count: str) -> DataFrame:
    key = df[key] if isinstance(key, str) else key
    picked = df.select(
        key.alias(_KEY),
        *(c.alias(f"__g_{n}") for n, c in groups.items()),
        *(c.alias(f"__s_{n}") for n, c in sums.items()),
    ).where(F.col(_KEY).isNotNull())
    return picked.groupBy(_KEY, *(f"__g_{n}" for n in groups)).agg(
        F.count(F.lit(1)).alias(count), *(F.sum(f"__s_{n}").alias(f"__s_{n}") for n in sums)
    )


def eager_join_aggregate(
    left: DataFrame,
    right: DataFrame,
    left_key: str | Column,
    right_key: str | Column,
    left_groups: Mapping[str, Column] | None = None,
    right_groups: Mapping[str, Column] | None = None,
    left_sums: Mapping[str, Column] | None = None,
    right_sums: Mapping[str, Column] | None = None,
    count: str = "n",
) -> DataFrame:
    """What ``left JOIN right ON left_key = right_key GROUP BY groups`` counts and sums, without the joined rows.

    The result has the columns of ``left_groups`` and ``right_groups`` (name -> expression), ``count`` (joined rows)
    and one sum over the joined rows for each entry of ``left_sums`` and ``right_sums``. Sums of a side are multiplied
    by the other side's rows per key, so they equal those of the expanded join. Rows with a null key match nothing.
    A null group value is a group of its own. A sum over nulls only is null. Empty tables give no
    rows, or the count 0 where there are no groups. All names are
    aliased first, so further or clashing columns of the inputs do not matter.
    """
    lg, rg, ls, rs = ({**(x or {})} for x in (left_groups, right_groups, left_sums, right_sums))
    names = [*lg, *rg, *ls, *rs, count]
    if len(set(names)) != len(names):
        raise ValueError(f"output names repeat: {names}")
    a = _state(left, left_key, lg, ls, _LN)
    b = _state(right, right_key, rg, rs, _RN)
    a = a.select(F.col(_KEY).alias("__k"), F.col(_LN), *(F.col(f"__g_{n}").alias(f"__lg_{n}") for n in lg), *(F.col(f"__s_{n}").alias(f"__ls_{n}") for n in ls))
    b = b.select(F.col(_KEY).alias("__rk"), F.col(_RN), *(F.col(f"__g_{n}").alias(f"__rg_{n}") for n in rg), *(F.col(f"__s_{n}").alias(f"__rs_{n}") for n in rs))
    joined = a.join(b, F.col("__k") == F.col("__rk"))
    return joined.groupBy(*(F.col(f"__lg_{n}").alias(n) for n in lg), *(F.col(f"__rg_{n}").alias(n) for n in rg)).agg(
        F.coalesce(F.sum(F.col(_LN) * F.col(_RN)), F.lit(0)).alias(count),
        *(F.sum(F.col(f"__ls_{n}") * F.col(_RN)).alias(n) for n in ls),
        *(F.sum(F.col(f"__rs_{n}") * F.col(_LN)).alias(n) for n in rs),
    )


def heavy_groups(groups: DataFrame, count: str, total: Column, share: float) -> DataFrame:
    """Rows of ``groups`` whose ``count`` is at least ``share`` of ``total``; none where ``total`` is 0 or null."""
    return groups.where((total > 0) & (F.col(count) >= F.lit(share) * total))


def union_counts(parts: Sequence[DataFrame], keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """UNION ALL of ``parts``, then the sums per key: pre-aggregated pools are added, never their rows."""
    if not parts:
        raise ValueError("no parts")
    out = parts[0].select(*keys, *sums)
    for part in parts[1:]:
        out = out.unionByName(part.select(*keys, *sums))
    return out.groupBy(*keys).agg(*(F.sum(s).alias(s) for s in sums))
