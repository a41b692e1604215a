"""Groups of records that pairwise matches link, directly or through others, by random contraction of the graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusloom.session import saved


def _undirected(a: Column, b: Column, edges: DataFrame) -> DataFrame:
    """Distinct pairs with the smaller end first, without loops."""
    return edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()


def connected_components(edges: DataFrame, a: Column, b: Column, seed: int = 17, max_rounds: int = 200) -> DataFrame:
    """``vertex`` and ``component`` of every vertex with a link; ``component`` is the smallest vertex of its group.

    Each round draws a fresh hash order, hooks every vertex to the first of itself and its neighbours in that order,
    relabels the edges by the hooks and removes loops and repeats; a constant share of the vertices goes in each round
    (expected), so rounds grow with the logarithm of the largest group only. At the end the rounds' hooks are expanded
    from the last to the first. Rows with a null end and links of a vertex with itself give nothing; order, direction
    and repeats of pairs do not matter. Empty input gives no rows.

    Hooks are a map-side combined minimum, so a vertex with a third of all edges costs one row per task there; its
    side of the relabelling join is split by adaptive execution. Edges and hooks of each round are written to the
    shared checkpoint folder: lineage stays short, sizes are known, and a lost executor costs no earlier round.
    """
    here = saved(_undirected(a, b, edges.where(a.isNotNull() & b.isNotNull())), "edges")
    hooks: list[DataFrame] = []
    for step in range(max_rounds):
        if here.isEmpty():
            break
        rank = lambda c, s=seed + step: F.struct(F.xxhash64(F.lit(s), c).alias("h"), c.alias("to"))
        ends = here.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("w")), F.struct(F.col("b").alias("v"), F.col("a").alias("w")))).alias("e"))
        first = ends.select("e.v", rank(F.col("e.w")).alias("r")).groupBy("v").agg(F.min("r").alias("r"))
        hook = saved(first.select("v", F.least("r", rank(F.col("v")))["to"].alias("to")), "hooks")
        hooks.append(hook)
        left = hook.select(F.col("v").alias("a"), F.col("to").alias("ra"))
        right = hook.select(F.col("v").alias("b"), F.col("to").alias("rb"))
        here = saved(_undirected(F.col("ra"), F.col("rb"), here.join(left, "a").join(right, "b")), "edges")
    else:
        raise RuntimeError(f"edges are left after {max_rounds} rounds")
    if not hooks:
        return here.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    roots = hooks[-1].select("v", "to")
    for hook in reversed(hooks[:-1]):
        later = roots.select(F.col("v").alias("__v"), F.col("to").alias("__root"))
        roots = hook.join(later, F.col("to") == F.col("__v"), "left").select("v", F.coalesce("__root", "to").alias("to"))
    least = roots.groupBy("to").agg(F.min("v").alias("component"))
    return roots.join(least, "to").select(F.col("v").alias("vertex"), "component")
