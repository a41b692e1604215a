"""Items of varying size in containers of fixed capacity, by vector best-fit in bounded shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.session import saved

WEIGHTS = (1.0, 0.1, 0.2)
#: Copies of one row that a task makes at a time, and the tasks over which the shards are spread at most.
COPIES, MOST_TASKS = 10_000, 20_000
SCHEMA = "shard int, doc_id {id}, copy long, piece_no int, start_token long, n_tokens int, bin int, used int"


def best_fit(sizes: np.ndarray, capacity: int, max_items: int, max_cost: int, rule: str = "norm") -> np.ndarray:
    """Bin number of each item, items in the given order (descending sizes pack best).

    A bin has three residual capacities: tokens, items and attention cost (the sum of squared sizes). Of the bins in
    which all three suffice, ``norm`` takes the one whose residuals, weighted, have the least norm behind the item,
    and ``dot`` the one with the largest weighted dot-product of item and residuals; without one a new bin opens. An item
    that alone costs more than ``max_cost`` has a bin of its own, which takes nothing else.
    """
    limits = np.array([capacity, max_items, max_cost], float)
    weights = np.array(WEIGHTS)
    numbers = np.zeros(len(sizes), np.int64)
    rest = np.zeros((len(sizes) + 1, 3))
    names = np.zeros(len(sizes) + 1, np.int64)
    count = opened = 0
    least = sizes.min() if len(sizes) else 0
    for i, size in enumerate(sizes.tolist()):
        need = np.array([size, 1, size * size], float) / limits
        now = rest[:count]
        fits = np.flatnonzero((now >= need - 1e-12).all(axis=1))
        if len(fits):
            left = now[fits]
            score = -((left - need) ** 2 @ weights) if rule == "norm" else left @ (weights * need)
            k = fits[score.argmax()]
        else:
            k = count
            rest[k], names[k] = 1.0, opened
            opened += 1
            count += 1
        rest[k] -= need
        numbers[i] = names[k]
        if rest[k, 0] * capacity < least - 0.5 or rest[k, 1] * max_items < 0.5 or rest[k, 2] * max_cost < least * least - 0.5:  # nothing fits any more
            count -= 1
            rest[k], names[k] = rest[count], names[count]
    return numbers


def _pack_shard(capacity: int, max_items: int, max_cost: int, rule: str):
    def run(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("copy", "ascending"), ("piece_no", "ascending")])
        sizes = shard.column("n_tokens").to_numpy()
        bins = best_fit(sizes, capacity, max_items, max_cost, rule)
        used = np.bincount(bins, sizes)[bins]
        return shard.append_column("bin", pa.array(bins.astype(np.int32))).append_column("used", pa.array(used.astype(np.int32)))

    return run


def _numbered(items: DataFrame) -> DataFrame:
    """Each row ``n`` times, with its ``copy`` 1 to n; rows repeated very often are divided over tasks first."""
    few = items.where(F.col("n") <= COPIES).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    many = items.where(F.col("n") > COPIES).withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(COPIES).cast("long")))).repartition("doc_id", "from")
    return few.unionByName(many.withColumn("copy", F.explode(F.sequence("from", F.least("n", F.col("from") + (COPIES - 1))))).drop("from"))


def pack(
    df: DataFrame, doc_id: str, size: str, capacity: int, max_items: int = 256, max_cost: int | None = None,
    rule: str = "norm", shard_items: int = 20_000, full: float = 0.98, rounds: int = 3,
) -> DataFrame:
    """``container_id``, ``doc_id``, ``piece_no``, ``start_token`` and ``n_tokens``: one row per placed piece.

    Every container keeps to ``capacity`` tokens, ``max_items`` pieces and ``max_cost``, the sum of squared piece sizes
    that attention costs (``capacity`` squared unless given, which never binds). A piece that alone costs more stands
    alone. An item is divided only if it alone exceeds the capacity: in pieces of the full capacity and a rest. An item
    of size 0 takes a place and no space; a null or negative size gives no row. Repeated rows are items of their own.
    Empty input gives no rows.

    Items are spread by hash over shards of about ``shard_items``, so no task sees more than that, whatever the table
    holds. Containers filled to less than ``full`` are taken apart and their items packed again in fewer shards, which
    mixes what different shards had left; after ``rounds`` the containers stand. A retried task repeats its shard
    exactly.
    """
    max_cost = capacity * capacity if max_cost is None else max_cost
    if capacity < 1 or max_items < 1 or max_cost < 1:
        raise ValueError("capacity, max_items and max_cost must be positive")
    kind = df.schema[doc_id].dataType.simpleString()
    items = df.select(F.col(doc_id).alias("doc_id"), F.col(size).cast("long").alias("size")).where("size >= 0")
    items = _numbered(saved(items.groupBy("doc_id", "size").agg(F.count(F.lit(1)).alias("n")), "sizes"))  # read twice, measured once
    last = F.greatest(F.ceil(F.col("size") / capacity) - 1, F.lit(0)).cast("int")
    pieces = items.withColumn("piece_no", F.explode(F.sequence(F.lit(0), last))).select(
        "doc_id", "copy", "piece_no", (F.col("piece_no").cast("long") * capacity).alias("start_token"),
        F.least(F.lit(capacity), F.col("size") - F.col("piece_no").cast("long") * capacity).cast("int").alias("n_tokens"),
    )
    pieces = saved(pieces, "pieces")
    columns = ["container_id", "doc_id", "piece_no", "start_token", "n_tokens"]
    name = F.concat_ws("-", F.lit("whole"), "doc_id", "copy", "piece_no")
    done = [pieces.where(F.col("n_tokens") == capacity).select(name.alias("container_id"), *columns[1:])]
    left = pieces.where(F.col("n_tokens") < capacity)
    for step in range(rounds):
        shards = max(1, -(-left.count() // shard_items))
        placed = left.withColumn("shard", F.pmod(F.xxhash64(F.lit(step), "doc_id", "piece_no", "copy"), F.lit(shards)).cast("int"))
        # as many tasks as shards: they hold few bytes and much work, which adaptive execution would put in one task
        placed = placed.select("shard", "doc_id", "copy", "piece_no", "start_token", "n_tokens").repartition(min(shards, MOST_TASKS), "shard").groupBy("shard")
        placed = saved(placed.applyInArrow(_pack_shard(capacity, max_items, max_cost, rule), SCHEMA.format(id=kind)), "packed")
        end = step == rounds - 1 or shards == 1
        stands = F.lit(True) if end else F.col("used") >= full * capacity
        done.append(placed.where(stands).select(F.concat_ws("-", F.lit(step), "shard", "bin").alias("container_id"), *columns[1:]))
        if end:
            break
        left = placed.where(~stands).select("doc_id", "copy", "piece_no", "start_token", "n_tokens")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
