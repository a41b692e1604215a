"""The most frequent values of a column by combinatorial group testing, in bounded memory.

A sketch has ``depth`` rows of ``width`` buckets. A value falls in one bucket of each row, and a bucket keeps the total
weight in it and, for each bit of the 64-bit fingerprint, the weight of the values with that bit set. A value with more
than half of its bucket's weight is read off directly: bit i is set where counter i is more than half of the total.
Sketches of partitions add up. Decoded candidates are verified by an exact count, which also proves the result whole:
a value with ``share`` of the weight lies, in every row, in a bucket that holds as much once the verified values are
taken out. Where such buckets remain, the few values that lie in them in every row are counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 64


def _buckets(prints: np.ndarray, row: int, width: int) -> np.ndarray:
    """Bucket of each fingerprint in one row: a multiply-shift hash with an odd multiplier drawn per row."""
    odd = np.random.default_rng(row).integers(0, 2**63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return ((prints ^ (prints >> np.uint64(29))) * odd >> np.uint64(64 - int(width).bit_length() + 1)).astype(np.int64)


class GroupTestingSketch:
    """Counters of one measure: ``[depth, width, 1 + 64]``, column 0 the total."""

    def __init__(self, depth: int, width: int):
        self.depth, self.width = depth, width
        self.counters = np.zeros((depth, width, 1 + BITS), np.int64)

    def add(self, prints: np.ndarray, weights: np.ndarray, sign: int = 1) -> None:
        if not len(prints):
            return
        prints, place = np.unique(prints, return_inverse=True)  # a heavy value is one addition per batch
        weights = np.bincount(place, weights, len(prints))
        bits = (prints[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
        weighted = np.concatenate([weights[:, None], bits * weights[:, None]], axis=1).astype(np.int64) * sign
        for j in range(self.depth):
            b = _buckets(prints, j, self.width)
            order = np.argsort(b, kind="stable")
            starts = np.flatnonzero(np.diff(b[order], prepend=-1))
            self.counters[j, b[order][starts]] += np.add.reduceat(weighted[order], starts, axis=0)

    def decode(self, least: float) -> np.ndarray:
        """Fingerprints read off the buckets of at least ``least`` weight, kept if they fall in the bucket read."""
        found = []
        for j in range(self.depth):
            at = np.flatnonzero(self.counters[j, :, 0] >= max(least, 1))
            totals = self.counters[j, at, 0]
            bits = (2 * self.counters[j, at, 1:] > totals[:, None]).astype(np.uint64)
            prints = (bits << np.arange(BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
            found.append(prints[_buckets(prints, j, self.width) == at])
        return np.unique(np.concatenate(found))

    def unresolved(self, least: float) -> np.ndarray:
        """``[depth, width]``: the buckets left with ``least`` weight. If a row has none, nothing that heavy is left."""
        heavy = self.counters[:, :, 0] >= max(least, 1)
        return heavy & heavy.any(axis=1).all()


def _sketch_partitions(measures: int, depth: int, width: int):
    """One sketch per measure and partition, as its non-empty buckets; bucket -1 of row -1 holds the partition's totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches = [GroupTestingSketch(depth, width) for _ in range(measures)]
        totals = [0] * measures
        for batch in batches:
            valid = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            prints = batch.column(0).fill_null(0).to_numpy().view(np.uint64)[valid]
            for m in range(measures):
                weights = batch.column(1 + m).to_numpy()
                if len(weights) and weights.min() < 0:
                    raise ValueError("weights must not be negative")
                totals[m] += int(weights.sum())
                sketches[m].add(prints, weights[valid])
        for m, sketch in enumerate(sketches):
            j, b = np.nonzero(sketch.counters[:, :, 0])
            rows = np.concatenate([np.array([[totals[m]] + [0] * BITS], np.int64), sketch.counters[j, b]])
            place = [np.full(len(rows), m), np.append(-1, j), np.append(-1, b)]
            columns = [*(pa.array(p.astype(np.int32)) for p in place), *(pa.array(np.ascontiguousarray(c)) for c in rows.T)]
            yield pa.RecordBatch.from_arrays(columns, names=["m", "j", "b", *_COUNTERS])

    return run


_COUNTERS = [f"c{i}" for i in range(1 + BITS)]
_SKETCH = T.StructType([T.StructField(n, T.IntegerType()) for n in "mjb"] + [T.StructField(n, T.LongType()) for n in _COUNTERS])


def _gather(rows: DataFrame, measures: list[str], depth: int, width: int) -> tuple[list[int], list[GroupTestingSketch]]:
    """The sum of all partitions' sketches. Its size is fixed by ``depth`` and ``width``, whatever the table's."""
    parts = rows.mapInArrow(_sketch_partitions(len(measures), depth, width), _SKETCH)
    table = parts.groupBy("m", "j", "b").agg(*(F.sum(c).alias(c) for c in _COUNTERS)).toArrow()
    m, j, b = (table.column(n).to_numpy() for n in "mjb")
    values = np.stack([table.column(c).to_numpy() for c in _COUNTERS], axis=1) if table.num_rows else np.zeros((0, 1 + BITS), np.int64)
    totals, sketches = [], []
    for k in range(len(measures)):
        totals.append(int(values[(m == k) & (j < 0), 0].sum()))
        sketches.append(sketch := GroupTestingSketch(depth, width))
        own = (m == k) & (j >= 0)
        sketch.counters[j[own], b[own]] = values[own]
    return totals, sketches


def _in_buckets(heavy: list[np.ndarray], columns: list[str]):
    """Rows whose fingerprint lies in one of the ``heavy`` buckets in every row of some measure's sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            prints = batch.column(0).fill_null(0).to_numpy().view(np.uint64)
            hit = np.zeros(len(prints), bool)
            for table in heavy:
                hit |= np.logical_and.reduce([table[j, _buckets(prints, j, table.shape[1])] for j in range(len(table))])
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(hit & valid)) for c in batch.columns], names=columns)

    return run


def frequent_values(df: DataFrame, value: Column, weights: Mapping[str, Column], share: float, depth: int = 4, width: int | None = None, max_rounds: int = 4) -> DataFrame:
    """``measure``, ``value``, ``estimate`` and ``weight`` of every value with at least ``share`` of a measure.

    ``weights`` names the measures and gives a row's whole-number weight in each (``lit(1)`` counts rows). The share is
    one of the measure's sum over all rows, those with a null value included; a null value is no value, a null weight
    counts 0, a negative one is an error. ``estimate`` is what the sketch says (the least total of the value's buckets,
    never too low), ``weight`` the exact weight from the verifying pass. The result is whole: found values are taken out
    of the sketch and it is decoded again, up to ``max_rounds`` times; if buckets with ``share`` of the weight are left
    in every row, the values that lie in such buckets in all rows, of which there are at most ``(1 / share / width) **
    depth`` of all, are counted by one more distributed pass. No rows come from an empty table, or if a measure's sum
    is 0.

    The size of a sketch is fixed (``depth * width * 65`` numbers for each measure), whatever the table holds. The
    partitions of the table are joined to as many tasks as the cluster has cores, so that each of those sends one
    sketch. The driver holds the added sketch and at most ``depth * width`` candidates.
    """
    names = list(weights)
    width = width or 1 << max(6, int(np.ceil(np.log2(8 / share))))
    spark = df.sparkSession
    ws = [f"w{i}" for i in range(len(names))]
    picked = df.select(value.cast("string").alias("value"), *(F.coalesce(w.cast("long"), F.lit(0).cast("long")).alias(n) for n, w in zip(ws, weights.values())))
    printed = F.when(F.col("value").isNotNull(), F.xxhash64("value"))
    rows = picked.select(printed.alias("print"), *ws)
    totals, sketches = _gather(rows.coalesce(max(1, spark.sparkContext.defaultParallelism)), names, depth, width)
    least = [max(share * t, 1e-9) for t in totals]
    estimates = [s.counters[:, :, 0].copy() for s in sketches]
    known: dict[int, list] = {}
    for _ in range(max_rounds):
        fresh = sorted({int(p) for s, x in zip(sketches, least) for p in s.decode(x)} - set(known))
        if not fresh:
            break
        new: dict[int, list] = {p: [] for p in fresh}
        for r in _verify(spark, picked, printed, fresh, ws):
            new[int(np.int64(r["print"]).view(np.uint64))].append(r)
        known |= new
        for k, s in enumerate(sketches):
            _take_out(s, new, k)
    heavy = [s.unresolved(x) for s, x in zip(sketches, least)]
    if any(h.any() for h in heavy):
        columns = ["print", "value", *ws]
        kept = picked.select(printed.alias("print"), "value", *ws).mapInArrow(_in_buckets(heavy, columns), "print long, value string, " + ", ".join(f"{w} long" for w in ws))
        enough = " or ".join(f"{w} >= {x!r}D" for w, x in zip(ws, least))
        for r in kept.groupBy("print", "value").agg(*(F.sum(w).alias(w) for w in ws)).where(enough).collect():  # 1 / share for each measure at most
            known.setdefault(int(np.int64(r["print"]).view(np.uint64)), []).append(r)
    out = set()
    for k, name in enumerate(names):
        for p, group in known.items():
            for r in group:
                if totals[k] > 0 and r[ws[k]] >= share * totals[k]:
                    at = [int(_buckets(np.array([p], np.uint64), j, width)[0]) for j in range(depth)]
                    out.add((name, r["value"], int(min(estimates[k][j, b] for j, b in enumerate(at))), r[ws[k]]))
    return spark.createDataFrame(sorted(out), "measure string, value string, estimate long, weight long")


def _take_out(sketch: GroupTestingSketch, known: Mapping[int, list], measure: int) -> None:
    pairs = [(p, r[f"w{measure}"]) for p, group in known.items() for r in group]
    sketch.add(np.array([p for p, _ in pairs], np.uint64), np.array([w for _, w in pairs], np.int64), sign=-1)


def _verify(spark, picked: DataFrame, printed: Column, prints: list[int], ws: list[str]) -> list:
    """Exact weights of the values behind the candidates' fingerprints."""
    wanted = spark.createDataFrame([(int(p),) for p in np.array(prints, np.uint64).view(np.int64)], "print long")
    hit = picked.withColumn("print", printed).join(F.broadcast(wanted), "print")  # at most depth * width numbers
    return hit.groupBy("print", "value").agg(*(F.sum(w).alias(w) for w in ws)).collect()
