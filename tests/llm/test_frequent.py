import random
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from locusloom.llm.frequent import GroupTestingSketch, frequent_values


def test_decodes_the_majority():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    weights = np.ones(3000)
    weights[:3] = 500
    sketch = GroupTestingSketch(4, 512)
    sketch.add(prints[:1500], weights[:1500])
    other = GroupTestingSketch(4, 512)
    other.add(prints[1500:], weights[1500:])
    sketch.counters += other.counters
    assert set(prints[:3].tolist()) <= set(sketch.decode(400).tolist())
    sketch.add(prints[:3], weights[:3], sign=-1)
    assert not sketch.unresolved(400).any()


@pytest.mark.parametrize("width", [None, 8])
def test_equals_counts(spark, width):
    rng = random.Random(4)
    values = [f"v{int(rng.paretovariate(0.9))}" for _ in range(3000)] + [None] * 500 + [""] * 80
    rows = [(v, rng.choice([None, 0, 1, 7])) for v in values]
    df = spark.createDataFrame(rows, "v string, value int").repartition(5)
    share = 0.02
    got = {(r.measure, r.value): (r.weight, r.estimate) for r in frequent_values(df, F.col("v"), {"rows": F.lit(1), "w": F.col("value")}, share, width=width).collect()}
    rows_of, weight_of = Counter(v for v, _ in rows), Counter()
    for v, w in rows:
        weight_of[v] += w or 0
    want = {("rows", v): n for v, n in rows_of.items() if v is not None and n >= share * len(rows)}
    want |= {("w", v): n for v, n in weight_of.items() if v is not None and n >= share * sum(weight_of.values())}
    assert {k: x[0] for k, x in got.items()} == want
    assert all(estimate >= weight for weight, estimate in got.values()) or width == 8


def test_heavy_tail_in_few_buckets(spark, monkeypatch):
    """No bucket of so small a sketch has a majority, so hardly anything is decoded; the result is whole at the same width."""
    import locusloom.llm.frequent as frequent

    widths, original = [], frequent._gather
    monkeypatch.setattr(frequent, "_gather", lambda rows, names, depth, width: widths.append(width) or original(rows, names, depth, width))
    df = spark.range(20_000).select(F.concat(F.lit("v"), F.when(F.col("id") < 9_000, F.col("id") % 45).otherwise(F.col("id"))).alias("v"))
    got = {r.value: r.weight for r in frequent_values(df, F.col("v"), {"rows": F.lit(1)}, 0.01, width=4).collect()}
    assert got == {f"v{i}": 200 for i in range(45)} and widths == [4]
    assert frequent_values(df, F.col("v"), {"rows": F.lit(1)}, 0.0101, width=4).count() == 0


def test_edges(spark):
    empty = spark.createDataFrame([], "v string, w int")
    assert frequent_values(empty, F.col("v"), {"rows": F.lit(1)}, 0.01).count() == 0
    nulls = spark.createDataFrame([(None, 1)] * 5, "v string, w int")
    assert frequent_values(nulls, F.col("v"), {"rows": F.lit(1)}, 0.01).count() == 0
    one = spark.createDataFrame([("x" * 10_000, 0)], "v string, w int")
    assert [(r.measure, r.weight) for r in frequent_values(one, F.col("v"), {"rows": F.lit(1), "w": F.col("w")}, 0.5).collect()] == [("rows", 1)]
    with pytest.raises(PySparkException, match="negative"):
        frequent_values(spark.createDataFrame([("a", -1)], "v string, w int"), F.col("v"), {"w": F.col("w")}, 0.1)
