import random

from pyspark.sql import functions as F

from locusloom.operators.eager import eager_join_aggregate, heavy_groups, union_counts


def test_equals_expanded_join(spark):
    rng = random.Random(1)
    left = [(rng.choice(["k", "l", None, "hot", "hot", "hot"]), rng.choice(["p", None]), rng.choice([None, 1, 2]), "x") for _ in range(300)]
    right = [(rng.choice(["k", "l", "m", None, "hot"]), rng.choice(["q", "r"]), rng.choice([None, 5]), "y") for _ in range(60)]
    a = spark.createDataFrame(left, "key string, g string, v int, n string")
    b = spark.createDataFrame(right, "key string, h string, w int, n string")
    got = eager_join_aggregate(a, b, "key", "key", {"g": a["g"]}, {"h": b["h"]}, {"v": a["v"]}, {"w": b["w"]}, "n")
    want = {}
    for k, g, v, _ in left:
        for k2, h, w, _ in right:
            if k is not None and k == k2:
                x = want.setdefault((g, h), [0, None, None])
                x[0] += 1
                x[1] = x[1] if v is None else (x[1] or 0) + v
                x[2] = x[2] if w is None else (x[2] or 0) + w
    assert {(r.g, r.h): [r.n, r.v, r.w] for r in got.collect()} == want


def test_empty_and_heavy(spark):
    a = spark.createDataFrame([], "key string, v int")
    assert eager_join_aggregate(a, a, "key", "key", left_groups={"g": a["v"]}).count() == 0
    assert [tuple(r) for r in eager_join_aggregate(a, a, "key", "key", left_sums={"v": a["v"]}).collect()] == [(0, None)]
    groups = spark.createDataFrame([("a", 3), ("b", 97)], "g string, n long")
    assert [r.g for r in heavy_groups(groups, "n", F.lit(100), 0.03).collect()] == ["a", "b"]
    assert heavy_groups(groups, "n", F.lit(0), 0.03).count() == 0
    assert {r.g: r.n for r in union_counts([groups, groups], ["g"], ["n"]).collect()} == {"a": 6, "b": 194}
