import random

from pyspark.sql import functions as F

from locusloom.llm.components import connected_components


def brute(pairs):
    group = {}
    for a, b in pairs:
        if a is None or b is None or a == b:
            continue
        x, y = group.setdefault(a, {a}), group.setdefault(b, {b})
        if x is not y:
            x |= y
            for v in y:
                group[v] = x
    return {v: min(x) for v, x in group.items()}


def found(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string, v string, to string") if pairs and len(pairs[0]) == 4 else spark.createDataFrame(pairs, "a string, b string")
    rows = connected_components(df, F.col("a"), F.col("b")).collect()
    assert len(rows) == len({r.vertex for r in rows})
    return {r.vertex: r.component for r in rows}


def test_chain_star_and_pairs(spark):
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    star = [("hub", f"s{i}") for i in range(80)]
    rng = random.Random(9)
    loose = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(40)]
    dirty = [("x", None), (None, None), ("self", "self"), ("b", "a"), ("a", "b"), ("a", "b")]
    pairs = chain + star + loose + dirty
    assert found(spark, pairs) == brute(pairs)


def test_nothing_to_link(spark):
    assert found(spark, [("a", "a"), (None, "b")]) == {}
    assert connected_components(spark.createDataFrame([], "a string, b string"), F.col("a"), F.col("b")).count() == 0


def test_clashing_names(spark):
    assert found(spark, [("p", "q", "1", "2")]) == {"p": "p", "q": "p"}
