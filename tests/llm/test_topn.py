import math
import random

from pyspark.sql import functions as F

from locusloom.llm.topn import top_n_per_group

SCHEMA = "g string, item string, s double, rank int, score string"


def picked(df, n, descending=False):
    rows = top_n_per_group(df, F.col("g"), F.col("item"), F.col("s"), n, descending)
    return sorted((r.group_key, r["rank"], r.item_key, r.score) for r in rows.collect())


def brute(rows, n, descending):
    out = []
    for g in {r[0] for r in rows if r[0] is not None}:
        kept = {(s, i) for g2, i, s, *_ in rows if g2 == g and i is not None and s is not None and not math.isnan(s)}
        best = sorted(kept, key=lambda x: (-x[0] if descending else x[0], x[1].encode()))[:n]
        out += [(g, k + 1, i, s) for k, (s, i) in enumerate(best)]
    return sorted(out)


def test_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice(["x", "Y", "z", "ä", None]), rng.choice([1.0, 2.0, None, math.nan, -0.5]), 1, "c") for _ in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    for n in (1, 3, 50):
        for descending in (False, True):
            assert picked(df, n, descending) == brute(rows, n, descending)
    assert picked(df, 0) == []


def test_repeats_in_many_tasks(spark):
    rows = spark.range(0, 4000, 1, 20).select(F.lit("g").alias("g"), F.concat(F.lit("i"), F.col("id") % 7).alias("item"), (F.col("id") % 7).cast("double").alias("s"))
    assert picked(rows, 3) == [("g", k + 1, f"i{k}", float(k)) for k in range(3)]


def test_repeats_ties_and_empty(spark):
    rows = [("g", "b", 1.0, 0, "")] * 5 + [("g", "a", 1.0, 0, ""), ("g", "c", 2.0, 0, "")]
    assert [x[2] for x in picked(spark.createDataFrame(rows, SCHEMA), 2)] == ["a", "b"]
    assert picked(spark.createDataFrame([], SCHEMA), 2) == []


def test_group_limit_on_both_sides_of_the_shuffle(spark):
    df = spark.createDataFrame([("g", "b", 1.0, 0, "")], SCHEMA)
    # a dense rank of the parts before the repeats go, and the rank of the whole group behind
    plan = top_n_per_group(df, F.col("g"), F.col("item"), F.col("s"), 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4 and plan.count("dense_rank") >= 2
