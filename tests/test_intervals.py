import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from locusloom.operators.intervals import IntervalMap, interval_periods
from locusloom.operators.overlaps import overlap_groups, overlap_join

SCHEMA = "ent string, side string, start long, end long, kind string"


def runs(points):
    out = []
    for p in sorted(points):
        if out and p == out[-1][1] + 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return [tuple(x) for x in out]


def brute(rows):
    out = set()
    for ent in {r[0] for r in rows if r[0] is not None}:
        cover = {"a": set(), "b": set()}
        for e, side, s, t, _ in rows:
            if e == ent and None not in (side, s, t):
                cover[side] |= set(range(min(s, t), max(s, t) + 1))
        both = runs(cover["a"] | cover["b"])
        out |= {(ent, "covered", *x) for x in both}
        out |= {(ent, "gap", x[1] + 1, y[0] - 1) for x, y in zip(both, both[1:])}
        out |= {(ent, "shared", *x) for x in runs(cover["a"] & cover["b"])}
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 12)), max_size=30))
def test_interval_map_equals_sets(items):
    held = IntervalMap((s, s + n) for s, n in items)
    points = {p for s, n in items for p in range(s, s + n + 1)}
    assert held.items() == runs(points)
    assert held.gaps() == [(a[1] + 1, b[0] - 1) for a, b in zip(held.items(), held.items()[1:])]
    assert all(a[1] + 1 < b[0] for a, b in zip(held.items(), held.items()[1:]))


def test_periods_over_tiles(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xyz"), rng.choice("ab"), s := rng.randrange(400), s + rng.choice([0, 1, 5, 40]), "k") for _ in range(250)]
    rows += [("hot", "a", i, i, "k") for i in range(0, 300, 2)] + [("hot", "b", 0, 299, "k")] * 5
    rows += [("swap", "a", 20, 3, "k"), (None, "a", 1, 2, "k"), ("n", None, 1, 2, "k"), ("n", "a", None, 2, "k"), ("n", "a", 5, 5, "k"), ("n", "a", 6, 9, "k")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = interval_periods(df, {"ent": F.col("ent")}, F.col("start"), F.col("end"), F.col("side"), tile=16)
    got = [tuple(r) for r in found.select("ent", "kind", "period_start", "period_end").collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)


def test_intervals_over_many_tiles(spark):
    rng = random.Random(11)
    rows = [(rng.choice("xyz"), rng.choice("ab"), s := rng.randrange(900), s + rng.choice([1, 3, 9, 90, 260]), "k") for _ in range(70)]
    df = spark.createDataFrame(rows, SCHEMA)
    for tile in (8, 64):
        found = interval_periods(df, {"ent": F.col("ent")}, F.col("start"), F.col("end"), F.col("side"), tile=tile)
        got = [tuple(r) for r in found.select("ent", "kind", "period_start", "period_end").collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows)
    # one interval of 10^15 positions is three rows, whatever the tile
    huge = spark.createDataFrame([("h", "a", 5, 10**15, ""), ("h", "b", 7, 9, ""), ("h", "b", 4000, 4001, ""), ("h", "b", 10**15 + 5, 10**15 + 6, "")], SCHEMA)
    found = interval_periods(huge, {"ent": F.col("ent")}, F.col("start"), F.col("end"), F.col("side"), tile=16)
    want = {("covered", 5, 10**15), ("gap", 10**15 + 1, 10**15 + 4), ("covered", 10**15 + 5, 10**15 + 6), ("shared", 7, 9), ("shared", 4000, 4001)}
    assert {(r.kind, r.period_start, r.period_end) for r in found.collect()} == want


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert interval_periods(df, {"ent": F.col("ent")}, F.col("start"), F.col("end"), F.col("side")).count() == 0


def test_overlap_join_once_per_pair(spark):
    rng = random.Random(5)
    make = lambda tag, n: [("c", f"{tag}{i}", s := rng.randrange(5000), s + rng.randrange(700)) for i in range(n)]
    a, b = make("a", 60), make("b", 60)
    left = spark.createDataFrame(a, "chromosome string, id_a string, start long, end long")
    right = spark.createDataFrame(b, "chromosome string, id_b string, start long, end long")
    for buffer in (0, 30):
        got = sorted((r.id_a, r.id_b) for r in overlap_join(left, right, ["chromosome"], buffer, size=256).collect())
        assert got == sorted((x[1], y[1]) for x in a for y in b if y[2] <= x[3] + buffer and x[2] <= y[3] + buffer)


def test_overlap_groups(spark):
    rows = [("1", "A1", 100, 121), ("1", "B1", 105, 126), ("1", "far", 127, 140), ("10", "A10", 500, 521)]
    df = spark.createDataFrame(rows, "chromosome string, cluster string, start long, end long")
    got = {r.cluster: (r.group_start, r.group_end) for r in overlap_groups(df, ["chromosome"], 0).collect()}
    assert got == {"A1": (100, 126), "B1": (100, 126), "far": (127, 140), "A10": (500, 521)}
    near = {r.cluster: r.group_end for r in overlap_groups(df, ["chromosome"], 1).collect()}
    assert near["A1"] == 140
