from pyspark.sql import functions as F

from locusloom.operators.numbering import dense_numbers, grid


def test_numbers_are_dense_over_ranges(spark):
    rows = [("hot", i) for i in range(500)] + [("cold", 3), ("cold", 1)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(7)
    got = dense_numbers(df, ["k"], [F.col("v").desc()]).collect()
    assert {r.number for r in got if r.k == "hot"} == set(range(1, 501))
    assert all(r.number == 500 - r.v for r in got if r.k == "hot")
    assert {(r.v, r.number) for r in got if r.k == "cold"} == {(3, 1), (1, 2)}
    assert dense_numbers(df.limit(0), ["k"], [F.col("v").asc()]).count() == 0


def test_grid(spark):
    cells = spark.createDataFrame([("1:1..2", "A", 2), ("1:1..2", "A", 1), ("2:3..4", "B", 2), ("2:3..4", "X", 2)], "locus string, alib string, cell int")
    got = {r.locus: (r.A, r.B) for r in grid(cells, "locus", "alib", "cell", ["A", "B"], 0).collect()}
    assert got == {"1:1..2": (1, 0), "2:3..4": (0, 2)}
    assert grid(cells, "locus", "alib", "cell", ["B"]).where("B is null").count() == 1


def test_scratch_removes_its_tables(spark):
    from pathlib import Path

    from locusloom.session import ensure_checkpoint_dir, saved, scratch

    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "locusloom"
    tables = lambda: {p.name for p in folder.glob("*-kept")} if folder.exists() else set()
    before = tables()
    with scratch(spark):
        outer = saved(spark.range(3).toDF("i"), "kept")
        with scratch(spark):
            assert saved(spark.range(4).toDF("i"), "kept").count() == 4
        assert outer.count() == 3 and len(tables() - before) == 1
    assert tables() == before
    saved(spark.range(1).toDF("i"), "kept")
    assert len(tables() - before) == 1
