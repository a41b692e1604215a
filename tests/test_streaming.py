import random

from pyspark.sql import functions as F

from locusloom.operators.intervals import interval_periods
from locusloom.streaming.counts import first_loads, session_counts, windowed_counts
from locusloom.streaming.intervals import current_periods, streaming_periods


def run(df, name, mode):
    query = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    query.processAllAvailable()
    query.stop()
    return df.sparkSession.table(name).collect()


def test_intervals_in_state(spark, tmp_path):
    """Over tile edges, late and repeated rows, two sides: the stream says what the batch operator says of all rows."""
    rng = random.Random(6)
    make = lambda: (rng.choice("ef"), rng.choice("ab"), s := rng.randrange(300), s + rng.choice([0, 2, 9, 50]))
    parts = [[make() for _ in range(25)] for _ in range(3)]
    parts[1] += [("e", "a", None, 3), (None, "a", 1, 3), ("e", "a", 90, 20), parts[0][0]]
    schema = "entity string, side string, start long, end long"
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run(streaming_periods(stream, ["entity"], "start", "end", "side", tile=16), "periods", "update")
    emitted = spark.table("periods")
    assert emitted.agg({"version": "max"}).first()[0] == 3
    got = sorted(tuple(r) for r in current_periods(emitted, ["entity"]).select("entity", "kind", "period_start", "period_end").collect())
    every = spark.createDataFrame([r for p in parts for r in p], schema)
    want = interval_periods(every, {"entity": F.col("entity")}, F.col("start"), F.col("end"), F.col("side"), tile=16)
    assert got == sorted(tuple(r) for r in want.select("entity", "kind", "period_start", "period_end").collect())
    assert {k for _, k, *_ in got} == {"covered", "gap", "shared"}


def test_windowed_counts(spark, tmp_path):
    rows = [("2025-01-01 00:10:00", "l", 2), ("2025-01-01 00:50:00", "l", 3), ("2025-01-01 03:00:00", "l", 1)]
    df = spark.createDataFrame(rows, "t string, alib string, abun long").select(F.to_timestamp("t").alias("t"), "alib", "abun")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    out = run(windowed_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "t", ["alib"]), "counts", "complete")
    assert sorted((r.n, r.abun) for r in out) == [(1, 1), (2, 5)]


def test_sessions_and_late_rows(spark, tmp_path):
    stamped = lambda rows: spark.createDataFrame(rows, "t string, alib string, abun long").select(F.to_timestamp("t").alias("t"), "alib", "abun")
    first = [("2025-01-01 00:00:00", "l", 1), ("2025-01-01 00:20:00", "l", 2), ("2025-01-01 00:51:00", "l", 4), ("2025-01-01 00:10:00", "m", 8), ("2025-01-01 00:20:00", "l", 2)]
    second = [("2025-01-01 06:00:00", "l", 16)]
    third = [("2025-01-01 00:05:00", "l", 32), ("2025-01-01 09:00:00", "l", 64)]  # the first one is too late
    stream = lambda: spark.readStream.schema("t timestamp, alib string, abun long").parquet(str(tmp_path / "in"))
    stamped(first).coalesce(1).write.parquet(str(tmp_path / "in"))
    started = {n: df.writeStream.outputMode("append").format("memory").queryName(n).start() for n, df in (("sessions", session_counts(stream(), "t", ["alib"])), ("once", first_loads(stream(), "t", ["alib", "abun"])))}
    for rows in (second, third):
        for query in started.values():
            query.processAllAvailable()
        stamped(rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for query in started.values():
        query.processAllAvailable()
        query.stop()
    assert sorted((r.alib, r.n, r.abun) for r in spark.table("sessions").collect()) == [("l", 1, 4), ("l", 1, 16), ("l", 3, 5), ("m", 1, 8)]
    assert sorted(r.abun for r in spark.table("once").collect()) == [1, 2, 4, 8, 16, 64]
