"""Periods of intervals that arrive over time: the interval maps of each entity and tile in keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from locusloom.operators.intervals import TILE, IntervalMap, KeyState, clean_intervals, stitch_tiles

_STATE = "version long, sides array<string>, starts array<array<long>>, ends array<array<long>>"
_OUT = [("version", T.LongType()), ("kind", T.StringType()), ("__start", T.LongType()), ("__end", T.LongType()), ("__open", T.BooleanType())]


def _update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held, version = KeyState(), 0
    if state.exists:
        version, sides, starts, ends = state.get
        for side, s, e in zip(sides, starts, ends):
            own = held.sides[side] = IntervalMap()
            for a, b in zip(s, e):
                own.add(a, b)
                held.both.add(a, b)
    for rows in batches:
        for side, start, end in zip(rows["__side"], rows["__start"], rows["__end"]):
            held.add(side, int(start), int(end))
    maps = list(held.sides.values())
    state.update((version + 1, list(held.sides), [m.starts for m in maps], [m.ends for m in maps]))
    frame = pd.DataFrame([(version + 1, *p) for p in held.periods()], columns=[n for n, _ in _OUT])
    for i, value in enumerate(key):
        frame.insert(i, f"__key_{i}", value)
    yield frame


def streaming_periods(intervals: DataFrame, entity: list[str], start: str, end: str, side: str | None = None, tile: int = TILE) -> DataFrame:
    """Periods of each entity and tile so far, after every trigger in which the tile got intervals.

    A stream in update mode for a table that :func:`current_periods` reads: ``entity``, ``__tile``, ``version``, ``kind``,
    ``__start``, ``__end`` and ``__open``; the rows of a tile with the highest version stand for it. Insertions find
    their neighbours in the stored map by binary search. A busy entity is many keys, and the state of a key is bounded
    by its tile, at most ``tile`` intervals for each side; it stays as long as the stream, as any interval may still
    come. Late and repeated intervals change nothing that was right. Nulls among entity, side and ends do not count,
    exchanged ends are put right. An interval goes to every tile that it touches, so choose a tile that most do not leave.
    """
    rows = clean_intervals(intervals, {n: F.col(n) for n in entity}, F.col(start), F.col(end), F.col(side) if side else F.lit("all"))
    edge = lambda c: F.floor(F.col(c) / tile).cast("long")
    cut = rows.withColumn("__tile", F.explode(F.sequence(edge("__start"), edge("__end")))).select(
        *entity, "__tile", "__side", F.greatest("__start", F.col("__tile") * tile).alias("__start"), F.least("__end", (F.col("__tile") + 1) * tile - 1).alias("__end")
    )
    keys = [*entity, "__tile"]
    out = T.StructType([T.StructField(f"__key_{i}", cut.schema[k].dataType) for i, k in enumerate(keys)] + [T.StructField(n, t) for n, t in _OUT])
    found = cut.groupBy(*keys).applyInPandasWithState(_update, out, _STATE, "update", GroupStateTimeout.NoTimeout)
    return found.withColumnsRenamed({f"__key_{i}": k for i, k in enumerate(keys)})


def current_periods(emitted: DataFrame, entity: list[str]) -> DataFrame:
    """``entity``, ``kind``, ``period_start`` and ``period_end`` as of now: the latest rows of each tile, stitched over tile edges."""
    keys = [*entity, "__tile"]
    latest = emitted.groupBy(*(F.col(k).alias(f"__of_{k}") for k in keys)).agg(F.max("version").alias("__newest"))
    same = [F.col(k) == F.col(f"__of_{k}") for k in keys]
    newest = emitted.alias("rows").join(latest, [*same, F.col("version") == F.col("__newest")])
    return stitch_tiles(newest.select(*keys, "kind", "__start", "__end", "__open"), entity)
