"""Continuous periods, gaps and shared periods of integer intervals.

Each (entity, tile of positions) is a key with an ordered map of disjoint intervals and of the gaps between them as its
state; an insertion, in whatever order the intervals come, finds its neighbours by binary search, merges them and
updates the gaps. Tiles split a heavy entity over tasks: within a tile only the longest interval of each start is kept
(exact, and combined before the shuffle), so a group holds at most ``2 * tile`` rows however many the entity has. An
interval over many tiles goes to its first and last tile; the tiles between are one row of the entity's spans. Only the
outermost periods of a tile are stitched over tile edges, with a window over at most two rows per tile.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from locusloom.session import saved

TILE = 1 << 17


class IntervalMap:
    """Ordered disjoint intervals with inclusive ends, adjacent ones being one, and the gaps between them."""

    __slots__ = ("ends", "free", "starts")

    def __init__(self, items: Iterable[tuple[int, int]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.free: list[tuple[int, int]] = []
        for s, e in items:
            self.add(s, e)

    def add(self, start: int, end: int) -> None:
        """Insert one interval: the run of stored ones that it touches becomes one, the gaps beside it shrink or split."""
        starts, ends = self.starts, self.ends
        lo = bisect_left(ends, start - 1)
        hi = bisect_right(starts, end + 1, lo)
        if lo < hi:
            if hi == lo + 1 and starts[lo] <= start and ends[lo] >= end:
                return
            start, end = min(start, starts[lo]), max(end, ends[hi - 1])
        beside = [(ends[lo - 1] + 1, start - 1)] if lo else []
        if hi < len(starts):
            beside.append((end + 1, starts[hi] - 1))
        self.free[max(lo - 1, 0) : hi] = beside
        starts[lo:hi] = [start]
        ends[lo:hi] = [end]

    def items(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, self.ends))

    def gaps(self) -> list[tuple[int, int]]:
        """Free positions between neighbouring intervals."""
        return self.free

    def shared(self, other: IntervalMap) -> list[tuple[int, int]]:
        """Positions that both maps cover, as the longest stretches."""
        i = j = 0
        out = []
        while i < len(self.starts) and j < len(other.starts):
            lo, hi = max(self.starts[i], other.starts[j]), min(self.ends[i], other.ends[j])
            if lo <= hi:
                out.append((lo, hi))
            if self.ends[i] < other.ends[j]:
                i += 1
            else:
                j += 1
        return out


class KeyState:
    """State of one key: the map of all its intervals, and one for each side."""

    __slots__ = ("both", "sides")

    def __init__(self):
        self.both, self.sides = IntervalMap(), {}

    def add(self, side, start: int, end: int) -> None:
        self.both.add(start, end)
        if (own := self.sides.get(side)) is None:
            own = self.sides[side] = IntervalMap()
        own.add(start, end)

    def periods(self, spans: bool = False) -> list[tuple[str, int, int, bool]]:
        """Kind, start, end and ``open``. Open: the period may continue in, or bound a gap to, another tile.

        Of ``spans``, which know nothing of the tiles between them, all periods are open and no gap is known.
        """
        out = [] if spans else [("gap", s, e, False) for s, e in self.both.gaps()]
        families = [("covered", self.both.items())]
        if len(self.sides) == 2:
            one, two = self.sides.values()
            families.append(("shared", one.shared(two)))
        for kind, periods in families:
            last = len(periods) - 1
            out += [(kind, s, e, spans or i in (0, last)) for i, (s, e) in enumerate(periods)]
        return out


def _keyed_kernel(keys: Sequence[str], out_schema: pa.Schema):
    """Over rows sorted by ``keys`` alone: one key's state at a time, its intervals in the order in which they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, out = None, None, []

        def close() -> None:
            if state is not None:
                out.extend((*current, *p) for p in state.periods(current[-1] is None))

        def flush() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*out)] or [[] for _ in out_schema]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out_schema)], schema=out_schema)

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in [*keys, "__side", "__start", "__end"]]
            for *key, side, start, end in zip(*columns):
                if key != current:
                    close()
                    current, state = key, KeyState()
                state.add(side, start, end)
            yield flush()
        close()
        yield flush()

    return run


def clean_intervals(df: DataFrame, entity: dict[str, Column], start: Column, end: Column, side: Column) -> DataFrame:
    """Entity, side and ordered ends; rows with a null among them are left out, exchanged ends are put right."""
    picked = df.select(*(c.alias(n) for n, c in entity.items()), side.alias("__side"), start.cast("long").alias("__s"), end.cast("long").alias("__e"))
    picked = picked.dropna()
    return picked.select(*entity, "__side", F.least("__s", "__e").alias("__start"), F.greatest("__s", "__e").alias("__end"))


def interval_periods(
    df: DataFrame, entity: dict[str, Column], start: Column, end: Column, side: Column | None = None, tile: int = TILE
) -> DataFrame:
    """Covered stretches, the gaps between them and the stretches that both sides cover, per entity.

    Returns the entity columns, ``kind`` (``covered``, ``gap``, ``shared``), ``period_start`` and ``period_end`` (both
    inclusive). Directly adjacent intervals form one stretch. ``side`` tells the two families of intervals apart;
    ``shared`` needs exactly two distinct sides in the data of a tile and is absent without them. Null entity, side or
    ends: the row does not count. ``end < start``: exchanged. Repeats change nothing. An empty table gives no rows.
    """
    names = list(entity)
    side = F.lit("all") if side is None else side
    rows = clean_intervals(df, entity, start, end, side)
    edge = lambda c: F.floor(F.col(c) / F.lit(tile)).cast("long")
    begins, ends = F.col("__tile") * tile, (F.col("__tile") + 1) * tile - 1
    spread = rows.withColumns({"__first": edge("__start"), "__last": edge("__end")})
    cut = spread.withColumn("__tile", F.explode(F.array_distinct(F.array("__first", "__last")))).select(
        *names, "__tile", "__side", F.greatest("__start", begins).alias("__start"), F.least("__end", ends).alias("__end")
    )
    inner = spread.where(F.col("__last") > F.col("__first") + 1).select(
        *names, F.lit(None).cast("long").alias("__tile"), "__side", ((F.col("__first") + 1) * tile).alias("__start"), (F.col("__last") * tile - 1).alias("__end")
    )
    longest = lambda rows: rows.groupBy(*names, "__tile", "__side", "__start").agg(F.max("__end").alias("__end"))
    spans = longest(inner)
    # tiles of which other intervals hold a part, and which a span covers as a whole
    held = cut.select(*names, "__tile").join(spans.select(*names, "__side").distinct(), names).distinct()
    both = held.select(*names, "__side", "__tile", begins.alias("__start"), F.lit(None).cast("long").alias("__end")).unionByName(spans)
    reach = F.max("__end").over(Window.partitionBy(*names, "__side").orderBy("__start").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    whole = both.withColumn("__reach", reach).where((F.col("__reach") >= ends) & F.col("__tile").isNotNull()).select(*names, "__tile", "__side", "__start", ends.alias("__end"))
    keys = [*names, "__tile"]
    rows = longest(cut).unionByName(spans).unionByName(whole)
    types = {n: rows.schema[n].dataType for n in keys} | {"kind": T.StringType(), "__start": T.LongType(), "__end": T.LongType(), "__open": T.BooleanType()}
    arrow = pa.schema([(n, to_arrow_type(t)) for n, t in types.items()])
    parts = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _keyed_kernel(keys, arrow), T.StructType([T.StructField(n, t) for n, t in types.items()])
    )
    return stitch_tiles(saved(parts, "tile-periods"), names)  # read twice


def stitch_tiles(parts: DataFrame, names: list[str]) -> DataFrame:
    """Periods over tile edges: outermost periods that touch become one, and the gaps between tiles are added."""
    closed = parts.where(~F.col("__open")).select(*names, "kind", F.col("__start").alias("period_start"), F.col("__end").alias("period_end"))
    line = Window.partitionBy(*names, "kind").orderBy("__start")
    edges = (
        parts.where("__open")
        .withColumn("__before", F.max("__end").over(line.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("__tile_before", F.lag("__tile").over(line))
        .withColumn("__new", F.coalesce(F.col("__start") > F.col("__before") + 1, F.lit(True)))
        .withColumn("__island", F.sum(F.col("__new").cast("long")).over(line))
    )
    # within a tile its own state knows the gaps; a span has no tile
    elsewhere = F.col("__tile").isNull() | F.col("__tile_before").isNull() | (F.col("__tile_before") < F.col("__tile"))
    gap_before = (F.col("kind") == "covered") & F.col("__new") & F.col("__before").isNotNull() & elsewhere
    period = F.struct("kind", F.col("__island"), F.col("__start").alias("s"), F.col("__end").alias("e"))
    gap = F.struct(F.lit("gap").alias("kind"), F.col("__island"), (F.col("__before") + 1).alias("s"), (F.col("__start") - 1).alias("e"))
    stitched = (
        edges.select(*names, F.explode(F.when(gap_before, F.array(period, gap)).otherwise(F.array(period))).alias("x"))
        .select(*names, "x.*")
        .groupBy(*names, "kind", "__island")
        .agg(F.min("s").alias("period_start"), F.max("e").alias("period_end"))
        .drop("__island")
    )
    return closed.unionByName(stitched)
