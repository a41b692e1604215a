"""Array kernels over the rows of one key at a time, without one Python call per Spark group."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], kernel: Callable, schema: StructType) -> DataFrame:
    """Rows of ``kernel(key, columns)`` for each key; ``columns`` are numpy arrays in the given order of rows.

    Rows are hash-partitioned and sorted by key, so a partition streams through the kernel and only the rows of one
    key are held. Callers bound these by making a tile of positions part of the key. The kernel returns a list of
    tuples in the order of ``schema``.
    """
    keys, order = list(keys), list(order)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None

        def flush(out: list[tuple]) -> pa.RecordBatch:
            columns = [list(c) for c in zip(*out)] or [[] for _ in arrow]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        def call() -> list[tuple]:
            rows = pa.Table.from_batches(held)
            return kernel(current, {n: rows.column(n).to_numpy() for n in rows.column_names if n not in keys})

        for batch in batches:
            if not batch.num_rows:
                continue
            out: list[tuple] = []
            codes = np.zeros(batch.num_rows, bool)
            for n in keys:
                column = batch.column(n)
                different = pa.compute.not_equal(column[1:], column[:-1]).fill_null(True)
                codes[1:] |= different.to_numpy(zero_copy_only=False)
            starts = [0, *np.flatnonzero(codes).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                if a == b:
                    continue
                key = tuple(batch.column(n)[a].as_py() for n in keys)
                if key != current:
                    if held:
                        out += call()
                    held, current = [], key
                held.append(batch.slice(a, b - a))
            yield flush(out)
        yield flush(call() if held else [])

    import pyarrow.compute  # noqa: F401

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
