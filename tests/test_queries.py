"""Every core query with an SQL twin gives what DuckDB gives on the smallest tables."""

import math
import os
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

from locusloom.plans import registry

DATA = Path(os.environ.get("LOCUSLOOM_TEST_DATA", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if isinstance(v, (list, np.ndarray)):
        return tuple(map(plain, v))
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, (float, np.floating)) and math.isnan(v):
        return "NaN"  # no null, and unlike one it does not equal itself where results are compared
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, float, np.integer, np.floating)):
        return round(float(v), 6)
    return v


def rows(table):
    """Rows of an Arrow table, in which nulls and NaN differ."""
    names = sorted(table.column_names)
    return sorted((tuple(map(plain, r)) for r in zip(*(table.column(n).to_pylist() for n in names))), key=repr)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, duck, name):
    ours, theirs = registry.QUERIES[name](spark, str(DATA)).toArrow(), duck.sql(registry.SQL[name]).to_arrow_table()
    assert sorted(ours.column_names) == sorted(theirs.column_names)
    got = rows(ours)
    assert got == rows(theirs)
    assert not any(v == "NaN" for r in got for v in r)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, str(DATA)).count() > 0 or name == "n11_peak_competitors"  # the smallest tables have none


def test_total_abundance_has_all_cells(spark):
    cells = lambda name: {(r.identifier, r.alib): r for r in registry.QUERIES[name](spark, str(DATA)).collect()}
    every, phas, report = cells("v3_total_abundance_cells"), cells("v2_abundance_cells"), cells("v1_report_cells")
    assert every.keys() == report.keys() and {k for k, r in every.items() if r.is_phas} == phas.keys() <= every.keys()
    assert all(every[k].log_total == r.log_total for k, r in phas.items())
