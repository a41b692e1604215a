import os
from pathlib import Path

import duckdb
import pytest

from locusloom.llm import queries as Q

DATA = Path(os.environ.get("LOCUSLOOM_TEST_DATA", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}'")
    ours, theirs = Q.QUERIES[name](spark, str(DATA)).toPandas(), con.sql(Q.SQL[name]).df()
    key = sorted(ours.columns)
    assert key == sorted(theirs.columns)
    assert sorted(map(tuple, ours[key].astype(str).values)) == sorted(map(tuple, theirs[key].astype(str).values))


def rows(spark, name):
    return Q.QUERIES[name](spark, str(DATA)).collect()


def test_counts_are_exact_and_estimates_never_low(spark):
    counts = rows(spark, "p2_counts")
    assert {(r.measure, r.tag_seq, r.weight) for r in counts} == {tuple(r) for r in rows(spark, "p2_weights")} and all(r.estimate >= r.weight for r in counts)


def test_ids_and_containers(spark):
    """Every document has its ids; the containers hold exactly their tokens, within all three capacities."""
    ids = {r.doc_id: r.ids for r in rows(spark, "p6_ids")}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    assert ids.keys() == docs.keys() and all((ids[i] == []) == (not docs[i]) for i in docs)
    bins, of = {}, {}
    for r in rows(spark, "p7_containers"):
        bins.setdefault(r.container_id, []).append(r.n_tokens)
        of[r.doc_id] = of.get(r.doc_id, 0) + r.n_tokens
    assert of == {i: len(x) for i, x in ids.items() if docs[i] is not None}  # a null text takes no place
    for sizes in bins.values():
        assert sum(sizes) <= Q.CONTAINER and len(sizes) <= 256 and (len(sizes) == 1 or sum(n * n for n in sizes) <= Q.CONTAINER_COST)
    assert sum(map(sum, bins.values())) >= 0.9 * Q.CONTAINER * (len(bins) - 1)


def test_found_and_sources_agree(spark):
    found, sources = rows(spark, "p8_found"), rows(spark, "p8_sources")
    docs = {r.doc_id: r.source for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "source").collect()}
    cut = {}
    for r in found:
        cut[docs[r.doc_id]] = cut.get(docs[r.doc_id], 0) + 1
    assert len({r.doc_id for r in found}) == len(found) and cut == {r.source: r.cut for r in sources if r.cut}
    names = ("copy", "left_open", "limit", "closing_word", "translation", "unclosed")
    assert all(r.cut == sum(r[f"by_{n}"] for n in names) and abs(r.share - r.cut / r.texts) < 1e-12 for r in sources)
