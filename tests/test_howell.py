import random

import numpy as np
import pytest

from locusloom.operators import howell as H

PHASE = 21
SIZE = 210


def by_hand(pos, abun, start, phase, strand, exact):
    """Register scores of one window by the rules, cycle by cycle."""
    reads = {p: a for p, a in zip(pos, abun) if start <= p <= start + SIZE - 1}
    out = []
    for register in range(phase):
        inside = quarantined = filled = 0
        for cycle in range(10):
            at = start + register + cycle * phase if strand == "w" else start + SIZE - 1 - register - cycle * phase
            sides = [p for p in (at - 1, at + 1) if p in reads]
            if at in reads:
                inside += reads[at]
                filled += 1
                quarantined += 0 if exact else sum(reads[p] for p in sides)
            elif sides and not exact:
                best = max(sides, key=lambda p: reads[p])
                inside += reads[best]
                filled += 1
                quarantined += sum(reads[p] for p in sides if p != best)
        outside = max(0, sum(reads.values()) - quarantined - inside)
        out.append((min(filled, 10) - 2) * np.log(1 + 10 * inside / (1 + outside)) if filled > 3 and inside > 0 else 0.0)
    return out


@pytest.mark.parametrize("strand", ["w", "c"])
def test_register_tables_equal_rules(strand):
    rng = random.Random(7)
    for _ in range(6):
        pos = np.array(sorted(rng.sample(range(1000, 1300), rng.choice([5, 40, 150]))))
        abun = np.array([rng.choice([0, 1, 3, 9]) for _ in pos], float)
        starts = np.arange(980, 1100, 13)
        tables = H.register_tables(pos, abun, starts, PHASE, strand)
        for i, s in enumerate(starts.tolist()):
            np.testing.assert_allclose(tables["exact"][i], by_hand(pos, abun, s, PHASE, strand, True), atol=1e-9)
            np.testing.assert_allclose(tables["relaxed"][i], by_hand(pos, abun, s, PHASE, strand, False), atol=1e-9)


def frames(spark, rows):
    positions = spark.createDataFrame(rows, "clusterID string, strand string, pos long, abun long")
    spans = positions.groupBy("clusterID").agg({"pos": "min"}).withColumnRenamed("min(pos)", "lo").join(positions.groupBy("clusterID").agg({"pos": "max"}).withColumnRenamed("max(pos)", "hi"), "clusterID")
    return positions, spans


def test_ladders(spark):
    exact = [("exact", "w", p, a) for p, a in ((100, 12), (121, 11), (142, 13), (163, 10))]
    wobble = [("wobble", "w", p, a) for p, a in ((99, 12), (122, 11), (141, 13), (164, 10))]
    positions, spans = frames(spark, exact + wobble)
    scan = H.howell_scan(positions, spans, "clusterID", PHASE)
    got = {r.clusterID: r for r in H.peak_ambiguity(positions, scan, "clusterID", PHASE).collect()}
    scores = {r.clusterID: r for r in scan.collect()}
    assert scores["exact"].score > 0 and scores["wobble"].score > 0 and scores["wobble"].strict_score == 0
    e, w = got["exact"], got["wobble"]
    assert e.exact_support > 0 and e.ambiguity_count == 0 and e.extension_span_nt == 210 and e.origin_class == "unique_origin"
    assert w.exact_support == 0 and w.ambiguity_count is None and w.origin_class == "insufficient_exact_support"


def test_tiles_change_nothing(spark, monkeypatch):
    rng = random.Random(11)
    rows = [("c", s, p, rng.randrange(1, 20)) for s in "wc" for p in sorted(rng.sample(range(5000, 9500), 300))]
    positions, spans = frames(spark, rows)
    whole = sorted(map(tuple, H.howell_scan(positions, spans, "clusterID", PHASE).collect()))
    trace = sorted(map(str, H.howell_trace(positions, "clusterID", PHASE).collect()))
    monkeypatch.setattr(H, "TILE", 1 << 20)
    assert sorted(map(tuple, H.howell_scan(positions, spans, "clusterID", PHASE).collect())) == whole
    assert sorted(map(str, H.howell_trace(positions, "clusterID", PHASE).collect())) == trace


def test_register_reads_take_the_better_neighbour(spark):
    rows = [("c", "w", 100, 5), ("c", "w", 125, 7), ("c", "w", 123, 3), ("c", "w", 147, 4), ("c", "w", 149, 4)]
    positions = spark.createDataFrame(rows, "clusterID string, strand string, pos long, abun long")
    peaks = spark.createDataFrame([("c", "w", 100)], "clusterID string, strand string, origin long")
    got = {r.expected: (r.pos, r.register_class) for r in H.register_reads(positions, peaks, "clusterID", 24).collect()}
    assert got == {100: (100, "core_exact"), 124: (125, "core_offset"), 148: (147, "core_offset")}
