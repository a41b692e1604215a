"""Phasing scores of windows of ten cycles: dense scans, anchored traces, ambiguity and crowding of the peak.

All registers of a window are read from running sums over cycles, so a window costs one gather per register. A long
cluster is cut in tiles of window starts that share the positions at their edge; no task holds more than one tile.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusloom.functions.loci import phase_shift, register_relation
from locusloom.operators.intervals import interval_periods
from locusloom.operators.keyed import by_key

CYCLES, TILE = 10, 1 << 12
#: Positions that a window must hold to score more than 0.
LEAST_FILLED = 4
AMBIGUOUS, CROWDING_GAP = 0.90, 4.0


def _score(inside: np.ndarray, total: np.ndarray, filled: np.ndarray) -> np.ndarray:
    outside = np.maximum(0.0, total - inside)
    score = (np.minimum(filled, CYCLES) - 2) * np.log1p(10.0 * inside / (1.0 + outside))
    return np.where((filled >= LEAST_FILLED) & (inside > 0), score, 0.0)


def register_tables(pos: np.ndarray, abun: np.ndarray, starts: np.ndarray, phase: int, strand: str, kinds: tuple[str, ...] = ("relaxed", "exact")) -> dict[str, np.ndarray]:
    """For each window start (row) and register (column): scores, in-phase sums and fillings of the asked ``kinds``.

    Exact: reads at the expected position of a cycle. Relaxed: else those of the better neighbour (the left one if
    equal); the other neighbours of a counted position do not count against the register. Neighbours outside the window
    are not looked at. Registers count from the window's start on Watson and from its end on Crick.
    """
    size = CYCLES * phase
    base = int(starts.min()) - 1
    length = int(starts.max()) - base + size + 2
    keep = (pos >= base) & (pos < base + length)
    at = pos[keep] - base
    a, here = np.zeros(length), np.zeros(length, bool)
    a[at], here[at] = abun[keep], True
    n = length - (CYCLES - 1) * phase
    over = lambda x: sum(x[c * phase : c * phase + n] for c in range(CYCLES))
    rows = starts - base
    grid = rows[:, None] + np.arange(phase)
    running = np.append(0.0, a.cumsum())
    total = (running[rows + size] - running[rows])[:, None]
    out = {}
    if "relaxed" in kinds:
        inside, spared, filled = _with_neighbours(a, here, over, rows, grid, size)
        out |= {"relaxed": _score(inside, total - spared, filled), "relaxed_inside": inside, "relaxed_total": total - spared, "relaxed_filled": filled}
    if "exact" in kinds:
        inside = over(a)[grid]
        out |= {"exact": _score(inside, total, over(here.astype(float))[grid]), "inside": inside}
    if strand == "c":
        out = {k: v[:, ::-1] for k, v in out.items()}
    count = np.append(0, here.cumsum())
    out["occupied"] = count[rows + size] > count[rows]
    return out


def _with_neighbours(a: np.ndarray, here: np.ndarray, over, rows: np.ndarray, grid: np.ndarray, size: int) -> list[np.ndarray]:
    """In-phase, quarantined and filled of each window and register where neighbours may stand in."""
    left, right = np.append(0.0, a[:-1]), np.append(a[1:], 0.0)
    on_left, on_right = np.append(False, here[:-1]), np.append(here[1:], False)

    def cycle(l_on, r_on):
        """The same of one expected position, seeing the given neighbours."""
        x, y = np.where(l_on, left, 0.0), np.where(r_on, right, 0.0)
        inside = np.where(here, a, np.maximum(x, y))
        return inside, np.where(here, x + y, np.where(l_on & r_on, np.minimum(x, y), 0.0)), (here | l_on | r_on).astype(float)

    none = np.zeros(len(a), bool)
    tables = []
    for whole, first, last in zip(cycle(on_left, on_right), cycle(none, on_right), cycle(on_left, none)):
        table = over(whole)[grid]
        table[:, 0] += (first - whole)[rows]
        table[:, -1] += (last - whole)[rows + size - 1]
        tables.append(table)
    return tables


def _strict(tables: dict[str, np.ndarray]) -> np.ndarray:
    """Score of the register with the largest in-phase sum (the first one)."""
    best = tables["inside"].argmax(axis=1)
    return tables["exact"][np.arange(len(best)), best]


def _starts(lo: int, hi: int, first: int, size: int) -> tuple[int, int]:
    """First and last window start of a strand: one window at its first position where the cluster is shorter."""
    return (lo, hi - size + 1) if hi - size + 1 >= lo else (first, first)


def _tiled(positions: DataFrame, cluster: str, size: int) -> DataFrame:
    """Positions in every tile of window starts whose windows can hold them."""
    tiles = F.sequence(F.floor((F.col("pos") - size + 1) / TILE).cast("long"), F.floor(F.col("pos") / TILE).cast("long"))
    return positions.withColumn("__tile", F.explode(tiles))


def strand_bounds(positions: DataFrame, spans: DataFrame, cluster: str) -> DataFrame:
    """The cluster's ends (``lo``, ``hi``) and the first position (``first``) of each strand."""
    first = positions.groupBy(cluster, "strand").agg(F.min("pos").alias("first"))
    return first.join(spans.select(cluster, "lo", "hi"), cluster)


def howell_scan(positions: DataFrame, spans: DataFrame, cluster: str, phase: int) -> DataFrame:
    """Best relaxed and strict window of each cluster and strand over all window starts.

    ``positions``: ``cluster``, ``strand``, ``pos``, ``abun``, one row per position of reads at the phase length.
    ``spans``: ``cluster``, ``lo``, ``hi`` over all reads. The first of equally good windows wins. A strand without
    such reads has no row.
    """
    size = CYCLES * phase
    kind = positions.schema[cluster].dataType

    def kernel(key, rows):
        lo, hi = _starts(int(rows["lo"][0]), int(rows["hi"][0]), int(rows["first"][0]), size)
        tile = key[2]
        lo, hi = max(lo, tile * TILE), min(hi, (tile + 1) * TILE - 1)
        pos, abun = rows["pos"][1:], rows["abun"][1:].astype(float)  # the first row brings the bounds
        starts = np.arange(max(lo, int(pos[0]) - size + 1), min(hi, int(pos[-1])) + 1)
        starts = starts[np.searchsorted(pos, starts + size) - np.searchsorted(pos, starts) >= LEAST_FILLED]  # others score 0
        if not len(starts):
            return []
        tables = register_tables(pos, abun, starts, phase, key[1])
        relaxed, strict = tables["relaxed"].max(axis=1), _strict(tables)
        i, j = int(relaxed.argmax()), int(strict.argmax())
        return [(key[0], key[1], float(relaxed[i]), int(starts[i]), float(strict[j]), int(starts[j]))]

    schema = T.StructType([T.StructField(cluster, kind), T.StructField("strand", T.StringType())] + [T.StructField(n, t) for n, t in (("relaxed", T.DoubleType()), ("relaxed_start", T.LongType()), ("strict", T.DoubleType()), ("strict_start", T.LongType()))])
    ends = strand_bounds(positions, spans, cluster)
    keys = [cluster, "strand", "__tile"]
    tiled = _tiled(positions, cluster, size).select(*keys, "pos", "abun")
    # the bounds come to each tile as one row ahead of the others, not to every position
    ahead = tiled.select(*keys).distinct().join(ends, [cluster, "strand"]).select(*keys, F.lit(-(2**62)).alias("pos"), F.lit(0).cast("long").alias("abun"), "lo", "hi", "first")
    tiles = by_key(tiled.unionByName(ahead, allowMissingColumns=True), keys, ["pos"], kernel, schema)
    best = tiles.groupBy(cluster, "strand").agg(*(F.max(F.struct(F.col(s).alias("score"), (-F.col(f"{s}_start")).alias("at"))).alias(s) for s in ("relaxed", "strict")))
    lower = F.when(F.col("hi") - size + 1 >= F.col("lo"), F.col("lo")).otherwise(F.col("first"))
    value = lambda s: F.coalesce(F.col(f"{s}.score"), F.lit(0.0))
    start = lambda s: F.when(value(s) > 0, -F.col(f"{s}.at")).otherwise(lower)
    out = ends.join(best, [cluster, "strand"], "left")
    return out.select(cluster, "strand", "lo", "hi", "first", value("relaxed").alias("score"), start("relaxed").alias("window_start"), value("strict").alias("strict_score"), start("strict").alias("strict_start"))


def peak_ambiguity(positions: DataFrame, scan: DataFrame, cluster: str, phase: int) -> DataFrame:
    """How well the peak window of each cluster is told apart from the windows that overlap it.

    The peak is the best relaxed window of either strand (Watson if equal). Counted are overlapping windows on its
    strand with at least 0.9 of its exact score, by whether they share its frame, and other registers of the peak itself.
    """
    size = CYCLES * phase
    kind = positions.schema[cluster].dataType
    rank = F.struct("score", (F.col("strand") == "w").cast("int").alias("w"))
    peak = scan.groupBy(cluster).agg(F.max_by(F.struct("strand", "score", F.col("window_start").alias("peak"), "lo", "hi", "first"), rank).alias("p")).select(cluster, "p.*")
    near = positions.join(peak, [cluster, "strand"]).where(F.col("pos").between(F.col("peak") - size + 1, F.col("peak") + 2 * size - 2))

    def kernel(key, rows):
        peak, strand = int(rows["peak"][0]), rows["strand"][0]
        lo, hi = _starts(int(rows["lo"][0]), int(rows["hi"][0]), int(rows["first"][0]), size)
        starts = np.arange(max(lo, peak - size + 1), min(hi, peak + size - 1) + 1)
        tables = register_tables(rows["pos"], rows["abun"].astype(float), starts, phase, strand, ("exact",))
        exact, best = tables["exact"].max(axis=1), tables["exact"].argmax(axis=1)
        frame = (starts + best if strand == "w" else starts + size - 1 - best) % phase
        frame = np.where(tables["occupied"], frame, -1)
        k = int(np.flatnonzero(starts == peak)[0])
        support = float(exact[k])
        if support <= 0 or frame[k] < 0:
            return [(key[0], strand, peak, support, None, None, None, None, None, None, None, None, "insufficient_exact_support")]
        least = AMBIGUOUS * support
        rival = (exact >= least) & (np.arange(len(starts)) != k)
        same, other = rival & (frame == frame[k]), rival & (frame != frame[k])
        margin = lambda m: support - float(exact[m].max()) if m.any() else None
        alternatives = int((tables["exact"][k] >= least).sum() - 1)
        reach = starts[same | (np.arange(len(starts)) == k)]
        frames = len(set(frame[other].tolist()) - {-1})
        if not rival.any():
            origin = "unique_origin"
        elif not other.any():
            origin = "coherent_extension"
        else:
            origin = "mixed_extension_and_ambiguity" if same.any() else "ambiguous_origin"
        return [(key[0], strand, peak, support, int(rival.sum()), alternatives, margin(rival), int(same.sum()), int(reach.max() + size - reach.min()), int(other.sum()), frames, margin(other), origin)]

    fields = [
        (cluster, kind), ("peak_strand", T.StringType()), ("peak_start", T.LongType()), ("exact_support", T.DoubleType()), ("ambiguity_count", T.IntegerType()),
        ("alt_register_count", T.IntegerType()), ("overlap_margin", T.DoubleType()), ("extension_window_count", T.IntegerType()), ("extension_span_nt", T.LongType()),
        ("origin_window_count", T.IntegerType()), ("origin_frame_count", T.IntegerType()), ("origin_margin", T.DoubleType()), ("origin_class", T.StringType()),
    ]
    seen = by_key(near.select(cluster, "strand", "pos", "abun", "peak", "lo", "hi", "first"), [cluster], ["pos"], kernel, T.StructType([T.StructField(*f) for f in fields]))
    every = peak.select(cluster, F.col("strand").alias("__strand"), F.col("peak").alias("__peak")).join(seen, cluster, "left")
    filled = {"peak_strand": "__strand", "peak_start": "__peak", "exact_support": F.lit(0.0), "origin_class": F.lit("insufficient_exact_support")}
    return every.withColumns({n: F.coalesce(F.col(n), F.col(v) if isinstance(v, str) else v) for n, v in filled.items()}).drop("__strand", "__peak")


def howell_trace(positions: DataFrame, cluster: str, phase: int) -> DataFrame:
    """One relaxed window for each position: it begins there on Watson and ends there on Crick."""
    size = CYCLES * phase
    kind = positions.schema[cluster].dataType

    def kernel(key, rows):
        pos, strand = rows["pos"], key[1]
        starts = pos if strand == "w" else pos - size + 1
        mine = (starts // TILE) == key[2]
        if not mine.any():
            return []
        starts = starts[mine]
        tables = register_tables(pos, rows["abun"].astype(float), starts, phase, strand, ("relaxed",))
        best = tables["relaxed"].argmax(axis=1)
        pick = lambda t: tables[t][np.arange(len(best)), best]
        score, inside, total, filled = pick("relaxed"), pick("relaxed_inside"), pick("relaxed_total"), pick("relaxed_filled")
        return [
            (key[0], strand, int(p), int(s), int(s) + size - 1, float(x), float(i) if x > 0 else None, float(max(0.0, t - i)) if x > 0 else None, int(f) if x > 0 else None, int(r) if x > 0 else None)
            for p, s, x, i, t, f, r in zip(pos[mine], starts, score, inside, total, filled, best)
        ]

    fields = [
        (cluster, kind), ("strand", T.StringType()), ("anchor", T.LongType()), ("window_start", T.LongType()), ("window_end", T.LongType()), ("score", T.DoubleType()),
        ("in_phase", T.DoubleType()), ("out_of_phase", T.DoubleType()), ("occupied_cycles", T.IntegerType()), ("register", T.IntegerType()),
    ]
    return by_key(_tiled(positions, cluster, size), [cluster, "strand", "__tile"], ["pos"], kernel, T.StructType([T.StructField(*f) for f in fields]))


def trace_peaks(trace: DataFrame, cluster: str) -> DataFrame:
    """Peak window of the winning strand: the last of equal ones in anchor order, and Crick of equal strands."""
    ordered = F.struct("score", (F.col("strand") == "c").cast("int").alias("c"), F.when(F.col("strand") == "w", F.col("anchor")).otherwise(-F.col("anchor")).alias("o"))
    peak = trace.groupBy(cluster).agg(F.max_by(F.struct("strand", "anchor", "window_start", "window_end", "score", "register"), ordered).alias("p"))
    origin = F.when(F.col("p.strand") == "w", F.col("p.window_start") + F.coalesce("p.register", F.lit(0))).otherwise(F.col("p.window_end") - F.coalesce("p.register", F.lit(0)))
    return peak.select(cluster, F.col("p.strand").alias("strand"), F.col("p.anchor").alias("peak_anchor"), F.col("p.window_start").alias("peak_start"), F.col("p.window_end").alias("peak_end"), F.col("p.score").alias("peak_score"), origin.alias("origin"))


def crowding(trace: DataFrame, cluster: str, phase: int) -> DataFrame:
    """Windows of other registers that overlap the peak on its strand with nearly its score."""
    peak = trace_peaks(trace, cluster)
    rows = trace.join(peak, [cluster, "strand"])
    close = (
        (F.col("anchor") != F.col("peak_anchor")) & (register_relation(F.col("anchor"), F.col("origin"), phase) == "other")
        & (F.col("window_start") <= F.col("peak_end")) & (F.col("peak_start") <= F.col("window_end")) & (F.abs(F.col("peak_score") - F.col("score")) <= CROWDING_GAP)
    )
    best = F.max(F.when(close, F.col("score")))
    return rows.groupBy(cluster, "strand", "peak_anchor", "peak_score").agg(F.count_if(close).alias("crowding_windows"), best.alias("crowding_best"), (F.first("peak_score") - best).alias("crowding_gap"))


def trace_groups(trace: DataFrame, cluster: str, cutoff: float) -> DataFrame:
    """Stretches of overlapping trace windows of at least ``cutoff``, per cluster and strand."""
    strong = trace.where(F.col("score") >= cutoff)
    keys = {cluster: F.col(cluster), "strand": F.col("strand")}
    stretches = interval_periods(strong, keys, F.col("window_start") * 2, F.col("window_end") * 2).where("kind = 'covered'")
    return stretches.select(cluster, "strand", (F.col("period_start") / 2).cast("long").alias("group_start"), (F.col("period_end") / 2).cast("long").alias("group_end"))


def trace_group_summaries(trace: DataFrame, cluster: str, phase: int, cutoff: float) -> DataFrame:
    """Groups of overlapping strong windows, each with its peak, origin and the rows by register.

    ``origin`` is that of the group's own peak, ``shift_nt`` the signed shortest shift from the register of the
    cluster's peak to it (null if they share it), ``overlaps_peak`` whether the group reaches into the cluster's peak
    window. Rows of a group are ``exact``, ``offset`` or ``other`` by their anchors; equal peaks are settled as in
    :func:`trace_peaks`.
    """
    groups = trace_groups(trace, cluster, cutoff)
    rows = trace.where(F.col("score") >= cutoff).withColumn("__bin", F.floor(F.col("window_start") / TILE))
    binned = groups.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("group_start") / TILE), F.floor(F.col("group_end") / TILE))))
    inside = rows.join(binned, [cluster, "strand", "__bin"]).where(F.col("window_start").between(F.col("group_start"), F.col("group_end")))
    keys = [cluster, "strand", "group_start", "group_end"]
    last = F.struct("score", F.when(F.col("strand") == "w", F.col("anchor")).otherwise(-F.col("anchor")).alias("o"))
    origin = F.when(F.col("strand") == "w", F.col("window_start") + F.col("register")).otherwise(F.col("window_end") - F.col("register"))
    peaks = inside.groupBy(*keys).agg(F.max_by(F.struct("anchor", "score", origin.alias("origin")), last).alias("p")).select(*keys, F.col("p.anchor").alias("group_anchor"), F.col("p.score").alias("group_score"), F.col("p.origin").alias("group_origin"))
    relation = register_relation(F.col("anchor"), F.col("group_origin"), phase)
    counted = inside.join(peaks, keys).groupBy(*keys, "group_anchor", "group_score", "group_origin").agg(*(F.count_if(relation == r).alias(f"{r}_rows") for r in ("exact", "offset", "other")))
    main = trace_peaks(trace, cluster).select(cluster, "origin", "peak_start", "peak_end")
    return counted.join(main, cluster).select(
        *keys, "group_anchor", "group_score", "group_origin", "exact_rows", "offset_rows", "other_rows", phase_shift(F.col("origin"), F.col("group_origin"), phase).alias("shift_nt"),
        ((F.col("group_start") <= F.col("peak_end")) & (F.col("peak_start") <= F.col("group_end"))).alias("overlaps_peak"),
    )


def alternative_candidates(trace: DataFrame, cluster: str, phase: int, cutoff: float) -> DataFrame:
    """Windows of other registers that overlap the peak on its strand, grouped by the shift of their register.

    One row per cluster and signed ``shift_nt``: rows, best score and extent. These are the candidates for overlapping
    alternatives, before their support is weighed.
    """
    rows = trace.join(trace_peaks(trace, cluster), [cluster, "strand"])
    origin = F.when(F.col("strand") == "w", F.col("window_start") + F.col("register")).otherwise(F.col("window_end") - F.col("register"))
    other = (
        (F.col("anchor") != F.col("peak_anchor")) & (F.col("score") >= cutoff) & (register_relation(F.col("anchor"), F.col("origin"), phase) == "other")
        & (F.col("window_start") <= F.col("peak_end")) & (F.col("peak_start") <= F.col("window_end"))
    )
    shifted = rows.where(other).withColumn("shift_nt", phase_shift(F.col("origin"), origin, phase)).where("shift_nt is not null")
    return shifted.groupBy(cluster, "strand", "shift_nt").agg(F.count(F.lit(1)).alias("windows"), F.max("score").alias("best_score"), F.min("window_start").alias("min_start"), F.max("window_end").alias("max_end"))


def top_alternatives(candidates: DataFrame, cluster: str, n: int = 6) -> DataFrame:
    """The ``n`` best :func:`alternative_candidates` of each cluster with their ``rank``; of equal scores the smaller shift."""
    line = Window.partitionBy(cluster).orderBy(F.desc("best_score"), "shift_nt")
    return candidates.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= n)


def peak_competitors(positions: DataFrame, scan: DataFrame, cluster: str, phase: int) -> DataFrame:
    """Windows that overlap the peak in another frame with at least 0.9 of its exact score, one row each.

    Here Crick wins if both strands are equally good.
    """
    size = CYCLES * phase
    kind = positions.schema[cluster].dataType
    rank = F.struct("score", (F.col("strand") == "c").cast("int").alias("c"))
    peak = scan.groupBy(cluster).agg(F.max_by(F.struct("strand", F.col("window_start").alias("peak"), "lo", "hi", "first"), rank).alias("p")).select(cluster, "p.*")
    near = positions.join(peak, [cluster, "strand"]).where(F.col("pos").between(F.col("peak") - size + 1, F.col("peak") + 2 * size - 2))

    def kernel(key, rows):
        peak, strand = int(rows["peak"][0]), rows["strand"][0]
        lo, hi = _starts(int(rows["lo"][0]), int(rows["hi"][0]), int(rows["first"][0]), size)
        starts = np.arange(max(lo, peak - size + 1), min(hi, peak + size - 1) + 1)
        tables = register_tables(rows["pos"], rows["abun"].astype(float), starts, phase, strand, ("exact",))
        exact, best = tables["exact"].max(axis=1), tables["exact"].argmax(axis=1)
        frame = np.where(tables["occupied"], (starts + best if strand == "w" else starts + size - 1 - best) % phase, -1)
        k = int(np.flatnonzero(starts == peak)[0])
        if exact[k] <= 0:
            return []
        rival = (exact >= AMBIGUOUS * exact[k]) & (frame != frame[k])
        return [(key[0], strand, int(s), int(s) + size - 1, float(x), int(f)) for s, x, f in zip(starts[rival], exact[rival], frame[rival])]

    fields = [(cluster, kind), ("strand", T.StringType()), ("window_start", T.LongType()), ("window_end", T.LongType()), ("exact_score", T.DoubleType()), ("exact_frame", T.IntegerType())]
    return by_key(near.select(cluster, "strand", "pos", "abun", "peak", "lo", "hi", "first"), [cluster], ["pos"], kernel, T.StructType([T.StructField(*f) for f in fields]))


def register_reads(positions: DataFrame, peaks: DataFrame, cluster: str, phase: int) -> DataFrame:
    """Positions at the ten expected places of the peak's register: exact, else the better neighbour (left if equal).

    Expected places run up from the origin on Watson and down on Crick.
    """
    step = F.when(F.col("strand") == "w", F.lit(phase)).otherwise(F.lit(-phase))
    places = peaks.select(cluster, "strand", "origin", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(CYCLES - 1)), lambda c: F.col("origin") + c * step)).alias("cycle", "expected"))
    looked = places.select("*", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("off")).withColumn("pos", F.col("expected") + F.col("off"))
    found = looked.join(positions, [cluster, "strand", "pos"])
    rank = F.struct((F.col("off") == 0).cast("int").alias("exact"), "abun", (-F.col("off")).alias("left"))
    best = found.groupBy(cluster, "strand", "origin", "cycle", "expected").agg(F.max_by(F.struct("pos", "abun", "off"), rank).alias("b"))
    return best.select(cluster, "strand", "origin", "cycle", "expected", "b.pos", "b.abun", F.when(F.col("b.off") == 0, "core_exact").otherwise("core_offset").alias("register_class"))


def register_tags(chosen: DataFrame, reads: DataFrame, cluster: str, phase: int) -> DataFrame:
    """The tags of the phase length at the positions that :func:`register_reads` chose, summed by sequence."""
    tags = reads.where((F.col("len") == phase) & F.col("tag_seq").isNotNull()).groupBy(cluster, "strand", "pos", "tag_seq").agg(F.sum(F.coalesce("abun", F.lit(0))).alias("abun"))
    return chosen.drop("abun").join(tags, [cluster, "strand", "pos"]).select(cluster, "strand", "origin", "cycle", "pos", "register_class", "tag_seq", "abun")
