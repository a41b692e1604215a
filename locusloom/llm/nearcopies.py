"""Copies of texts that end early, by min-hash bands over prefixes, in pairs that grow with the texts and not with their groups."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusloom.llm.endings import Ends
from locusloom.llm.words import Texts, slices
from locusloom.session import saved

SHINGLE, BANDS, ROWS, SIMILAR = 5, 6, 3, 0.8
#: Members of a group that a candidate is aligned with in the first round, how many times as many in each next one, and
#: the members from which a group is divided by the words at the candidates' ends.
FIRST, GROWTH, CROWD = 4, 4, 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.iinfo(np.uint64).max


def _mixed(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(31))) * _MIX
    return a ^ (a >> np.uint64(29))


def run_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the runs of five words, in order; none for fewer words."""
    n = len(words) - SHINGLE + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(SHINGLE if n > 0 else 0):
        out = (out ^ (out >> np.uint64(31))) * _MIX + words[i : i + n]
    return out


@lru_cache(1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def prefix_bands(runs: np.ndarray, first: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band hashes of the prefixes of 1, 2, 4, 8, ... shingles of many texts.

    Text ``i`` has the ``many[i]`` shingles from ``runs[first[i]]`` on. Gives, for each text and prefix, the text, the
    level (the logarithm of the prefix's shingles) and ``BANDS`` hashes, each of ``ROWS`` min-hashes and the level.
    """
    at = np.flatnonzero(many > 0)
    levels = np.floor(np.log2(many[at])).astype(np.int64) + 1
    of = np.repeat(at, levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    if not len(of):
        return of, level, np.zeros((0, BANDS), np.uint64)
    begins = first[of] + np.where(level > 0, 2 ** np.maximum(level - 1, 0), 0)  # what a level adds to the one before
    ends = first[of] + 2**level
    cuts = np.stack([begins, ends], axis=1).ravel()
    padded = np.append(runs, _TOP)
    least = np.empty((BANDS * ROWS, len(of)), np.uint64)
    a, b = _permutations()
    deepest = int(level.max())
    by_level = [np.flatnonzero(level == k) for k in range(deepest + 1)]
    for j in range(BANDS * ROWS):
        hashed = padded * a[j] + b[j]
        hashed ^= hashed >> np.uint64(32)
        least[j] = np.minimum.reduceat(hashed, cuts)[::2]
        for k in range(1, deepest + 1):
            least[j, by_level[k]] = np.minimum(least[j, by_level[k]], least[j, by_level[k] - 1])
    out = np.repeat(_mixed(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))[:, None], len(of), axis=1) + level.astype(np.uint64)
    for r in range(ROWS):
        out = _mixed(out) + least[r::ROWS]
    return of, level, _mixed(out).T


MEMBER = "bucket long, key binary, level int, n int, candidate boolean, partner boolean"


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each band of each prefix of a text. Unfinished texts ask with the longest prefix of their whole words."""
    for batch in slices(batches, [1]):
        texts = Texts(batch.column(1))
        ends = Ends(texts)
        asks = ~ends.closed & (ends.at >= 0)
        words = np.diff(texts.first)
        runs = run_hashes(texts.hash)
        many = np.maximum(words - SHINGLE + 1, 0)
        of, level, bands = prefix_bands(runs, texts.first[:-1], many)
        whole = np.maximum(many - 1, 0)[of]  # the last word may be a fragment
        candidate = asks[of] & (whole >= 2**level) & (whole < 2 ** (level + 1))
        each = np.repeat(np.arange(len(of)), BANDS)
        columns = [
            pa.array(bands.ravel().view(np.int64)), batch.column(0).take(pa.array(of[each])), pa.array(level[each].astype(np.int32)),
            pa.array(words[of][each].astype(np.int32)), pa.array(candidate[each]), pa.array(np.ones(len(each), bool)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "key", "level", "n", "candidate", "partner"])


def _ends_of(tail: np.ndarray, long: np.ndarray) -> tuple[int, np.ndarray]:
    """Fewest edits (words changed, left out or added) of ``tail`` along the beginning of ``long``, and the places where it may end there.

    The places are in the order of how well they fit the length of ``tail``. More than twice its words are not looked
    at, as changing all of them costs less.
    """
    long = long[: 2 * len(tail)]
    at = np.arange(len(long) + 1)
    edits = at
    for word in tail:
        step = np.append(edits[0] + 1, np.minimum(edits[1:] + 1, edits[:-1] + (long != word)))
        edits = np.minimum.accumulate(step - at) + at
    places = np.flatnonzero(edits == edits.min())
    return int(edits.min()), places[np.argsort(np.abs(places - len(tail)), kind="stable")]


def ends_early(short: np.ndarray, long: np.ndarray) -> list[int]:
    """Places in ``long`` (word hashes) at which the last word of ``short`` may stand, if ``short`` runs along it from its beginning.

    The last word of ``short`` may be a fragment. Its whole words are aligned from the last five that both have in a
    row, no further apart than the dissimilarity allows; the words behind those may be changed, left out or added, as
    long as most of the last five words (of all behind the common five, if they are more) remain. The shingles of the
    two aligned parts must have a Jaccard similarity of ``SIMILAR``; how much of ``long`` follows does not matter.
    """
    whole = short[:-1]
    if len(whole) < SHINGLE or len(long) < SHINGLE:
        return []
    mine, runs = run_hashes(whole), run_hashes(long)
    for i in np.flatnonzero(np.isin(mine, runs))[::-1]:
        places = np.flatnonzero(runs == mine[i])
        start = places[np.abs(places - i).argmin()]
        if abs(start - i) <= (1 - SIMILAR) * len(short):
            break
    else:
        return []
    tail = whole[i + SHINGLE :]
    edits, ends = _ends_of(tail, long[start + SHINGLE :])
    if 2 * edits >= max(SHINGLE, len(tail)):
        return []
    ends = ends + start + SHINGLE
    a, b = np.unique(mine), np.unique(runs[: max(ends[0] - SHINGLE + 1, 1)])
    common = len(np.intersect1d(a, b, assume_unique=True))
    return ends.tolist() if common >= SIMILAR * (len(a) + len(b) - common) else []


def continues(short: Texts, ends: Ends, i: int, long: Texts, j: int) -> bool:
    """True if text ``j`` of ``long`` goes on where text ``i`` of ``short``, which closes as ``ends`` says, ends.

    The word that stands there is the last word of the short text and others follow, or that is its beginning. A last
    word that marks other than an ellipsis follow is no fragment.
    """
    a, b = slice(short.first[i], short.first[i + 1]), slice(long.first[j], long.first[j + 1])
    last = a.stop - 1
    for place in ends_early(short.hash[a], long.hash[b]):
        at = b.start + place
        if at < b.stop and long.hash[at] == short.hash[last]:
            if at + 1 < b.stop:
                return True
        elif at < b.stop and (short.stop[last] > ends.at[i] or ends.elliptic[i]) and long.word(at).startswith(short.word(last)):
            return True
    return False


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, [1, 2]):
        short, long = Texts(batch.column(1)), Texts(batch.column(2))
        ends = Ends(short)
        hit = [continues(short, ends, i, long, i) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(hit, pa.bool_()))], names=["key"])


def _crowd_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of crowded groups, divided: a row for each group of a text and each shingle that a cut may follow.

    The shingles of a candidate and of what continues it are at least ``SIMILAR``, so of the last fifth and one more of
    a candidate's distinct shingles one stands in the other text, which is no more than a quarter longer up to there.
    ``n`` is the number of words behind the shingle, the most of a partner and the least of a candidate.
    """
    for batch in slices(batches, [3]):
        texts = Texts(batch.column(3))
        rows: dict[str, list] = {name: [] for name in ("bucket", "of", "level", "n", "candidate")}
        for i, (groups, levels, asks) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 4, 2)))):
            words = texts.hash[texts.first[i] : texts.first[i + 1]]
            runs = run_hashes(words)
            behind = len(words) - SHINGLE - np.arange(len(runs))
            for group, level, ask in zip(groups, levels, asks):
                salt = np.array([group], np.int64).view(np.uint64)
                parts = [(np.unique(runs[: int(2.5 * 2**level) + 2], return_index=True), False)]
                if ask:
                    back = runs[:-1][::-1]
                    found, at = np.unique(back, return_index=True)
                    last = np.argsort(at)[: int((1 - SIMILAR) * len(found)) + 1]
                    parts.append(((found[last], len(back) - 1 - at[last]), True))
                for (found, at), is_candidate in parts:
                    rows["bucket"].append(_mixed(_mixed(found) + salt))
                    rows["of"].append(np.full(len(found), i))
                    rows["level"].append(np.full(len(found), level))
                    rows["n"].append(behind[at])
                    rows["candidate"].append(np.full(len(found), is_candidate))
        flat = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in rows.items()}
        candidate = flat["candidate"].astype(bool)
        columns = [
            pa.array(flat["bucket"].astype(np.uint64).view(np.int64)), batch.column(0).take(pa.array(flat["of"].astype(np.int64))),
            pa.array(flat["level"].astype(np.int32)), pa.array(flat["n"].astype(np.int32)), pa.array(candidate), pa.array(~candidate),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "key", "level", "n", "candidate", "partner"])


def _rounds(members: DataFrame, texts: DataFrame, crowd: int | None) -> tuple[list[DataFrame], DataFrame]:
    """The candidates that a partner of their group continues, and those rows of ``members`` that still wait.

    Partners are taken longest first, only those that are no shorter than the candidate, in rounds that grow by
    ``GROWTH``. Of a group at most as many rows leave a task as the round has places. A candidate leaves at the first
    partner that continues it. The rounds end with the members, or when a group's first ``crowd`` were tried.
    """
    waiting, found, tried, more = members.where("candidate").select("bucket", "key", "n"), [], 0, FIRST
    longest = Window.partitionBy("bucket").orderBy(F.desc("n"), "key")
    while not waiting.isEmpty() and (crowd is None or tried < crowd):
        partners = members.where("partner").join(waiting.select("bucket").distinct(), "bucket", "left_semi")
        placed = partners.withColumn("place", F.row_number().over(longest)).where(F.col("place") <= tried + more)
        placed = saved(placed.where(F.col("place") > tried).select("bucket", "place", F.col("key").alias("other"), F.col("n").alias("other_n")), "partners")
        pairs = waiting.join(placed, "bucket").where("key <> other and other_n >= n").select("key", "other").distinct()
        both = pairs.join(texts.select("key", F.col("text").alias("short")), "key").join(texts.select(F.col("key").alias("other"), F.col("text").alias("long")), "other")
        hit = saved(both.select("key", "short", "long").mapInArrow(_aligned, "key binary").distinct(), "continued")
        found.append(hit)
        tried, more = tried + more, more * GROWTH
        # a group whose last place holds a longer text may have more of them
        full = placed.where(F.col("place") == tried).select("bucket", "other_n")
        waiting = saved(waiting.join(full, "bucket").where("other_n >= n").select("bucket", "key", "n").join(hit, "key", "left_anti"), "waiting")
    return found, waiting


def cut_copies(texts: DataFrame) -> DataFrame:
    """``key`` of every unfinished text that a near-copy of at least its length continues.

    ``texts`` has a binary ``key`` and a ``text``, one row for each distinct text. A text that closes with a mark is
    never asked about. Texts meet in the min-hash bands of their prefixes of 1, 2, 4, 8, ... shingles of five words: an
    unfinished text asks with the longest that its whole words hold, so a copy cut to any part of its length meets its
    whole. Groups without a candidate are left out before anything is joined. The members of a group are aligned with
    the candidates longest first, in rounds. Groups in which candidates still wait after ``CROWD`` members, such as
    those of a template, are divided by the shingles at the candidates' ends, which keeps every partner that could
    continue one and few others. Texts under five words besides the last give nothing.
    """
    rows = saved(texts.select("key", "text").mapInArrow(_band_rows, MEMBER), "bands")
    members = saved(rows.join(rows.where("candidate").select("bucket").distinct(), "bucket", "left_semi"), "members")
    # the texts of members alone go through the joins of the rounds
    named = saved(texts.select("key", "text").join(saved(members.select("key").distinct(), "member-keys"), "key", "left_semi"), "member-texts")
    found, waiting = _rounds(members, named, CROWD)
    if not waiting.isEmpty():
        asks = waiting.select("bucket", "key", F.lit(True).alias("asks"))
        crowds = members.join(asks.select("bucket").distinct(), "bucket", "left_semi").join(asks, ["bucket", "key"], "left")
        per_text = crowds.groupBy("key").agg(F.collect_list(F.struct("bucket", "level", F.coalesce("asks", F.lit(False)).alias("asks"))).alias("m"))
        per_text = per_text.select("key", F.col("m.bucket").alias("buckets"), F.col("m.asks").alias("asks"), F.col("m.level").alias("levels")).join(named, "key")
        divided = per_text.select("key", "buckets", "asks", "text", "levels").mapInArrow(_crowd_rows, MEMBER)
        found += _rounds(saved(divided, "crowds"), named, None)[0]
    if not found:
        return named.select("key").limit(0)
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.distinct()
