import os
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from locusloom.llm.endings import END_COLUMNS, USE_COLUMNS, Ends, end_measures
from locusloom.llm.nearcopies import CROWD, cut_copies, ends_early, prefix_bands, run_hashes
from locusloom.llm.truncation import truncated_texts
from locusloom.llm.words import Texts, slices

DATA = Path(os.environ.get("LOCUSLOOM_TEST_DATA", "/root/testdata/sf0.001"))
WORDS = "the river bends near an old stone mill where two brothers once ground barley and rye for every village along the northern road until one winter the wheel froze and nobody came to mend it so the water found another way".split()


def found_by_copies(spark, rows):
    df = spark.createDataFrame(rows, "key string, text string").select(F.encode("key", "utf-8").alias("key"), "text")
    return sorted(r.key for r in cut_copies(df).select(F.decode("key", "utf-8").alias("key")).collect())


def test_words():
    t = Texts(pa.array(["Hello, K. don't 3,141.5 说话 x", None, "", "Größe K.", "a\0b"]))
    words = [t.word(i) for i in range(len(t.start))]
    assert words == ["hello", "k", "don't", "3,141.5", "说", "话", "x", "größe", "k", "a", "b"]
    assert np.flatnonzero(t.initial).tolist() == [1, 8] and np.diff(t.first).tolist() == [7, 0, 0, 2, 2]
    assert t.hash[1] == t.hash[8] and len(set(t.hash.tolist())) == len(words) - 1
    again = Texts(pa.array(["x HELLO, k"]))
    assert again.hash[1] == t.hash[0] and again.hash[2] != t.hash[1]  # an initial is another word


def test_slices_keep_every_row():
    texts = ["a" * n for n in (5, 0, 90, 3, 200, 1)] + [None, "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["i", "t"])
    parts = list(slices(iter([batch, batch.slice(0, 0)]), [1], most=64))
    assert [i for p in parts for i in p.column("i").to_pylist()] == list(range(8)) and len(parts) > 2
    assert all(sum(len(t or "") for t in p.column("t").to_pylist()[1:]) <= 64 for p in parts)
    assert pa.concat_tables(pa.Table.from_batches([p]) for p in parts).column("t").to_pylist() == texts


def test_ends():
    cases = {
        "All is well.": "c", "All is well": "", "It was K.": "", "He said “so.”": "c", "He said “so": "o", "Wait...": "e", "Wait… ": "e", "So (see": "o", "So (see) ": "", "« a »": "",
        "„a“": "", "„a": "o", "<b>x</b>": "", "<a href='x": "o", "What is &quo": "o", "R & D": "", "Half a lett\ufffd": "o", "Well. (!)": "c", "Well. 🙂\u200b\n": "c", "说完了。": "c", "a&#12": "o",
    }
    e = Ends(Texts(pa.array(list(cases))))
    for i, (text, want) in enumerate(cases.items()):
        assert (e.closed[i], e.elliptic[i], e.left_open[i]) == ("c" in want, "e" in want, "o" in want), text
    e = Ends(Texts(pa.array([None, "", " \n", "🙂" * 300, "x" + "🙂" * 300 + " " * 300])))
    assert e.at.tolist()[:4] == [-1] * 4 and e.at[4] >= 0 and not e.left_open.any()
    heads = Ends(Texts(pa.array(["The mill – AB-1234", "Eine Mühle – ZX-9", "The mill, Bolm", "The mill, B."])))
    assert heads.shape[0] == heads.shape[1] and len(set(heads.shape.tolist())) == 3


def test_measures_and_word_uses():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["A mill. The Mill ”!", "mill", None]), pa.array(["mill here", "K. mill", "7 8."])], names=["i", "t", "o"])
    ends, uses = end_measures(iter([batch]))
    assert ends.schema.names == uses.schema.names == ["i", *END_COLUMNS, *USE_COLUMNS]
    assert ends.column("i").to_pylist() == [1, 2, 3] and ends.column("closed").to_pylist() == [True, False, False] and ends.column("other_closed").to_pylist() == [False, False, True]
    assert set(uses.column("i").to_pylist()) == {None} and set(ends.column("used_word").to_pylist()) == {None}
    rows = {w: (e, g) for w, e, g in zip(*(uses.column(c).to_pylist() for c in USE_COLUMNS))}
    key = Texts(pa.array(["mill"])).hash.view(np.int64)[0]
    assert rows[key] == (2, 1) and rows[1] == (1, 1)  # numbers are one word


def test_alignment_ends_early():
    a = np.arange(100, 200, dtype=np.uint64)
    assert ends_early(np.append(a[:90], np.uint64(7)), a) == [90] and ends_early(a, a) == [99]
    assert ends_early(a[:50], a) == [49] and ends_early(a[:10], a) == [9]  # however short the copy is
    assert ends_early(a[:5], a) == [] and ends_early(np.append(np.arange(40, dtype=np.uint64), a), a) == []


def test_alignment_of_changed_words():
    a, b = np.arange(100, 200, dtype=np.uint64), np.arange(100, 300, dtype=np.uint64)
    cut = np.append(a[:95], np.uint64(7))
    for at in range(90, 95):  # one changed, missing or added word among the last five
        for edited in (np.where(cut == 100 + at, np.uint64(8), cut), np.delete(cut, at), np.insert(cut, at, 8)):
            # the word left out right before the end cannot be seen without the last word
            assert (94 if at == 94 and len(edited) == 95 else 95) in ends_early(edited, a), at
    assert ends_early(np.concatenate([a[:90], np.arange(6, dtype=np.uint64)]), a) == []  # goes on differently
    spoiled = np.where((b >= 282) & (b % 4 == 0), np.uint64(8), b)[:192]
    assert ends_early(np.append(spoiled, np.uint64(7)), b)[0] == 192  # every fourth word differs


def test_bands_meet_for_similar_prefixes():
    rng = np.random.default_rng(2)
    for _ in range(20):
        words = rng.integers(0, 2**62, 300).astype(np.uint64)
        edited = words[:290].copy()
        edited[[40, 130]] = 1
        runs = np.append(run_hashes(words), run_hashes(edited))
        of, level, bands = prefix_bands(runs, np.array([0, 296]), np.array([296, 286]))
        assert level.tolist() == [*range(9), *range(9)]
        a, b = bands[of == 0], bands[of == 1]
        assert (a == b).any(axis=1).all() and (a[:5] == b[:5]).all()
    assert len(run_hashes(words[:4])) == 0 and len(prefix_bands(run_hashes(words[:4]), np.array([0]), np.array([0]))[0]) == 0
    for k in (3, 8):  # every level is the least over its whole prefix
        assert (prefix_bands(run_hashes(words)[: 2**k], np.array([0]), np.array([2**k]))[2][-1] == prefix_bands(run_hashes(words), np.array([0]), np.array([296]))[2][k]).all()


def test_cut_copies(spark):
    whole, cut = " ".join(WORDS) + ".", " ".join(WORDS[:-3]) + " fou"
    rows = [("w", whole), ("c", cut), ("d", " ".join(WORDS[:8])), ("e", " ".join(WORDS[:9]) + "."), ("o", " ".join(reversed(WORDS)) + "."), ("s", "the river bends")]
    assert found_by_copies(spark, rows) == ["c", "d"]
    assert found_by_copies(spark, [("a", "one two three four five (see AB-12)"), ("b", "one two three four five (see AB-1234)?")]) == []
    assert found_by_copies(spark, [("a", "one two three four five (see AB-12…"), ("b", "one two three four five (see AB-1234)?")]) == ["a"]
    assert found_by_copies(spark, rows[:0]) == []


def test_partners_behind_the_longest(spark):
    # longer variants that end where the cut does stand above the one copy that continues it, in every bucket
    names = lambda n, by: [chr(97 + i % 26) + chr(97 + i // 26 % 26) + by for i in range(n)]
    base = names(60, "x")
    rows = [("cut", " ".join(base[:57]) + " fc"), ("true", " ".join(base) + ".")]
    rows += [(f"v{i}", " ".join(names(4, "y" + chr(97 + i)) + base[:57]) + " fc.") for i in range(25)]
    assert found_by_copies(spark, rows) == ["cut"]
    assert found_by_copies(spark, [r for r in rows if r[0] != "true"]) == []


def test_crowded_templates(spark):
    # more texts than CROWD share all but their ends; one of them continues each cut, and it is the shortest
    head = " ".join(WORDS)
    rows = [(f"t{i}", f"{head} entry {i} was closed by worker {i * 7} without any further note or remark.") for i in range(CROWD + 60)]
    rows += [(f"w{i}", f"{head} green house {i} near lake has a new roof now and.") for i in range(5)]
    rows += [(f"c{i}", f"{head} green house {i} near lake has a ne") for i in range(5)]
    rows += [("lost", f"{head} blue house near lake has a ne")]
    assert found_by_copies(spark, rows) == [f"c{i}" for i in range(5)]


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
def test_recall_of_planted_cuts(spark):
    """Texts of the documents are cut to 10, 20, ... 95 %, some words of the copies changed: 0.9 and more must be found."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) >= 150").select("text").distinct().limit(200).toPandas().text.tolist()
    rng = np.random.default_rng(7)
    rows, planted, shares = [(f"w{i}", t) for i, t in enumerate(docs)], {}, [0.1, 0.2, 0.35, 0.5, 0.65, 0.79, 0.9, 0.95]
    for edits in (0, 1):
        for share in shares:
            for i, text in enumerate(docs):
                t = Texts(pa.array([text]))
                n = np.searchsorted(t.start, int(share * len(text)))  # the cut falls behind so many word beginnings
                if n < (51 if edits else 7) or n >= len(t.start):  # one word more differs in five shingles of a copy
                    continue
                copy = text[: int(share * len(text))]
                for w in rng.choice(n - 4, edits, replace=False) if edits else ():  # a word spelt otherwise, not the last ones
                    copy = copy[: t.start[w]] + "q" * (t.stop[w] - t.start[w]) + copy[t.stop[w] :]
                planted[f"c{edits}-{share}-{i}"] = copy
    ends = Ends(Texts(pa.array(list(planted.values()))))
    asked = {k for k, closed in zip(planted, ends.closed) if not closed}
    got = set(found_by_copies(spark, rows + list(planted.items())))
    for edits in (0, 1):
        for share in shares:
            of = {k for k in asked if k.startswith(f"c{edits}-{share}-")}
            assert not of or len(of & got) >= 0.9 * len(of), (edits, share, len(of & got), len(of))
    assert len(asked & got) >= 0.95 * len(asked), (len(asked & got), len(asked))


def test_same_words_more_characters(spark):
    whole = " ".join(WORDS) + " now"
    for a, b in (("a", "z"), ("z", "a")):  # whichever key is greater
        assert found_by_copies(spark, [(a, " ".join(WORDS[:-1]) + " wa"), (b, " ".join(WORDS[:-1]) + " way home")]) == [a]
        assert found_by_copies(spark, [(a, whole[:-1]), (b, whole)]) == [a]


def sentence(i, place):
    return f"Worker {chr(65 + i % 26)}olm repaired the {WORDS[i % 9]} beside the {place}"


def fixture():
    places = ["mill", "river", "market", "station"]
    rows, cut = [], set()
    for i in range(80):  # a source that closes its sentences
        rows.append((i, sentence(i, places[i % 4]) + ".", "closes", sentence(i, "x") + "."))
    for i in range(100, 130):  # a source of messages without closing marks, on both sides
        rows.append((i, sentence(i, places[i % 4]), "messages", sentence(i, "x")))
    for i in range(200, 212):  # a field of 50 characters
        text = f"{sentence(i, places[i % 4])}. {sentence(i + 3, 'market')}."[: 50]
        rows.append((i, text, "messages", "Something else."))
        cut |= set() if text.rstrip().endswith(".") else {i}
    more = [
        (300, "Worker Aolm repaired the", "closes", True), (301, "Is it true (see note", "closes", True), (302, "He said “the mill is", "closes", True), (303, "The old mill – AB-1234", "closes", False),
        (304, "The mill near the river, Bolm", "closes", False), (305, "All is well. 🙂", "closes", False), (306, "It was said by K.", "closes", True), (307, "Half a lett�", "closes", True),
        (308, "What is &quo", "closes", True), (309, "They went to the market. (!)", "closes", False),
    ]
    for i, text, source, is_cut in more:
        rows.append((i, text, source, None))
        cut |= {i} if is_cut else set()
    rows += [(500 + i, f"The {w} – AB-{i}", "closes", f"Das {w} – AB-{i}") for i, w in enumerate(WORDS[:6])]  # headings, seen beside their like
    rows += [(510 + i, f"The {w} near the {w}, {w.title()}olm", "closes", f"Das {w} neben {w}, {w.title()}olm") for i, w in enumerate(WORDS[:6])]
    rows += [(400, None, "closes", None), (401, "", "closes", None), (402, "  \n", None, None), (403, "Fine.", None, "x" * 100_000)]
    return rows, cut


def test_cases(spark):
    rows, cut = fixture()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, other string").withColumns({"score": F.lit(0.9), "evidence": F.lit(1)})
    got = truncated_texts(df, "doc_id", "text", "source", "other", "score").collect()
    assert len(got) == len(rows) - 3 and len({r.doc_id for r in got}) == len(got)
    found = {r.doc_id for r in got if r.is_cut}
    assert found == cut, (found - cut, cut - found)
    assert {r.evidence for r in got if r.is_cut and r.doc_id in range(200, 212)} <= {"limit", "left_open"}


def test_whole_texts_are_looked_at(spark):
    long = "The old mill near the river and the market " * 6
    rows = [
        (1, long + "– AB-1234", "closes", False), (2, "See <a href='" + "x" * 90, "closes", True), (3, "All is well. " + "🙂" * 250, "closes", False),
        (4, "They went to the" + " 🙂" * 250, "closes", True), (5, long + "<b>bold</b> – AB-1234", "closes", False), (6, "🙂" * 250, "closes", None),
    ]
    rows += [(100 + i, sentence(i, "mill") + ".", "closes", False) for i in range(40)]
    pairs = [r[:3] + ("Etwas – AB-1" if r[1].endswith("1234") else None,) for r in rows] + [(200 + i, f"The {w} – AB-{i}", "closes", f"Das {w} – AB-{i}") for i, w in enumerate(WORDS[:6])]
    df = spark.createDataFrame(pairs, "doc_id long, text string, source string, other string").withColumn("fit", F.lit(0.9))
    got = {r.doc_id: r for r in truncated_texts(df, "doc_id", "text", "source", "other", "fit").collect()}
    assert {i: got[i].is_cut if i in got else None for i in range(1, 7)} == {r[0]: r[3] for r in rows[:6]}
    assert got[2].evidence == "left_open"


def test_limits_of_shortened_texts(spark):
    # ends are usual closing words, so nothing but the limit speaks; two limits, and one longer text with an ellipsis
    rows, want = [], set()
    for i, size in enumerate([80] * 6 + [160] * 8 + [158] * 2 + [300]):
        base = f"Worker {chr(97 + i)} said".ljust(size - 9, chr(97 + i)) + " mill" + " ..."
        rows.append((i, base, "s"))
        want |= {i} if size != 300 else set()
    rows += [(100 + i, sentence(i, "mill") + ".", "s") for i in range(60)]
    rows += [(200 + i, f"So said {chr(97 + i)}".ljust(20 + 9 * i, chr(97 + i)) + " mill ...", "spread") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id for r in truncated_texts(df, "doc_id", "text", "source").where("evidence = 'limit'").collect()}
    assert got == want, (got - want, want - got)


def test_without_translation_and_empty(spark):
    rows = [(1, "One sentence.", "s"), (1, "One sentence.", "s"), (2, None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert [r.is_cut for r in truncated_texts(df, "doc_id", "text", "source").collect()] == [False, False]
    assert truncated_texts(df.limit(0), "doc_id", "text", "source").count() == 0
