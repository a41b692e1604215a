"""How texts close: measures of the ends of whole texts, and counts of how words are used, as Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from locusloom.llm.words import HAN, NUMBER, OTHER, REPLACED, Texts, slices, tables

#: Marks that end a sentence, marks that may close after them, and the ellipsis.
TERMINAL, CLOSERS, ELLIPSIS = ".?!।。！？؟", "”\"»“’)）』」", "…"
#: Marks that open and those that close them again.
PAIRS = [("(（", ")）"), ("«", "»"), ("<", ">")]
#: A word written as a number, and one that is not there.
ANY_NUMBER, NO_WORD = 1, 0
NUMERIC, IN_HAN, CAPITAL, SMALL, CASELESS, INITIAL = range(6)
#: A shape is the last mark times ``BY_MARK``, the kind of the last word times ``BY_KIND``, and the number of words.
BY_MARK, BY_KIND = 6 * 64, 64


def _is(points: np.ndarray, marks: str) -> np.ndarray:
    return np.isin(points, np.array([ord(m) for m in marks], np.uint32))


def _used_as(texts: Texts) -> np.ndarray:
    """The words as the statistics count them: all numbers as one."""
    return np.where(texts.what == NUMBER, np.uint64(ANY_NUMBER), texts.hash).view(np.int64)


class Ends:
    """What each text of a batch ends with, looked for however far back it stands.

    ``at``: the last character that says something, behind which are only white space, symbols such as emoji and
    bracketed marks such as ``(!)``; -1 where there is none. ``closed``: a sentence ends there, perhaps inside closing
    marks; an initial or an ellipsis (``elliptic``) ends none. ``marked``: it is such a mark itself. ``left_open``: of a
    pair of marks the opening one stands last, an entity is not finished, or a character was cut into. ``word``: the
    last word. ``shape``: the last mark before it, what kind of word it is, and how many words stand behind the mark,
    in powers of two.
    """

    def __init__(self, texts: Texts):
        points, table = texts.points, tables()
        idle = table["idle"][points].copy()
        bang = np.flatnonzero(_is(points[1:-1], "!?") & (points[:-2] == ord("(")) & (points[2:] == ord(")"))) if len(points) > 2 else np.zeros(0, int)
        for i in range(3):
            idle[bang + i] = True
        breaks = texts.ends
        idle[breaks] = True
        self.at = texts.last_at(np.flatnonzero(~idle))
        closing = idle | _is(points, CLOSERS)
        mark = texts.last_at(np.flatnonzero(~closing))
        there = mark >= 0
        last = np.where(there, points[mark], 0)
        padded = lambda back: np.where(mark - back >= texts.begins, points[np.maximum(mark - back, 0)], 0)
        self.elliptic = there & ((last == ord(ELLIPSIS)) | ((last == ord(".")) & (padded(1) == ord(".")) & (padded(2) == ord("."))))
        kind_before = np.where(mark - 2 >= texts.begins, texts.kind[np.maximum(mark - 2, 0)], OTHER)
        initial = (last == ord(".")) & (mark == self.at) & table["capital"][padded(1)] & ((kind_before == OTHER) | (kind_before == NUMBER))
        self.closed = there & _is(last, TERMINAL) & ~initial & ~self.elliptic
        self.marked = (self.at >= 0) & _is(np.where(self.at >= 0, points[self.at], 0), TERMINAL)
        self.left_open = self._open(texts)
        self._last_words(texts)

    def _open(self, texts: Texts) -> np.ndarray:
        points = texts.points
        where = {m: np.flatnonzero(points == ord(m)) for m in "“”„"}
        last = lambda marks: texts.last_at(np.flatnonzero(_is(points, marks)))
        low, left, right = (texts.last_at(where[m]) for m in "„“”")
        out = np.where(low >= 0, low > np.maximum(left, right), left > right)
        for opened, closed in PAIRS:
            out |= last(opened) > last(closed)
        plain = ((points | 0x20) >= ord("a")) & ((points | 0x20) <= ord("z")) | ((points >= ord("0")) & (points <= ord("9"))) | (points == ord("_"))
        fence = texts.last_at(np.flatnonzero(~plain), self.at + 1)  # what stands before the plain letters that end the text
        sharp = (fence >= texts.begins) & (points[np.maximum(fence, 0)] == ord("#"))
        fence = np.where(sharp, fence - 1, fence)
        entity = (fence >= texts.begins) & (points[np.maximum(fence, 0)] == ord("&"))
        return (self.at >= 0) & (out | entity | (points[np.maximum(self.at, 0)] == REPLACED))

    def _last_words(self, texts: Texts) -> None:
        has = texts.first[1:] > texts.first[:-1]
        i = np.where(has, texts.first[1:] - 1, 0)
        if not len(texts.start):
            self.word, self.shape = np.full(texts.size, NO_WORD, np.int64), np.zeros(texts.size, np.int64)
            return
        self.word = np.where(has, _used_as(texts)[i], NO_WORD)
        points, table, start = texts.points, tables(), texts.start[i]
        inert = (texts.kind != OTHER) | table["idle"][points] | (points == 0)
        marks = np.flatnonzero(~inert)
        mark = texts.last_at(marks, start)
        behind = i - np.maximum(np.searchsorted(texts.start, mark + 1), texts.first[:-1]) + 1
        first = points[start]
        # the kinds of words by what they are written with
        kind = np.select([texts.initial[i], texts.what[i] == NUMBER, texts.what[i] == HAN, table["capital"][first], table["small"][first]], [INITIAL, NUMERIC, IN_HAN, CAPITAL, SMALL], CASELESS)
        size = np.floor(np.log2(np.maximum(behind, 1))).astype(np.int64)
        self.shape = np.where(has, np.where(mark >= 0, points[np.maximum(mark, 0)], 0).astype(np.int64) * BY_MARK + kind * BY_KIND + size + 1, 0)


END_COLUMNS = {
    "has_end": "boolean", "closed": "boolean", "elliptic": "boolean", "left_open": "boolean", "word": "long", "shape": "long",
    "other_closed": "boolean", "other_elliptic": "boolean", "other_marked": "boolean", "other_shape": "long",
}
USE_COLUMNS = {"used_word": "long", "used_ends": "long", "used_goes_on": "long"}


def end_measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of batches whose last two columns are a text and its other side, two kinds of rows.

    One row for each row of the batch: its other columns and ``END_COLUMNS``. And one row for each word of all its texts,
    with nulls before: ``USE_COLUMNS``, the counts of :func:`word_uses`. So each text is read once for both.
    """
    for batch in slices(batches, [-2, -1]):
        sides = [Texts(batch.column(i)) for i in (-2, -1)]
        text, other = map(Ends, sides)
        there = other.at >= 0
        columns = [
            pa.array(text.at >= 0), pa.array(text.closed), pa.array(text.elliptic), pa.array(text.left_open), pa.array(text.word), pa.array(text.shape),
            pa.array(other.closed, mask=~there), pa.array(other.elliptic), pa.array(other.marked), pa.array(other.shape),
        ]
        kept = batch.columns[:-2]
        uses = word_uses(sides)
        names = [*batch.schema.names[:-2], *END_COLUMNS, *USE_COLUMNS]
        rows = [*kept, *columns]
        yield pa.RecordBatch.from_arrays([*rows, *(pa.nulls(batch.num_rows, u.type) for u in uses)], names=names)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(uses[0]), c.type) for c in rows), *uses], names=names)


def word_uses(sides: list[Texts]) -> list[pa.Array]:
    """Words, and how often each stands before a closing mark, and before another word.

    Closing marks of quotations and white space between them do not matter. A word that ends the text without a mark
    counts as neither.
    """
    words, ends, goes = [], [], []
    for texts in sides:
        skip = _is(texts.points, CLOSERS) | tables()["white"][texts.points]
        solid = np.where(skip, len(skip), np.arange(len(skip)))
        ahead = np.append(np.minimum.accumulate(solid[::-1])[::-1], len(skip))
        follower = np.append(texts.points, 0)[ahead[texts.stop]]
        end = _is(follower, TERMINAL + ELLIPSIS) & ~texts.initial
        words.append(_used_as(texts))
        ends.append(end)
        goes.append(~end & (follower != 0))
    distinct, place = np.unique(np.concatenate(words), return_inverse=True)
    count = lambda hits: np.bincount(place, np.concatenate(hits), len(distinct)).astype(np.int64)
    return [pa.array(distinct), pa.array(count(ends)), pa.array(count(goes))]
