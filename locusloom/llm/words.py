"""Words of the texts of a batch, read off one array of code points; no regular expression walks the texts."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OTHER, LETTER, HAN, NUMBER = range(4)
#: The ranges of the script Han, of which every character is a word.
_HAN = [(0x2E80, 0x2FD5), (0x3005, 0x3007), (0x3021, 0x3029), (0x3038, 0x303B), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAD9), (0x20000, 0x323AF)]
#: The code points with the property White_Space.
_WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
REPLACED = 0xFFFD
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@lru_cache(1)
def tables() -> dict[str, np.ndarray]:
    """For each code point: its kind, its lower case, and if it is white space, a capital, lower case, or says nothing at an end."""
    size = 0x110000
    kind, lower = np.zeros(size, np.uint8), np.arange(size, dtype=np.uint32)
    white, capital, small, idle = (np.zeros(size, bool) for _ in range(4))
    white[_WHITE] = True
    for i in (*range(0x20000), *range(0xE0000, 0xE0200)):  # between and behind lie Han, unassigned and private places
        c = chr(i)
        category = unicodedata.category(c)
        if category[0] in "LM":
            kind[i] = LETTER
            capital[i], small[i] = category == "Lu", category == "Ll"
            if len(low := c.lower()) == 1:
                lower[i] = ord(low)
        elif category[0] == "N":
            kind[i] = NUMBER
        elif category[0] == "Z" or category in ("Cf", "So"):
            idle[i] = i != REPLACED
    for a, b in _HAN:
        kind[a : b + 1] = HAN
    return {"kind": kind, "lower": lower, "white": white, "capital": capital, "small": small, "idle": idle | white}


#: Bytes of text whose code points are held as arrays at once, unless one text alone has more.
AT_ONCE = 1 << 22


def slices(batches: Iterator[pa.RecordBatch], columns: Sequence[int], most: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The batches, divided so that the texts of their ``columns`` have about ``most`` bytes together; every row comes once."""
    for batch in batches:
        sizes = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
        part = np.cumsum(sizes) // most
        starts = np.flatnonzero(np.diff(part, prepend=-1)) if len(part) else np.zeros(0, np.int64)
        for a, b in zip(starts, np.append(starts[1:], batch.num_rows)):
            yield batch.slice(a, b - a)


class Texts:
    """The texts of a column, nulls as empty ones, one behind the other with a break (code point 0) behind each.

    ``begins`` and ``ends`` are the places of the texts in ``points``. Of the words, in order: ``start`` and ``stop``,
    ``what`` (letters, Han, number), ``initial`` (a capital with its dot, which closes nothing), a 64-bit ``hash`` of the
    lower-case form, and ``of``, the text. ``first[i]`` to ``first[i + 1]`` are the words of text ``i``. Apostrophes
    between letters, and commas and points between digits, belong to the word.
    """

    def __init__(self, column: pa.Array):
        texts = column.to_pylist()
        joined = "\0".join(t or "" for t in texts) + "\0"
        self.size = len(texts)
        self.points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
        self.ends = np.cumsum(lengths + 1) - 1
        self.begins = self.ends - lengths
        self._find_words()

    def _find_words(self) -> None:
        table, points = tables(), self.points
        kind = table["kind"][points]
        before, after = np.append(np.uint8(0), kind[:-1]), np.append(kind[1:], np.uint8(0))
        joint = ((points == 0x27) | (points == 0x2019)) & (before == LETTER) & (after == LETTER)
        kind = np.where(joint, LETTER, kind)
        joint = ((points == 0x2E) | (points == 0x2C)) & (before == NUMBER) & (after == NUMBER)
        kind = np.where(joint, NUMBER, kind).astype(np.uint8)
        self.kind = kind
        before, after = np.append(np.uint8(0), kind[:-1]), np.append(kind[1:], np.uint8(0))
        inside = kind != OTHER
        self.start = np.flatnonzero(inside & ((kind != before) | (kind == HAN)))
        self.stop = np.flatnonzero(inside & ((kind != after) | (kind == HAN))) + 1
        self.what = kind[self.start]
        self.of = np.searchsorted(self.ends, self.start, side="right")
        self.first = np.searchsorted(self.of, np.arange(self.size + 1))
        behind = np.append(points, [0, 0])
        dotted = (self.stop - self.start == 1) & table["capital"][points[self.start]] & (behind[self.stop] == 0x2E)
        spaced = behind[np.minimum(self.stop + 1, len(behind) - 1)]
        self.initial = dotted & (table["white"][spaced] | (spaced == 0))
        self._hash_words()

    def _hash_words(self) -> None:
        """A polynomial over the characters, the same wherever the word stands."""
        lengths = self.stop - self.start
        if not len(lengths):
            self.hash = np.zeros(0, np.uint64)
            return
        starts = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) - np.repeat(starts, lengths)
        powers = np.cumprod(np.full(int(lengths.max()) + 1, _STEP))
        mixed = (tables()["lower"][self.points[np.repeat(self.start, lengths) + place]].astype(np.uint64) + np.uint64(1)) * _MIX
        mixed = (mixed ^ (mixed >> np.uint64(29))) * powers[place]
        out = np.add.reduceat(mixed, starts) + self.initial
        self.hash = (out ^ (out >> np.uint64(32))) * _MIX

    def word(self, i: int) -> str:
        """The lower-case form of word ``i``."""
        return "".join(map(chr, tables()["lower"][self.points[self.start[i] : self.stop[i]]]))

    def last_at(self, places: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each text the last of the sorted ``places`` in it, ahead of the place ``before`` if given, or -1."""
        if not len(places):
            return np.full(self.size, -1)
        at = np.searchsorted(places, self.ends if before is None else before) - 1
        found = places[np.maximum(at, 0)]
        return np.where((at >= 0) & (found >= self.begins), found, -1)
