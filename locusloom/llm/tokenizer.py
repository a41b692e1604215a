"""Encoding of whole corpora with a public byte-level BPE vocabulary.

Texts of a batch are one array of code points. A table gives each its class, a finite automaton over the classes
reads the split pattern, and its transition functions, being associative under composition, are scanned in blocks:
no regular expression walks the text. The slices between boundaries go to rank-wise pair merging behind a cache.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER = "/opt/tokenizers"

# Classes of code points and, below, the symbols that the automaton reads.
_LETTER, _NUMBER, _OTHER, _SPACE = range(4)
#: The code points with the property White_Space.
_WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: What follows an apostrophe in the contractions of the split pattern.
_ONE, _TWO = "stmd", ("re", "ve", "ll")

L, N, O, SHORT, LONG, JOIN, LAST, WHITE, BREAK = range(9)  # noqa: E741
# States: inside a run of letters, numbers, others, white space; behind a space that joins what follows; with one or
# two characters of a contraction to come; at a fresh start.
IN_L, IN_N, IN_O, IN_W, JOINED, ONE_LEFT, TWO_LEFT, FRESH = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """``follow[symbol, state]`` and ``splits[symbol, state]``: the next state, and if a slice begins there."""
    to = {L: IN_L, N: IN_N, O: IN_O, SHORT: ONE_LEFT, LONG: TWO_LEFT, JOIN: JOINED, LAST: IN_W, WHITE: IN_W, BREAK: FRESH}
    follow = np.repeat(np.array([to[s] for s in range(9)], np.uint8)[:, None], 8, axis=1)
    splits = np.ones((9, 8), bool)
    goes_on = {(L, IN_L): IN_L, (L, JOINED): IN_L, (L, ONE_LEFT): FRESH, (L, TWO_LEFT): ONE_LEFT, (N, IN_N): IN_N, (N, JOINED): IN_N, (WHITE, IN_W): IN_W}
    goes_on |= {(s, state): IN_O for s in (O, SHORT, LONG) for state in (IN_O, JOINED)}
    for (symbol, state), after in goes_on.items():
        follow[symbol, state], splits[symbol, state] = after, False
    return follow, splits


_FOLLOW, _SPLITS = _automaton()


@lru_cache(1)
def _classes() -> np.ndarray:
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))[0]
        if c == "L":
            kinds[i] = _LETTER
        elif c == "N":
            kinds[i] = _NUMBER
    kinds[_WHITE] = _SPACE
    return kinds


def _symbols(points: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """What the automaton reads at each code point. ``breaks``: positions behind the texts, which hold no character."""
    kind = _classes()[points]
    kind[breaks] = 255
    after = np.append(kind[1:], 255)
    out = np.array([L, N, O, WHITE], np.uint8)[np.minimum(kind, 3)]
    before_text = (kind == _SPACE) & (after != _SPACE) & (after != 255)
    out[before_text] = np.where(points[before_text] == 0x20, JOIN, LAST)
    marks = np.flatnonzero(points == ord("'"))
    padded = np.append(points, [0, 0])
    first, second = padded[marks + 1], padded[marks + 2]
    out[marks[np.isin(first, [ord(c) for c in _ONE])]] = SHORT
    for a, b in _TWO:
        out[marks[(first == ord(a)) & (second == ord(b))]] = LONG
    out[breaks] = BREAK
    return out


def _scan(symbols: np.ndarray, width: int = 64) -> np.ndarray:
    """State before each symbol. Blocks are composed to one function each, those are scanned, then filled in."""
    n = len(symbols)
    blocks = -(-n // width)
    grid = np.full(blocks * width, BREAK, np.uint8)
    grid[:n] = symbols
    grid = grid.reshape(blocks, width)
    whole = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))
    for column in grid.T:
        whole = _FOLLOW[column[:, None], whole]
    step = 1
    while step < blocks:  # inclusive scan of functions by doubling
        whole[step:] = np.take_along_axis(whole[step:], whole[:-step].copy(), axis=1)
        step *= 2
    state = np.append(FRESH, whole[:-1, FRESH]).astype(np.uint8)
    before = np.empty((blocks, width), np.uint8)
    for i, column in enumerate(grid.T):
        before[:, i] = state
        state = _FOLLOW[column, state]
    return before.reshape(-1)[:n]


def split_texts(texts: list[str]) -> list[list[str]]:
    """The slices of each text by the public split pattern."""
    if not texts:
        return []
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    symbols = _symbols(points, ends - 1)
    starts = np.flatnonzero(_SPLITS[symbols, _scan(symbols)])
    out, at = [], np.searchsorted(starts, np.append(0, ends))
    for i, (a, b) in enumerate(zip(at[:-1], at[1:])):
        cuts = starts[a:b].tolist()  # the last one is the break behind the text
        out.append([joined[x:y] for x, y in zip(cuts, cuts[1:])])
        assert not cuts or cuts[-1] == ends[i] - 1
    return out


class ByteBpe:
    """Ids of slices by merging the pair of lowest rank first."""

    CACHED, LENGTH = 1 << 18, 48

    def __init__(self, path: str):
        self.ranks = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """A heap of the ranks of neighbouring parts; each merge touches two neighbours, so long slices stay cheap."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return (whole,)
        n = len(piece)
        ends = list(range(1, n + 1))  # end of the part that begins at i; 0 once it is merged into another
        before = list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            middle = ends[i]
            if not middle or middle >= n or ranks.get(piece[i : ends[middle]]) != rank:
                continue
            ends[i], ends[middle] = ends[middle], 0
            if ends[i] < n:
                before[ends[i]] = i
                if (r := ranks.get(piece[i : ends[ends[i]]])) is not None:
                    heapq.heappush(heap, (r, i))
            if i and (r := ranks.get(piece[before[i] : ends[i]])) is not None:
                heapq.heappush(heap, (r, before[i]))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : ends[i]]])
            i = ends[i]
        return tuple(out)

    def slice_ids(self, piece: str) -> tuple[int, ...]:
        ids = self.cache.get(piece)
        if ids is None:
            ids = self.merge(piece.encode("utf-8", "replace"))
            if len(piece) <= self.LENGTH:
                if len(self.cache) >= self.CACHED:
                    self.cache.clear()
                self.cache[piece] = ids
        return ids

    def encode(self, texts: list[str | None], at_once: int = 1 << 20) -> Iterator[list[int]]:
        """Ids of each text; null and empty ones have none. Texts are split together up to ``at_once`` characters."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= at_once:
                yield from self._encode(group)
                group, size = [], 0
        yield from self._encode(group)

    def _encode(self, group: list[str]) -> Iterator[list[int]]:
        look = self.slice_ids
        for slices in split_texts(group) if group else ():
            yield [i for s in slices for i in look(s)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")


@lru_cache(2)
def load(path: str) -> ByteBpe:
    """One vocabulary per Python worker."""
    return ByteBpe(path)


def vocabulary(name: str = "byte_bpe_50k", folder: str = FOLDER) -> str:
    return f"{folder}/{name}.tiktoken"


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than the cluster has cores goes to all cores; larger ones stay where they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def encode_texts(df: DataFrame, keys: list[str], text: str, path: str | None = None) -> DataFrame:
    """``keys``, ``ids`` and ``offsets`` of each row: token ids without special tokens, and where each begins.

    ``offsets`` are byte positions in the UTF-8 text, one for each id. Null and empty texts have empty lists. Strings
    of special tokens are ordinary text. Repeated rows stay. ``path`` names the vocabulary file, which every executor
    must see. Other columns of ``df`` do not matter, as only keys and text are read.
    """
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        sizes = np.zeros(max(bpe.tokens) + 1, np.int32)
        for i, token in bpe.tokens.items():
            sizes[i] = len(token)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            ids = [np.array(x, np.int32) for x in bpe.encode(texts)]
            ends = pa.array(np.cumsum([0, *map(len, ids)]).astype(np.int32))
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            starts = [np.cumsum(sizes[x]) - sizes[x] for x in ids]
            starts = np.concatenate(starts).astype(np.int32) if starts else flat
            lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (flat, starts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], names=[*keys, "ids", "offsets"])

    ids = T.ArrayType(T.IntegerType())
    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField("ids", ids), T.StructField("offsets", ids)])
    return df.select(*keys, F.col(text).alias("__text")).mapInArrow(run, schema)


def token_count(text: Column, path: str | None = None) -> Column:
    """Number of tokens of each text; null for a null text."""
    path = path or vocabulary()

    @F.pandas_udf(T.IntegerType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:

        bpe = load(path)
        for texts in batches:
            yield pd.Series([None if t is None else len(x) for t, x in zip(texts, bpe.encode(texts.tolist()))], dtype="Int32")

    return count(text)
