"""Words of many texts as flat arrays: distinct words of a slice, byte-pair merges of all of them at once.

A list of byte strings (or id lists) is one flat array and its ``offsets`` (one more than
there are members).  Arrow's dictionary encoding finds distinct members by their bytes.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

LETTER, NUMBER, OTHER, WHITE = range(4)


def _class(c: str) -> int:
    return LETTER if regex.match(r"\p{L}", c) else NUMBER if regex.match(r"\p{N}", c) else OTHER


#: class of each code point of Latin-1
CLASSES = np.array([_class(chr(i)) for i in range(256)], np.int8)
CLASSES[[*range(9, 14), 0x20, 0x85, 0xA0]] = WHITE
#: bytes that are white space by themselves
WHITE_BYTES = np.zeros(256, bool)
WHITE_BYTES[[*range(9, 14), 0x20]] = True


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column without nulls."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The same as a binary column; offsets count members of ``data``."""
    offsets = offsets * data.itemsize
    if offsets[-1] > np.iinfo(np.int32).max:  # one text of hundreds of megabytes
        return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                     [None, pa.py_buffer(offsets.astype("<i8")), pa.py_buffer(np.ascontiguousarray(data))])
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype("<i4")), pa.py_buffer(np.ascontiguousarray(data))])


def distinct(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each member among the distinct ones; bytes and offsets of these."""
    coded = column(data, offsets).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), *flat(coded.dictionary.cast(pa.binary()))


def take(offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the flat array of the members ``index``, one after the other, and their new offsets."""
    size = offsets[index + 1] - offsets[index]
    ends = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(offsets[index] - ends[:-1], size) + np.arange(ends[-1]), ends


def any_in(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each member has a marked place."""
    upto = np.searchsorted(np.flatnonzero(mask), offsets)
    return upto[1:] > upto[:-1]


def word_offsets(data: np.ndarray, offsets: np.ndarray, findall: Callable[[str], list[str]],
                 single_numbers: bool) -> tuple[np.ndarray, np.ndarray]:
    """Cut each chunk (no white space but a first blank, or white space only) into words.

    Words are runs of letters, of numbers (or single ones) and of other characters; a first
    blank belongs to the word after it.  Chunks with an apostrophe or a character beyond
    Latin-1 are cut by ``findall``.  Returns offsets of the words, and the first word of each
    chunk (with the number of words at the end).
    """
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first, second = data[lead], data[np.minimum(lead + 1, len(data) - 1)]
    code = np.where(first < 0x80, first, (first.astype(np.int64) & 3) << 6 | second & 0x3F)
    kind = CLASSES[code]
    cut = np.ones(len(lead), bool)
    cut[1:] = kind[1:] != kind[:-1]
    if single_numbers:
        cut |= kind == NUMBER
    starts = np.zeros(len(data) + 1, bool)
    starts[lead[cut]] = True
    full = offsets[:-1][np.diff(offsets) > 0]
    starts[full[data[full] == 0x20] + 1] = False
    for i in np.flatnonzero(any_in((data == 0x27) | (data >= 0xC4), offsets)).tolist():
        a, b = int(offsets[i]), int(offsets[i + 1])
        size = [len(w.encode()) for w in findall(data[a:b].tobytes().decode())]
        starts[a:b] = False
        starts[a + np.cumsum([0, *size[:-1]])] = True
    starts[full] = True
    starts[-1] = False
    words = np.append(np.flatnonzero(starts), len(data))
    return words, np.searchsorted(words, offsets)


class Merges:
    """Exact byte-pair merges of many words at once: the pair of lowest rank first, leftmost among equals.

    Words of similar length lie side by side in a matrix, a word in each column.  A round
    merges one pair in every word that still has one.
    """

    WIDTHS = (4, 8, 12, 16, 24, 32, 64)
    NONE = np.iinfo(np.int32).max
    MIX = np.uint64(0x9E3779B97F4A7C15)
    #: words in one matrix
    COLUMNS = 1 << 16

    def __init__(self, pairs: list[tuple[int, int]], merged: list[int]):
        """``pairs`` in the order of their ranks and the id that each becomes."""
        self.merged = np.array(merged, np.int32)
        self.rank_of = {p: r for r, p in enumerate(pairs)}
        both = np.array(pairs, np.int64).reshape(-1, 2)
        # stands for "no symbol": an id that no pair has
        self.blank = int(max(both.max(initial=0), self.merged.max(initial=0))) + 1
        self.bits = max(8, (4 * len(both)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.zeros(1 << self.bits, np.int32)
        keys = both[:, 0] << 32 | both[:, 1]
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # open addressing: all that found their slot taken try the next
            at, which = np.unique(slot[left], return_index=True)
            free = self.keys[at] < 0
            at, which = at[free], left[which[free]]
            self.keys[at], self.ranks[at] = keys[which], which
            left = np.setdiff1d(left, which)
            slot[left] = (slot[left] + 1) & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * self.MIX >> np.uint64(64 - self.bits)).astype(np.int64)

    def scores(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of each pair, then its place, in one number; ``NONE`` if it doesn't merge."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.ranks[slot] << 6 | at, self.NONE).astype(np.int32)
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (1 << self.bits) - 1
            found = self.keys[slot[todo]]
            hit = todo[found == keys[todo]]
            out[hit] = self.ranks[slot[hit]] << 6 | at[hit]
            todo = todo[(found != keys[todo]) & (found >= 0)]
        return out

    def one(self, ids: list[int]) -> list[int]:
        """One word of any length: a heap of pairs over a linked list."""
        n, rank_of = len(ids), self.rank_of.get
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank_of((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] >= 0 and (r := rank_of((ids[x], ids[after[x]]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[after[x]]))
        return [x for x in ids if x >= 0]

    def _matrix(self, ids: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(start)
        place = np.arange(width)[:, None]
        inside = place < size
        # a place is row * n + column; the last row is blank and ends every word on both sides
        symbol = np.full((width + 1) * n, self.blank, np.int32)
        symbol[:width * n] = np.where(inside, ids[np.where(inside, start + place, 0)], self.blank).ravel()
        after = np.arange(n, (width + 2) * n, dtype=np.int32)
        before = np.arange(-n, width * n, dtype=np.int32)
        before[:n] += (width + 1) * n
        score = np.full((width + 1, n), self.NONE, np.int32)
        rows = np.repeat(np.arange(width - 1, dtype=np.int32), n)
        score[:width - 1] = self.scores(symbol[:(width - 1) * n], symbol[n:width * n], rows).reshape(width - 1, n)
        scored = score.reshape(-1)
        live = np.arange(n, dtype=np.int32)
        while len(live):
            best = (score if len(live) == n else score[:, live]).min(axis=0)
            more = best < self.NONE
            live, best = live[more], best[more]
            p = (best & 63) * n + live
            q = after[p]
            r = after[q]
            new = self.merged[best >> 6]
            symbol[p], symbol[q], scored[q] = new, self.blank, self.NONE
            after[p], before[r] = r, p
            b = before[p]
            scored[p] = self.scores(new, symbol[r], best & 63)
            scored[b] = self.scores(symbol[b], new, b // n)
        table = symbol[:width * n].reshape(width, n).T
        kept = table != self.blank
        return table[kept], kept.sum(axis=1)

    def __call__(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every word from those of its single bytes, and their offsets."""
        size = np.diff(offsets)
        lengths = np.zeros(len(size), np.int64)
        parts, order, least = [np.empty(0, np.int32)], [np.flatnonzero(size == 0)], 0
        for width in self.WIDTHS:
            rows = np.flatnonzero((size > least) & (size <= width))
            least = width
            for at in range(0, len(rows), self.COLUMNS):
                some = rows[at:at + self.COLUMNS]
                part, lengths[some] = self._matrix(ids, offsets[some], size[some], width)
                parts.append(part)
                order.append(some)
        rows = np.flatnonzero(size > least)
        for i in rows.tolist():
            parts.append(np.array(self.one(ids[offsets[i]:offsets[i + 1]].tolist()), np.int32))
            lengths[i] = len(parts[-1])
        order = np.concatenate([*order, rows])
        done = np.concatenate([[0], np.cumsum(lengths[order])])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at, ends = take(done, place)
        return np.concatenate(parts)[at].astype(np.uint32), ends
