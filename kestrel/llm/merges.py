"""Merges of adjacent symbols by rank, for many words at once (shared by operators 3 and 13).

``MergeTable`` holds the pairs that merge, their ranks and the symbols they make. ``merge_rows`` merges a matrix of words,
one merge per word and step: always the pair of lowest rank, leftmost first. Steps are bounded by the width, so words are
dealt to matrices by length (``WIDTHS``); longer words go one by one through ``merge_long``, in O(n log n).
"""

from __future__ import annotations

import heapq
from functools import cached_property

import numpy as np
import pyarrow as pa

WIDTHS = (6, 10, 16, 32)  # symbols; the widest matrix
MATRIX_WORDS = 1 << 15  # words of a matrix
NEVER = np.iinfo(np.int32).max
NO_KEY = np.iinfo(np.int64).max
SPREAD = np.uint64(0x9E3779B97F4A7C15)  # odd, about 2^64 / golden ratio: spreads keys over the slots


class MergeTable:
    """Pairs of symbols by key, in a hash table with one slot in eight taken, so that most searches take one step."""

    def __init__(self, left, right, rank, made):
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        self.key = np.append(left << 32 | right, NO_KEY)
        self.rank = np.append(np.asarray(rank, np.int32), NEVER).astype(np.int32)
        self.made = np.append(np.asarray(made, np.int32), -1).astype(np.int32)
        n = len(left)
        self.bits = max(3, n.bit_length() + 3)
        self.slot_key = np.full(1 << self.bits, NO_KEY, np.int64)
        self.slot_at = np.full(1 << self.bits, n, np.int32)
        todo, slot = np.arange(n), self._slot(self.key[:-1])
        while len(todo):
            free = self.slot_key[slot] == NO_KEY
            self.slot_at[slot[free]] = todo[free]
            self.slot_key[slot[free]] = self.key[self.slot_at[slot[free]]]
            rest = self.slot_at[slot] != todo
            todo, slot = todo[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * SPREAD >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of the pairs in the table; the last place for pairs that do not merge."""
        key = left.astype(np.int64) << 32 | right
        slot = self._slot(key)
        at, seen = self.slot_at[slot], self.slot_key[slot]
        more = np.flatnonzero((seen != key) & (seen != NO_KEY))
        while len(more):
            slot[more] = (slot[more] + 1) & ((1 << self.bits) - 1)
            seen = self.slot_key[slot[more]]
            at[more] = self.slot_at[slot[more]]
            more = more[(seen != key[more]) & (seen != NO_KEY)]
        return at

    @cached_property
    def pairs(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.key[:-1].tolist(), zip(self.rank.tolist(), self.made.tolist())))


def merge_rows(table: MergeTable, ids: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, lengths) after all merges; ``ids`` is int32 [words, width], row i holds lens[i] symbols."""
    n, width = ids.shape
    out, out_len = ids.copy(), lens.copy()
    if width < 2 or not n:
        return out, out_len
    row, lens = np.arange(n), lens.copy()
    inside = np.arange(1, width)[None, :] < lens[:, None]
    rank = np.full((n, width - 1), NEVER, np.int32)
    rank[inside] = table.rank[table.find(ids[:, :-1][inside], ids[:, 1:][inside])]
    while len(row):
        at = rank.argmin(1)
        each = np.arange(len(row))
        go = rank[each, at] < NEVER
        done = ~go
        if done.any():
            out[row[done], : ids.shape[1]] = ids[done]
            out_len[row[done]] = lens[done]
            row, ids, lens, rank, at = row[go], ids[go], lens[go], rank[go], at[go]
            each = np.arange(len(row))
            if not len(row):
                break
        made = table.made[table.find(ids[each, at], ids[each, at + 1])]
        col = np.arange(ids.shape[1] - 1)[None, :]
        ids = np.take_along_axis(ids, col + (col > at[:, None]), 1)
        ids[each, at] = made
        lens -= 1
        if ids.shape[1] == 1:
            rank = np.full((len(row), 1), NEVER, np.int32)
            ids = np.pad(ids, ((0, 0), (0, 1)))
            continue
        col = col[:, :-1]
        rank = np.take_along_axis(rank, col + (col >= at[:, None]), 1)
        for place in (at - 1, at):
            ok = (place >= 0) & (place + 1 < lens)
            r, p = each[ok], place[ok]
            rank[r, p] = table.rank[table.find(ids[r, p], ids[r, p + 1])]
        last = at == lens - 1  # nothing stands right of the new symbol
        inside = last & (at < rank.shape[1])
        rank[each[inside], at[inside]] = NEVER
    return out, out_len


def merge_long(table: MergeTable, ids: list[int]) -> list[int]:
    """The same for one word of any length: a heap over a linked list."""
    n, get = len(ids), table.pairs.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(*m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := get(ids[i] << 32 | ids[i + 1])) is not None]
    # lowest rank, then leftmost
    heap = [(r, i, made, a, b) for r, made, i, a, b in heap]
    heapq.heapify(heap)
    while heap:
        _, i, made, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], ids[j] = made, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (x := get(made << 32 | ids[k])) is not None:
                heapq.heappush(heap, (x[0], i, x[1], made, ids[k]))
        p = before[i]
        if p >= 0 and (x := get(ids[p] << 32 | made)) is not None:
            heapq.heappush(heap, (x[0], p, x[1], ids[p], made))
    return [x for x in ids if x >= 0]


def by_width(lens: np.ndarray):
    """(numbers of words, width) of every matrix, at most ``MATRIX_WORDS`` words each; longer words are left out."""
    low = -1
    for width in WIDTHS:
        chosen = np.flatnonzero((lens > low) & (lens <= width))
        for i in range(0, len(chosen), MATRIX_WORDS):
            yield chosen[i : i + MATRIX_WORDS], width
        low = width


def binary_parts(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts) of a binary or string array without NULLs."""
    starts = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = values.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), starts


def byte_rows(data: np.ndarray, starts: np.ndarray, chosen: np.ndarray, width: int) -> np.ndarray:
    """The chosen values' bytes as a matrix, padded with zeros."""
    lens = (starts[chosen + 1] - starts[chosen])[:, None]
    col = np.arange(width)[None, :]
    inside = col < lens
    if not len(data):
        return np.zeros(inside.shape, np.uint8)
    return np.where(inside, data[np.where(inside, starts[chosen][:, None] + col, 0)], 0)


def packed(rows: np.ndarray, lens: np.ndarray) -> pa.Array:
    """Rows of symbols as binary values of little-endian 32-bit numbers."""
    flat = rows[np.arange(rows.shape[1])[None, :] < lens[:, None]].astype("<u4")
    ends = np.concatenate([[0], np.cumsum(lens) * 4]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def in_order(parts: list[pa.Array], places: list[np.ndarray]) -> pa.Array:
    """Values of several arrays, put at their places."""
    place = np.concatenate(places) if places else np.zeros(0, np.int64)
    back = np.empty(len(place), np.int64)
    back[place] = np.arange(len(place))
    return (pa.concat_arrays(parts) if parts else pa.array([], pa.binary())).take(pa.array(back))
