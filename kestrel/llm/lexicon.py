"""Minimal acyclic transducer over byte words, stored as flat arrays that tasks memory-map.

Words are added in byte order; states with equal futures are shared (same finality and same labelled edges), so the
automaton is minimal. Each edge carries the number of words that precede its branch; the sum along a word's path is
the word's number in byte order, and that number selects the word's output, a run of token ids.

File layout (little endian): six uint64 lengths, then the arrays
``edge_start`` uint32 [states + 1], ``final`` uint8 [states], ``label`` uint8 [edges], ``target`` uint32 [edges],
``skip`` uint32 [edges], ``out_start`` uint32 [words + 1], ``out`` uint32 [ids].
"""

from __future__ import annotations

import mmap
import struct
from array import array
from collections.abc import Iterable, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa


class _Node:
    __slots__ = ("final", "edges", "words", "number")

    def __init__(self):
        self.final, self.edges, self.words, self.number = False, [], 0, -1

    def key(self):
        return (self.final, tuple((b, id(n)) for b, n in self.edges))


def build(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """Serialized transducer for (word, output ids) pairs; words must be distinct and in byte order."""
    root, register, path, last = _Node(), {}, [], b""
    path.append(root)
    out, out_start = array("I"), array("I", [0])
    first = True

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            node = path.pop()
            same = register.setdefault(node.key(), node)
            if same is not node:
                path[-1].edges[-1] = (path[-1].edges[-1][0], same)

    for word, ids in entries:
        if not first and word <= last:
            raise ValueError("words must be distinct and in byte order")
        common = 0
        limit = min(len(word), len(last))
        while common < limit and word[common] == last[common]:
            common += 1
        freeze(common)
        for b in word[common:]:
            node = _Node()
            path[-1].edges.append((b, node))
            path.append(node)
        path[-1].final = True
        out.extend(ids)
        out_start.append(len(out))
        last, first = word, False
    freeze(0)

    # Number the states and count the words below each (iteratively, deepest first).
    order, stack, seen = [], [root], {id(root)}
    while stack:
        node = stack.pop()
        node.number = len(order)
        order.append(node)
        for _, n in node.edges:
            if id(n) not in seen:
                seen.add(id(n))
                stack.append(n)
    todo, done = [root], set()
    while todo:
        node = todo[-1]
        rest = [n for _, n in node.edges if id(n) not in done]
        if rest:
            todo.extend(rest)
        else:
            todo.pop()
            if id(node) not in done:
                node.words = int(node.final) + sum(n.words for _, n in node.edges)
                done.add(id(node))

    edge_start, final = array("I", [0]), array("B")
    label, target, skip = array("B"), array("I"), array("I")
    for node in order:
        before = int(node.final)
        for b, n in node.edges:
            label.append(b)
            target.append(n.number)
            skip.append(before)
            before += n.words
        edge_start.append(len(label))
        final.append(int(node.final))
    head = struct.pack("<6Q", len(edge_start), len(final), len(label), len(out_start), len(out), 0)
    parts = [np.array(x, dtype=t).tobytes() for x, t in (
        (edge_start, "<u4"), (target, "<u4"), (skip, "<u4"), (out_start, "<u4"), (out, "<u4"), (final, "u1"), (label, "u1"))]
    return head + b"".join(parts)


class Lexicon:
    """Read side: ``lookup(word)`` gives the stored output as little-endian uint32 bytes, or None."""

    def __init__(self, buffer):
        view = memoryview(buffer)
        self.find = buffer.find  # of bytes and of mapped files alike
        starts, states, edges, outs, ids, _ = struct.unpack_from("<6Q", view, 0)
        at = 48

        def take(n: int, width: int):
            nonlocal at
            part = view[at : at + n * width]
            at += n * width
            return part

        self.edge_start = take(starts, 4).cast("I")
        self.target = take(edges, 4).cast("I")
        self.skip = take(edges, 4).cast("I")
        self.out_start = take(outs, 4).cast("I")
        self.out = take(ids, 4)
        self.final = take(states, 1)
        self.label_at = at
        self.label = take(edges, 1)

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        """Memory-map the file: the tasks of an executor share its pages and read only what their words touch."""
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def __len__(self) -> int:
        return len(self.out_start) - 1

    def number(self, word: bytes) -> int:
        """The word's number in byte order, or -1."""
        state, n = 0, 0
        find, edge_start, at = self.find, self.edge_start, self.label_at
        for i in range(len(word)):
            edge = find(word[i : i + 1], at + edge_start[state], at + edge_start[state + 1]) - at
            if edge < 0:
                return -1
            n += self.skip[edge]
            state = self.target[edge]
        return n if self.final[state] else -1

    @cached_property
    def _edges(self) -> np.ndarray:
        """State and label of every edge as one number, ascending: an edge is found by one search."""
        starts = np.asarray(self.edge_start)
        state = np.repeat(np.arange(len(starts) - 1, dtype=np.int64), np.diff(starts))
        return np.append(state << 8 | np.asarray(self.label), np.iinfo(np.int64).max)

    def numbers(self, rows: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """``number`` for a matrix of words (uint8 [words, width], row i holds lens[i] bytes)."""
        target, skip = np.append(np.asarray(self.target), 0), np.append(np.asarray(self.skip), 0)
        state, number = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)
        for i in range(rows.shape[1]):
            on = np.flatnonzero((lens > i) & (state >= 0))
            if not len(on):
                break
            key = state[on] << 8 | rows[on, i]
            edge = np.searchsorted(self._edges, key)
            found = self._edges[edge] == key
            number[on] += np.where(found, skip[edge], 0)
            state[on] = np.where(found, target[edge], -1)
        final = np.asarray(self.final)
        return np.where((state >= 0) & (final[np.maximum(state, 0)] > 0), number, -1)

    @cached_property
    def outputs(self) -> pa.Array:
        """The output of every word by its number, as binary values over the mapped file."""
        ends = (np.asarray(self.out_start).astype(np.int64) * 4).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(self), [None, pa.py_buffer(ends), pa.py_buffer(self.out)])

    def lookup(self, word: bytes) -> bytes | None:
        n = self.number(word)
        if n < 0:
            return None
        return bytes(self.out[4 * self.out_start[n] : 4 * self.out_start[n + 1]])
