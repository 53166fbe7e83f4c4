"""Gradient boosting on binned rows: leaf-wise trees (C6), symmetric trees (C7, C8), round-wise early stopping (V9).

Rows are one byte per feature (``binning``), a label, a fold number, and one margin per fit; several fits (folds, refits,
trials) share the rows and every scan. They are kept in blocks of ``BLOCK`` rows, column by column, in a cached RDD: its elements reach
Python as the bytes that they are stored as, where a table's columns would be copied into Arrow vectors first. A scan is one
pass over the blocks: it applies the trees grown since the margins were written, routes rows through the tree in progress and
adds up, per fit, node and bin, the gradients, hessians and rows of the nodes asked for; columns of few bins are counted
together, by the code of their combination. Gradients and hessians are whole numbers (units of 2^-24), so sums are exact, do not
depend on the order of tasks, and a repeated task gives the same tree. Per scan the driver holds fits x nodes x bins
numbers, a size set by parameters. With many partitions the sums are merged in Spark in groups of ``MERGE`` first.

Leaf-wise growth (Ke et al., 2017): the node of highest gain G^2/(H + l2) is split next, until ``num_leaves`` leaves. Only the
smaller child of a split is counted, its sibling is parent minus child. Which splits best-first growth will choose depends
only on nodes' gains, so a scan expands every node that is among the remaining best at once: a tree takes about as many
scans as it has levels, and ends exactly as growth split by split would.

Symmetric growth (Prokhorenkova et al., 2018): one split for all nodes of a level, chosen by the sum of G^2/(H + l2) over
them; a tree is a list of splits and 2^depth values, and a row's value is looked up by the bits of its comparisons.
``random_strength`` adds seeded normal noise to the square root of a split's score, scaled by the gradients' root mean square
and fading with the trees grown; ``colsample`` draws columns per level; ``bagging_temperature`` t draws Bayesian-bootstrap
weights (-ln u)^t anew per tree from a hash of the row's key.

Early stopping: with validation rows (their fold left out of the fit), the scan that starts a tree also returns the
validation rows' scores, counted in 2^16 cells of probability, so the AUC after every tree costs no extra pass; pairs inside
one cell count half. Growth ends when the AUC has not risen for ``patience`` trees and keeps the best number of trees.

Margins are kept anew every ``CUT_TREES`` trees (leaf-wise ``CUT_LEAFWISE``) in a cached RDD, and lineage is cut every
``CUT_MOVES`` of them; a lost executor repeats the steps since.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import operator
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.operators.binning import Borders, packed_rows, unpacked_rows
from kestrel.session import cut_lineage, default_parallelism, ensure_checkpoint_dir

UNIT = float(1 << 24)  # gradients and hessians are rounded to this fraction
CUT_TREES = 10  # trees of a fit between two copies of margins
CUT_LEAFWISE = 2  # the same for leaf-wise trees, on average over the fits
CUT_MOVES = 8  # copies of margins between two checkpoints
AUC_CELLS = 1 << 16
LEAST_GAIN = 1e-9  # of a level of a symmetric tree
MERGE = 32  # partial sums of one node that a task adds up
BLOCK = 1 << 15  # rows that are kept together, column by column
MASKED = 64  # leaves, or nodes asked for, of a tree that is walked through by masks of all rows
GROUP_CELLS = 256  # combinations of bins that columns counted together may have
EXACT_BITS = 53  # of a whole number in a double
TASK_ROWS = 1 << 20  # rows of a task, about
TASK_BYTES = 64 << 20  # of its blocks
LEAST_ROWS = 1 << 16  # rows times fits that are worth a task of their own
SCAN_BYTES = 256 << 20  # sums that a task holds in one scan
NO_FOLD = -1  # the fold number of rows that no fit learns from


@dataclass(frozen=True)
class Setting:
    """``growth`` is 'leaf' or 'level'. Rates and limits are those of the usual boosters."""

    growth: str = "leaf"
    trees: int = 100
    rate: float = 0.1
    num_leaves: int = 31
    min_rows: int = 20
    min_hessian: float = 1e-3
    depth: int = 6
    l2: float = 0.0
    borders: int = 254
    bagging_temperature: float = 0.0
    random_strength: float = 0.0
    colsample: float = 1.0
    seed: int = 42


@dataclass
class Fit:
    """One model: its columns of the matrix, the fold left out (None: none), and how it may end early."""

    setting: Setting
    columns: list[int]
    left_out: int | None = None
    patience: int | None = None  # with ``left_out``: stop when its AUC has not risen for so many trees


@dataclass
class Tree:
    """Nodes in arrays: column, bin (rows with a greater bin go right), children (-1 for leaves), value (0 inside)."""

    column: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    gain: np.ndarray

    def parts(self, columns, n: int, asked: np.ndarray | None = None, rows: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(node, its rows) of the leaves, or of the nodes that ``asked`` marks; branches without any are not entered. ``rows``:
        the places of the rows that are looked at (all ``n``)."""
        todo, whole = [(0, np.arange(n) if rows is None else rows)], asked is None
        if not whole:
            enter = asked.copy()
            for i in range(len(enter) - 1, -1, -1):  # children come after their parents
                if self.left[i] >= 0:
                    enter[i] |= enter[self.left[i]] | enter[self.right[i]]
        while todo:
            node, at = todo.pop()
            left = int(self.left[node])
            if (left < 0 and whole) or (not whole and asked[node]):
                yield node, at
            right = int(self.right[node])
            if left < 0 or not (whole or enter[left] or enter[right]):
                continue
            goes = columns[int(self.column[node])][at] > int(self.bin[node])
            if whole or enter[right]:
                todo.append((right, at[goes]))
            if whole or enter[left]:
                todo.append((left, at[~goes]))

    def numbers(self, columns, n: int, number: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """``number`` (node -> 0 to ``MASKED``, -1 for none) of the node that a row is in, plus one; 0 for rows in none and outside
        the mask ``rows``. The numbered nodes have no numbered ones below them. Bytes are compared by the vector: a tree of few
        nodes takes less than dealing out the rows' places."""
        out, enter = np.zeros(n, np.uint8), number >= 0
        for i in range(len(enter) - 1, -1, -1):  # children come after their parents
            if self.left[i] >= 0:
                enter[i] |= enter[self.left[i]] | enter[self.right[i]]
        todo = [(0, np.ones(n, bool) if rows is None else rows)] if enter[0] else []
        while todo:
            node, own = todo.pop()
            if number[node] >= 0:
                out |= own.view(np.uint8) * np.uint8(number[node] + 1)
                continue
            left, right = int(self.left[node]), int(self.right[node])
            goes = columns[int(self.column[node])] > int(self.bin[node])
            if enter[right]:
                todo.append((right, own & goes))
            if enter[left]:
                todo.append((left, own > goes))
        return out

    def values(self, columns, n: int) -> np.ndarray:
        """The value of every row, from its columns."""
        leaves = np.flatnonzero(self.left < 0)
        if len(leaves) <= MASKED:
            number = np.full(len(self.left), -1)
            number[leaves] = np.arange(len(leaves))
            return np.take(self.value[leaves], self.numbers(columns, n, number) - 1)
        out = np.empty(n)
        for node, at in self.parts(columns, n):
            out[at] = self.value[node]
        return out

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.values(bins.T, len(bins))


@dataclass
class SymmetricTree:
    """A split per level and a value per combination of their outcomes (the first split is the highest bit)."""

    column: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    gain: np.ndarray

    def nodes(self, columns, n: int) -> np.ndarray:
        place = np.zeros(n, np.uint8 if len(self.column) <= 8 else np.int64)
        for c, b in zip(self.column, self.bin):
            place <<= 1
            place |= columns[int(c)] > int(b)  # bytes against a byte
        return place

    def values(self, columns, n: int) -> np.ndarray:
        return np.take(self.value, self.nodes(columns, n))

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return self.values(bins.T, len(bins))


@dataclass
class Boosted:
    """A fitted model over the matrix's columns; ``auc`` holds the validation AUC after 0, 1, 2, ... trees."""

    base: float
    trees: list
    auc: list[float] = field(default_factory=list)


# ---- what tasks do --------------------------------------------------------------------------------------------------
def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-m))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits (splitmix64; fixed constants)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def bootstrap_weights(key: np.ndarray, setting: Setting, tree: int) -> np.ndarray:
    """Bayesian-bootstrap weights of one tree, from the rows' keys."""
    draw = mix64(np.array([setting.seed * 1_000_003 + tree], np.uint64))
    u = ((mix64(key.view(np.uint64) ^ draw) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    return -np.log(u) if setting.bagging_temperature == 1 else (-np.log(u)) ** setting.bagging_temperature


def gradients(y, margin, key, setting: Setting, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and hessians of the log loss as whole numbers."""
    p = sigmoid(margin)
    g, h = p - y, p * (1.0 - p)
    if setting.growth == "level" and setting.bagging_temperature > 0:
        w = bootstrap_weights(key, setting, tree)
        g, h = g * w, h * w
    return np.floor(g * UNIT + 0.5), np.floor(h * UNIT + 0.5)


def column_groups(sizes: Sequence[int], cells: int = GROUP_CELLS) -> list[list[int]]:
    """Columns that are counted together: as many of few bins as have ``cells`` combinations of bins at most."""
    groups, product = [], cells + 1
    for c in sorted(range(len(sizes)), key=lambda c: sizes[c]):
        if product * sizes[c] > cells:
            groups.append([])
            product = 1
        groups[-1].append(c)
        product *= int(sizes[c])
    return groups


@dataclass
class Ask:
    """What a scan counts for one fit: trees not yet in the margins, the tree in progress, its nodes' places in the result."""

    fit: Fit
    base: float
    sizes: np.ndarray  # bins of the fit's columns
    number: int  # of the tree in progress
    pending: list
    tree: Tree | SymmetricTree | None
    place: np.ndarray  # node -> place, -1 if not asked for
    places: int
    scores: bool = False  # also count the validation rows' scores

    def __post_init__(self):
        self.groups = column_groups(self.sizes)

    def shapes(self) -> list[list[int]]:
        return [[int(self.sizes[c]) for c in group] for group in self.groups]

    def cells(self) -> int:
        """Numbers of one kind that a task holds per place."""
        return max(sum(math.prod(s) for s in self.shapes()), int(self.sizes.sum()))

    def sums(self) -> list[np.ndarray]:
        """Zeros for every group of columns: [gradient, hessian, rows] x places x combinations of bins."""
        return [np.zeros((3, self.places, math.prod(s)), np.int64) for s in self.shapes()]

    def total(self, sums: list[np.ndarray]) -> np.ndarray:
        """[gradient, hessian, rows] x places x bins of the columns one by one."""
        out = np.zeros((3, self.places, int(self.sizes.sum())), np.int64)
        ends = np.cumsum(self.sizes)
        for group, shape, s in zip(self.groups, self.shapes(), sums):
            s = s.reshape(3, self.places, *shape)
            for k, c in enumerate(group):
                out[:, :, ends[c] - self.sizes[c] : ends[c]] = s.sum(tuple(i + 2 for i in range(len(group)) if i != k))
        return out

    def count(self, block: Block, margin: np.ndarray, sums: list[np.ndarray], cells: np.ndarray | None) -> None:
        out = np.zeros(block.n, bool) if self.fit.left_out is None else block.fold == self.fit.left_out
        if cells is not None and out.any():
            at = np.flatnonzero(out)
            score = sigmoid(self.margin({c: block.columns[c][at] for c in self.fit.columns}, margin[at]))
            cell = np.minimum((score * AUC_CELLS).astype(np.int64), AUC_CELLS - 1)
            cells += np.bincount(cell * 2 + (block.y[at] > 0), minlength=2 * AUC_CELLS)
        use, place = self.rows(block, ~out & (block.fold != NO_FOLD))
        if not len(use):
            return
        columns = {c: block.columns[c][use] for c in self.fit.columns}
        key = None if block.key is None else block.key[use]
        g, h = gradients(block.y[use], self.margin(columns, margin[use]), key, self.fit.setting, self.number)
        # one sum for hessians and rows: a row adds 2^bits, more than all hessians together
        bits = int(h.sum()).bit_length()
        if bits + len(use).bit_length() <= EXACT_BITS:
            unit = float(1 << bits)
            h = h + unit
        else:
            unit = None
        for group, shape, total in zip(self.groups, self.shapes(), sums):
            code = columns[self.fit.columns[group[0]]]
            for c, size in zip(group[1:], shape[1:]):
                code = code * np.uint8(size) + columns[self.fit.columns[c]] if size > 1 else code
            n = math.prod(shape)
            at = (code if self.places == 1 else place * n + code).astype(np.intp, copy=False)  # once for all sums
            size, form = self.places * n, (self.places, n)
            total[0] += np.bincount(at, g, size).astype(np.int64).reshape(form)
            hessian = np.bincount(at, h, size)
            if unit is None:
                rows = np.bincount(at, minlength=size)
            else:
                rows = np.floor(hessian / unit)
                hessian -= rows * unit
            total[1] += hessian.astype(np.int64).reshape(form)
            total[2] += rows.astype(np.int64, copy=False).reshape(form)

    def margin(self, columns, margin: np.ndarray) -> np.ndarray:
        margin = margin + self.base
        for t in self.pending:
            margin += t.values(columns, len(margin))
        return margin

    def rows(self, block: Block, learns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the learning rows of the nodes asked for, their places)"""
        if self.tree is None:
            use = np.flatnonzero(learns)
            return use, np.zeros(len(use), np.int64)
        if isinstance(self.tree, Tree) and max(self.places, np.count_nonzero(self.tree.left >= 0)) <= MASKED:
            number = self.tree.numbers(block.columns, block.n, self.place, learns)
            use = np.flatnonzero(number)
            return use, number[use] - np.int64(1)
        if isinstance(self.tree, Tree):
            parts = [(self.place[n], at) for n, at in self.tree.parts(block.columns, block.n, self.place >= 0, np.flatnonzero(learns))]
            if not parts:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            return np.concatenate([at for _, at in parts]), np.repeat([p for p, _ in parts], [len(at) for _, at in parts])
        place = self.place[self.tree.nodes(block.columns, block.n)]
        use = np.flatnonzero(learns & (place >= 0))
        return use, place[use]


def scan(rows: Blocks, asks: dict[int, Ask]) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """(fit -> [gradient, hessian, rows] x places x bins, fit -> score cells) over all rows."""

    def run(blocks: Iterator[Block]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        sums = {f: a.sums() for f, a in asks.items()}
        cells = {f: np.zeros(2 * AUC_CELLS, np.int64) for f, a in asks.items() if a.scores}
        for block in blocks:
            for f, a in asks.items():
                a.count(block, block.margins[f], sums[f], cells.get(f))
        for f, a in asks.items():
            total = a.total(sums[f])
            for p in np.flatnonzero(total[2].any(1)):
                yield (f, int(p)), total[:, p]
        for f, c in cells.items():
            yield (f, -1), c

    totals = {f: np.zeros((3, a.places, int(a.sizes.sum())), np.int64) for f, a in asks.items()}
    cells = {f: np.zeros(2 * AUC_CELLS, np.int64) for f, a in asks.items() if a.scores}
    for (f, p), one in merged(rows.rdd.mapPartitions(run), rows.partitions).collect():
        if p < 0:
            cells[f] += one
        else:
            totals[f][:, p] += one
    return totals, cells


def merged(part: RDD, partitions: int) -> RDD:
    """Partial sums ((fit, place), numbers) added up in Spark, ``MERGE`` at a time, until few are left for each."""
    while partitions > MERGE:
        partitions = lots = -(-partitions // MERGE)

        def dealt(i: int, found: Iterator, lots: int = lots) -> Iterator:
            return (((key, i % lots), one) for key, one in found)

        part = part.mapPartitionsWithIndex(dealt).reduceByKey(operator.add, partitions).map(lambda x: (x[0][0], x[1]))
    return part


@dataclass
class Block:
    """Up to ``BLOCK`` rows, column by column."""

    n: int
    key: np.ndarray | None  # None where nothing is drawn by it
    y: np.ndarray
    fold: np.ndarray
    columns: np.ndarray  # features x rows
    margins: np.ndarray  # fits x rows


@dataclass
class Blocks:
    """The rows of a training: a cached RDD of ``Block``."""

    rdd: RDD
    partitions: int
    spark: SparkSession

    def count(self) -> int:
        return self.rdd.count()

    def unpersist(self) -> None:
        self.rdd.unpersist()


def narrowest(values: np.ndarray, dtype) -> np.ndarray:
    """The values as ``dtype`` if it holds all of them, else as they are."""
    with np.errstate(invalid="ignore"):
        small = values.astype(dtype)
    return small if np.array_equal(small, values) else values


def advanced(rows: Blocks, pending: list[list], cut: bool = False) -> Blocks:
    """Rows with the pending trees of every fit added to their margins, cached; with ``cut`` their lineage ends here once a job
    has read them."""

    def run(blocks: Iterator[Block]) -> Iterator[Block]:
        for block in blocks:
            margins = block.margins.copy()
            for f, trees in enumerate(pending):
                for t in trees:
                    margins[f] += t.values(block.columns, block.n)
            yield replace(block, margins=margins)

    moved = rows.rdd.mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    if cut:
        ensure_checkpoint_dir(rows.spark)
        moved.checkpoint()
    return replace(rows, rdd=moved)


def fit_rows(rows: Blocks, width: int, n_fits: int) -> DataFrame:
    """(key, label, fold, margins) of every row, margins as packed doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.column("block"):
                b = pickle.loads(one.as_buffer())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.key), pa.array(b.y.astype(np.float64)), pa.array(b.fold.astype(np.int32)), packed_rows(b.margins.T)],
                    names=["key", "label", "fold", "margins"])

    whole = rows.spark.createDataFrame(rows.rdd.map(lambda b: (pickle.dumps(b),)), "block binary", verifySchema=False)
    return whole.mapInArrow(run, "key bigint, label double, fold int, margins binary")


# ---- what the driver decides ----------------------------------------------------------------------------------------
def score(g, h, l2: float):
    return g * g / (h + l2)


def left_sums(hist: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For every column and border the sums over the bins left of it (the last bin's entry is the whole column)."""
    out, start = np.empty_like(hist), 0
    for size in sizes:
        out[..., start : start + size] = np.cumsum(hist[..., start : start + size], -1)
        start += size
    return out


def allowed_borders(borders: Borders, columns: Sequence[int], count: int) -> np.ndarray:
    """Which bins of the fit's columns end at a border that the border count keeps; a column's last bin ends at none."""
    parts = []
    for c in columns:
        ok = np.zeros(len(borders.fine[c]) + 1, bool)
        ok[borders.coarse[count][c] if count in borders.coarse else slice(0, -1)] = True
        ok[-1] = False
        parts.append(ok)
    return np.concatenate(parts) if parts else np.zeros(0, bool)


class _Node:
    __slots__ = ("sums", "hist", "gain", "at", "left", "right")

    def __init__(self, sums: np.ndarray):
        self.sums, self.hist, self.gain, self.at, self.left, self.right = sums, None, -math.inf, -1, None, None


class LeafGrower:
    """Best-first growth of one tree; ``wants`` names nodes to count, ``take`` receives their sums."""

    def __init__(self, setting: Setting, sizes: np.ndarray, allowed: np.ndarray):
        self.s, self.sizes, self.allowed = setting, sizes, allowed
        self.ends = np.cumsum(sizes)
        self.nodes: list[_Node] = []
        self.asked: list[tuple[int, int | None, int | None]] = [(0, None, None)]  # node, sibling, parent
        self.tree: Tree | None = None

    def wants(self) -> list[int]:
        return [n for n, _, _ in self.asked]

    def known(self) -> int:
        return max(1, len(self.nodes))

    def partial(self) -> Tree | None:
        if not self.nodes:
            return None
        return self._tree(lambda n: n.left is not None, with_values=False)

    def take(self, hists: np.ndarray) -> bool:
        """Sums of the asked nodes ([3, nodes, bins]); True when the tree is done."""
        for k, (n, sibling, parent) in enumerate(self.asked):
            hist = hists[:, k]
            if parent is None:
                self.nodes.append(_Node(hist[:, : self.sizes[0]].sum(1)))
            self._measure(self.nodes[n], hist)
            if sibling is not None:
                self._measure(self.nodes[sibling], self.nodes[parent].hist - hist)
        for _, _, parent in self.asked:
            if parent is not None:
                self.nodes[parent].hist = None
        self.asked = []
        splits, used = self._best_first()
        for n in splits:
            self._expand(n)
        if self.asked:
            return False
        # the others' children only hold rows that may not be split again
        if splits:
            return self.take(np.zeros((3, 0, len(self.allowed)), np.int64))
        self.tree = self._tree(lambda n: n in used, with_values=True)
        return True

    def _measure(self, node: _Node, hist: np.ndarray) -> None:
        node.hist = hist
        left = left_sums(hist, self.sizes)
        total = node.sums[:, None]
        right = total - left
        g, h = left[:2] / UNIT
        gr, hr = right[:2] / UNIT
        s = self.s
        ok = self.allowed & (hist[2] > 0) & (left[2] >= s.min_rows) & (right[2] >= s.min_rows) & (h >= s.min_hessian) & (hr >= s.min_hessian)
        whole = node.sums[:2] / UNIT
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, score(g, h, s.l2) + score(gr, hr, s.l2) - score(whole[0], whole[1], s.l2), -math.inf)
        if len(gain):
            node.at = int(gain.argmax())
            node.gain = float(gain[node.at])

    def _best_first(self) -> tuple[list[int], set]:
        """(nodes whose children must be known first, the nodes split as far as known)"""
        heap = [(-self.nodes[0].gain, 0)]
        unknown, used = [], set()
        for left in range(self.s.num_leaves - 1, 0, -1):
            if not heap or heap[0][0] >= 0:
                break
            _, n = heapq.heappop(heap)
            node = self.nodes[n]
            used.add(node)
            if node.left is None:
                if left > 1:  # the last split's children are never split
                    unknown.append(n)
                continue
            for child in (node.left, node.right):
                heapq.heappush(heap, (-self.nodes[child].gain, child))
        return unknown, used

    def _sides(self, node: _Node) -> np.ndarray:
        c = int(np.searchsorted(self.ends, node.at, side="right"))
        start = self.ends[c] - self.sizes[c]
        return node.hist[:, start : node.at + 1].sum(1)

    def _expand(self, n: int) -> None:
        node = self.nodes[n]
        left = self._sides(node)
        node.left, node.right = len(self.nodes), len(self.nodes) + 1
        self.nodes += [_Node(left), _Node(node.sums - left)]
        if max(self.nodes[node.left].sums[2], self.nodes[node.right].sums[2]) >= 2 * self.s.min_rows:
            small, large = (node.left, node.right) if left[2] <= node.sums[2] - left[2] else (node.right, node.left)
            self.asked.append((small, large, n))

    def _tree(self, split, with_values: bool) -> Tree:
        """The tree of the nodes that ``split`` accepts, numbered from the root downwards."""
        order, place = [0], {0: 0}
        for n in order:
            node = self.nodes[n]
            if split(node):
                if node.left is None:  # a last split: its children are known by their sums alone
                    left = self._sides(node)
                    node.left, node.right = len(self.nodes), len(self.nodes) + 1
                    self.nodes += [_Node(left), _Node(node.sums - left)]
                for child in (node.left, node.right):
                    place[child] = len(order)
                    order.append(child)
        if not with_values:  # the tree in progress keeps its nodes' own numbers
            order, place = list(range(len(self.nodes))), {n: n for n in range(len(self.nodes))}
        k = len(order)
        column, at, left, right = (np.full(k, -1, np.int64) for _ in range(4))
        value, rows, gain = np.zeros(k), np.zeros(k, np.int64), np.zeros(k)
        for i, n in enumerate(order):
            node = self.nodes[n]
            rows[i] = node.sums[2]
            if split(node):
                c = int(np.searchsorted(self.ends, node.at, side="right"))
                column[i], at[i] = c, node.at - (self.ends[c] - self.sizes[c])
                left[i], right[i], gain[i] = place[node.left], place[node.right], node.gain
            else:
                g, h = node.sums[:2] / UNIT
                value[i] = -g / (h + self.s.l2) * self.s.rate if h + self.s.l2 > 0 else 0.0
        return Tree(column, at, left, right, value, rows, gain)


def unit_draw(*parts) -> float:
    """A uniform draw from the MD5 of the parts, in (0, 1)."""
    return (int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) + 0.5) / float(1 << 52)


class LevelGrower:
    """Level by level growth of one symmetric tree, with the interface of ``LeafGrower``."""

    def __init__(self, setting: Setting, sizes: np.ndarray, allowed: np.ndarray, number: int):
        self.s, self.sizes, self.allowed, self.number = setting, sizes, allowed, number
        self.ends = np.cumsum(sizes)
        self.column, self.bin, self.gain = [], [], []
        self.hist = self.left = None  # of the level's nodes
        self.tree: SymmetricTree | None = None

    def wants(self) -> list[int]:
        """The right children of the level (the left ones are parent minus right); at first the root."""
        return [0] if self.hist is None else list(range(1, 2 * self.hist.shape[1], 2))

    def known(self) -> int:
        return 1 if self.hist is None else 2 * self.hist.shape[1]

    def partial(self) -> SymmetricTree | None:
        if self.hist is None:
            return None
        return SymmetricTree(np.array(self.column), np.array(self.bin), np.zeros(0), np.zeros(0), np.zeros(0))

    def take(self, hists: np.ndarray) -> bool:
        if self.hist is None:
            self.hist = hists
        else:
            both = np.empty((3, 2 * hists.shape[1], hists.shape[2]), np.int64)
            both[:, 1::2], both[:, ::2] = hists, self.hist - hists
            self.hist = both
        sums = self.hist[:, :, : self.sizes[0]].sum(2)
        if len(self.column) < self.s.depth and self._split(sums):
            if len(self.column) < self.s.depth:
                return False
            # the last level's children: sums on both sides of the split, no scan
            c = self.column[-1]
            start = self.ends[c] - self.sizes[c]
            left = self.hist[:, :, start : start + self.bin[-1] + 1].sum(2)
            sums = np.stack([left, sums - left], 2).reshape(3, -1)
        g, h = sums[:2] / UNIT
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where(h + self.s.l2 > 0, -g / (h + self.s.l2) * self.s.rate, 0.0)
        self.tree = SymmetricTree(np.array(self.column, np.int64), np.array(self.bin, np.int64), value, sums[2], np.array(self.gain))
        return True

    def _split(self, sums: np.ndarray) -> bool:
        left = left_sums(self.hist, self.sizes)
        right = sums[:, :, None] - left
        with np.errstate(divide="ignore", invalid="ignore"):
            sides = [np.where(s[1] + self.s.l2 * UNIT > 0, score(s[0] / UNIT, s[1] / UNIT, self.s.l2), 0.0) for s in (left, right)]
            whole = np.where(sums[1] + self.s.l2 * UNIT > 0, score(sums[0] / UNIT, sums[1] / UNIT, self.s.l2), 0.0).sum()
        total = (sides[0] + sides[1]).sum(0)
        ok = self.allowed & self._columns() & (self.hist[2].sum(0) > 0) & (right[2].sum(0) > 0)
        noise = self._noise(sums, len(total))
        rank = np.where(ok, total if noise is None else np.sqrt(total) + noise, -math.inf)
        if not ok.any() or (self.s.random_strength == 0 and total[ok].max() <= whole + LEAST_GAIN):
            return False
        at = int(rank.argmax())
        c = int(np.searchsorted(self.ends, at, side="right"))
        self.column.append(c)
        self.bin.append(at - int(self.ends[c] - self.sizes[c]))
        self.gain.append(float(total[at] - whole))
        return True

    def _columns(self) -> np.ndarray:
        """The bins of the columns that this level may use."""
        d = len(self.sizes)
        keep = max(1, math.ceil(self.s.colsample * d - 1e-9))
        if keep >= d:
            return np.ones(int(self.sizes.sum()), bool)
        draws = [unit_draw("columns", self.s.seed, self.number, len(self.column), j) for j in range(d)]
        chosen = set(np.argsort(draws, kind="stable")[:keep].tolist())
        return np.repeat([j in chosen for j in range(d)], self.sizes)

    def _noise(self, sums: np.ndarray, n: int) -> np.ndarray | None:
        if self.s.random_strength <= 0:
            return None
        rows = max(1, int(sums[2].sum()))
        if self.hist.shape[1] == 1 and not self.column:  # the tree's first level sets its scale
            # hessians p (1 - p) bound squared gradients in expectation: E (p - y)^2 = p (1 - p)
            self.scale = math.sqrt(max(0.0, float(sums[1].sum()) / UNIT / rows))
        fade = max(1.0 / rows, math.exp(-self.number * self.s.rate))
        seed = int(hashlib.md5(f"noise:{self.s.seed}:{self.number}:{len(self.column)}".encode()).hexdigest()[:16], 16)
        return np.random.default_rng(seed).standard_normal(n) * (self.s.random_strength * self.scale * fade)


def auc_of(cells: np.ndarray) -> float:
    """Area under the ROC curve from counts [cell x label]; pairs in one cell count half."""
    neg, pos = cells.reshape(-1, 2).astype(np.float64).T
    if not pos.sum() or not neg.sum():
        return math.nan
    return float((pos * (np.cumsum(neg) - neg + neg / 2.0)).sum() / (pos.sum() * neg.sum()))


def prepare_rows(matrix: DataFrame, width: int, n_fits: int, keyed: bool = True) -> tuple[Blocks, int, dict]:
    """The cached blocks of a training, their partitions, and the rows per (fold, label). Margins start at 0; a fit's base
    is added when they are read. Keys are kept if ``keyed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block(parts) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            key, y, fold = (table.column(c).to_numpy().astype(t, copy=False) for c, t in (("key", np.int64), ("label", np.float64), ("fold", np.int32)))
            bins = np.concatenate([unpacked_rows(b.column("bins"), np.uint8, width) for b in parts])
            one = Block(len(y), key if keyed else None, narrowest(y, np.uint8), narrowest(fold, np.int8), np.ascontiguousarray(bins.T),
                        np.zeros((n_fits, len(y))))
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(one)], pa.binary())], names=["block"])

        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, BLOCK - n)
                held.append(part)
                start, n = start + part.num_rows, n + part.num_rows
                if n == BLOCK:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    def tally(blocks: Iterator[Block]) -> Iterator[tuple[tuple[int, float], int]]:
        for b in blocks:
            for fold in np.unique(b.fold):
                for label, n in zip(*np.unique(b.y[b.fold == fold], return_counts=True)):
                    yield (int(fold), float(label)), int(n)

    kept = cut_lineage(matrix.select("key", "label", "fold", "bins").mapInArrow(run, "block binary"))
    spark, counts = kept.sparkSession, {}
    of_rows = kept.rdd.map(lambda r: pickle.loads(r[0]))
    for (fold, label), n in of_rows.mapPartitions(tally).reduceByKey(operator.add, 1).collect():
        at = fold, label if label == label else math.nan
        counts[at] = counts.get(at, 0) + n
    n = sum(counts.values())
    cores = default_parallelism(spark)
    size = n * (width + 8 * n_fits + (10 if keyed else 2))
    few = max(min(cores, -(-n * n_fits // LEAST_ROWS)), -(-n // TASK_ROWS), -(-size // TASK_BYTES), 1)
    if few > cores:  # as many tasks for every core
        few = -(-few // cores) * cores
    if kept.rdd.getNumPartitions() != few:  # blocks are moved, not rows
        of_rows = kept.repartition(few).rdd.map(lambda r: pickle.loads(r[0]))
    return Blocks(of_rows.persist(StorageLevel.MEMORY_AND_DISK_DESER), few, spark), few, counts


def train(matrix: DataFrame, borders: Borders, fits: Sequence[Fit]) -> list[Boosted]:
    """Fit all ``fits`` on the rows of ``matrix`` (key bigint, label double 0/1, fold int, bins binary), in common scans."""
    return train_rows(matrix, borders, fits)[0]


def train_rows(matrix: DataFrame, borders: Borders, fits: Sequence[Fit], margins: bool = False) -> tuple[list[Boosted], DataFrame | None]:
    """``train``; with ``margins`` also the rows with every fit's margin after its last tree (without ``patience``)."""
    width = len(borders.names)
    drawn = any(f.setting.growth == "level" and f.setting.bagging_temperature > 0 for f in fits)
    rows, _, counts = prepare_rows(matrix, width, len(fits), drawn or margins)
    old, moves = None, 0
    unknown = {label for _, label in counts} - {0.0, 1.0}
    if unknown:
        raise ValueError(f"labels must be 0 or 1, found {sorted(unknown, key=str)}")
    bases = []
    for fit in fits:
        n = [sum(c for (fold, label), c in counts.items() if fold not in (NO_FOLD, fit.left_out) and label == v) for v in (0.0, 1.0)]
        bases.append(math.log((n[1] + 0.5) / (n[0] + 0.5)) if not n[0] or not n[1] else math.log(n[1] / n[0]))
    models = [Boosted(b, []) for b in bases]
    pending: list[list] = [[] for _ in fits]
    sizes = [borders.sizes[f.columns] for f in fits]
    allowed = [allowed_borders(borders, f.columns, f.setting.borders) for f in fits]
    growers: dict[int, LeafGrower | LevelGrower] = {}

    def begin(f: int) -> None:
        s = fits[f].setting
        number = len(models[f].trees)
        growers[f] = LeafGrower(s, sizes[f], allowed[f]) if s.growth == "leaf" else LevelGrower(s, sizes[f], allowed[f], number)

    for f, fit in enumerate(fits):
        if fit.setting.trees or fit.patience is not None:
            begin(f)
    while growers:  # every fit goes on at its own pace: a scan serves whatever each of them needs next
        asks = {}
        for f, g in growers.items():
            wants = g.wants()
            place = np.full(g.known(), -1, np.int64)
            place[wants] = np.arange(len(wants))
            asks[f] = Ask(fits[f], bases[f], sizes[f], len(models[f].trees), pending[f], _on_matrix(g.partial(), fits[f].columns), place,
                          len(wants), g.partial() is None and fits[f].patience is not None)
        totals, cells = {}, {}
        for lot in lots(asks):
            a, b = scan(rows, lot)
            totals.update(a)
            cells.update(b)
        if old is not None:  # the scan has read, and so written, the rows that replace these
            old.unpersist()
            old = None
        for f, c in cells.items():
            models[f].auc.append(auc_of(c))
            best = int(np.nanargmax(models[f].auc)) if not np.isnan(models[f].auc).all() else 0
            grown = len(models[f].trees)
            if grown - best >= fits[f].patience or grown >= fits[f].setting.trees:
                models[f].trees = models[f].trees[:best]
                growers.pop(f)
        for f in list(growers):
            if not growers[f].take(totals[f]):
                continue
            tree = _on_matrix(growers.pop(f).tree, fits[f].columns)
            models[f].trees.append(tree)
            pending[f].append(tree)
            if len(models[f].trees) < fits[f].setting.trees or fits[f].patience is not None:
                begin(f)
        if growers and due(pending):
            old, moves = rows, moves + 1
            rows = advanced(rows, pending, moves % CUT_MOVES == 0)
            pending = [[] for _ in fits]
    if old is not None:
        old.unpersist()
    last = None
    if margins:
        moved = advanced(rows, [[*p, *_constant(b)] for p, b in zip(pending, bases)])
        last = cut_lineage(fit_rows(moved, width, len(fits)))
        moved.unpersist()
    rows.unpersist()
    return models, last


def due(pending: list[list]) -> bool:
    """Whether margins are written anew: leaf-wise trees cost more to walk through in every scan than to write once."""
    leafwise = sum(isinstance(t, Tree) for trees in pending for t in trees)
    return max(map(len, pending)) >= CUT_TREES or leafwise >= CUT_LEAFWISE * len(pending)


def _constant(value: float) -> list[Tree]:
    """A tree of one leaf."""
    return [Tree(*[np.array([-1])] * 4, np.array([value]), np.array([0]), np.array([0.0]))]


def own_columns(model: Boosted, borders: Borders, columns: Sequence[int]) -> tuple[Boosted, Borders]:
    """The model and the borders with a fit's own column numbers in place of the matrix's."""
    place = np.full(len(borders.names), -1, np.int64)
    place[list(columns)] = np.arange(len(columns))
    trees = [type(t)(**{**t.__dict__, "column": np.where(t.column >= 0, place[t.column], -1)}) for t in model.trees]
    own = Borders([borders.names[c] for c in columns], [borders.fine[c] for c in columns],
                  {k: [v[c] for c in columns] for k, v in borders.coarse.items()})
    return Boosted(model.base, trees, model.auc), own


def lots(asks: dict[int, Ask]) -> Iterator[dict[int, Ask]]:
    """The asks in as few scans as keep a task's sums within ``SCAN_BYTES``."""
    lot, size = {}, 0
    for f, a in asks.items():
        own = 24 * a.places * a.cells()
        if lot and size + own > SCAN_BYTES:
            yield lot
            lot, size = {}, 0
        lot[f], size = a, size + own
    if lot:
        yield lot


def _on_matrix(tree, columns: Sequence[int]):
    """The tree with the matrix's column numbers in place of the fit's own."""
    if tree is None:
        return None
    own = np.asarray(columns, np.int64)
    column = np.where(tree.column >= 0, own[np.maximum(tree.column, 0)], -1) if len(tree.column) else tree.column
    return type(tree)(**{**tree.__dict__, "column": column})


# ---- tables of a model ----------------------------------------------------------------------------------------------
def node_rows(model: Boosted, borders: Borders) -> list[tuple]:
    """(tree, node, feature, border, left, right, value, n_rows, gain): inner nodes have a split and the mean value of the
    rows below them, leaves a NULL split. Symmetric trees are written out as ordinary ones."""
    out = []
    for t, tree in enumerate(model.trees):
        if isinstance(tree, SymmetricTree):
            tree = _unfolded(tree)
        value = tree.value.copy()
        for i in range(len(value) - 1, -1, -1):  # children come after their parents
            if tree.left[i] >= 0:
                a, b = tree.left[i], tree.right[i]
                n = tree.rows[a] + tree.rows[b]
                value[i] = (value[a] * tree.rows[a] + value[b] * tree.rows[b]) / n if n else 0.0
        for i in range(len(value)):
            inner = tree.left[i] >= 0
            c = int(tree.column[i])
            out.append((t, i, borders.names[c] if inner else None, float(borders.fine[c][tree.bin[i]]) if inner else None,
                        int(tree.left[i]) if inner else None, int(tree.right[i]) if inner else None, float(value[i]),
                        int(tree.rows[i]), float(tree.gain[i]) if inner else None))
    return out


def _unfolded(tree: SymmetricTree) -> Tree:
    depth = len(tree.column)
    inner = 2**depth - 1
    n = 2 * inner + 1
    level = np.floor(np.log2(np.arange(n) + 1)).astype(np.int64)
    column = np.array([tree.column[k] if k < depth else -1 for k in level], np.int64)
    at = np.array([tree.bin[k] if k < depth else -1 for k in level], np.int64)
    left = np.where(np.arange(n) < inner, 2 * np.arange(n) + 1, -1)
    right = np.where(np.arange(n) < inner, 2 * np.arange(n) + 2, -1)
    value, rows, gain = np.zeros(n), np.zeros(n, np.int64), np.zeros(n)
    value[inner:], rows[inner:] = tree.value, tree.rows
    for i in range(inner - 1, -1, -1):
        rows[i] = rows[left[i]] + rows[right[i]]
        gain[i] = tree.gain[level[i]]
    return Tree(column, at, left, right, value, rows, gain)


NODE_SCHEMA = ("tree int, node int, feature string, border double, left int, right int, value double, n_rows bigint, "
               "gain double")


def value_change(nodes: DataFrame) -> DataFrame:
    """M7: (feature, importance). Every split counts the change of value that it makes: the rows on both sides times the
    squared distance of their values from the rows' mean; sums per feature, in per cent of all."""
    side = nodes.select("tree", F.col("node").alias("_n"), F.col("value").alias("v"), F.col("n_rows").alias("n"))
    left, right = (side.select("tree", F.col("_n").alias(k), F.col("v").alias(f"{k}_v"), F.col("n").alias(f"{k}_n")) for k in ("left", "right"))
    splits = nodes.where(F.col("feature").isNotNull()).select("tree", "feature", "left", "right")
    both = splits.join(left, ["tree", "left"]).join(right, ["tree", "right"])
    a, b = F.col("left_n").cast("double"), F.col("right_n").cast("double")
    d = F.col("left_v") - F.col("right_v")
    change = F.when(a + b > 0, d * d * a * b / (a + b)).otherwise(F.lit(0.0))
    per = both.groupBy("feature").agg(F.sum(change).alias("change"))
    total = F.sum("change").over(Window.partitionBy(F.lit(0)))  # a row per feature
    return per.select("feature", F.when(total > 0, F.lit(100.0) * F.col("change") / total).otherwise(F.lit(0.0)).alias("importance"))
