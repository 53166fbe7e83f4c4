"""Feature binning (F10): borders from one mergeable quantile sketch per column, rows as packed bytes.

``sketches`` reads the table once and keeps one KLL sketch per numeric column (``kll_sketch_agg_double``): sketches of
partitions merge, their size does not grow with the rows, and the rank of what they return is off by about 1.4e-5 at the
default ``k`` (exact up to ``k`` values). ``Borders`` holds at most 254 borders per column, the quantiles j / 255; fewer
borders (32, 64, 128) are taken from these by rank, so one sketch and one binned matrix serve every border count: a learner
with fewer borders only looks at fewer of them.

``binned`` writes a row's features as one byte each: the number of borders below the value. A value lies right of border b
if it is greater; NULL and NaN lie left of all. The matrix is written once and shared by all learners, folds and trials.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.columns import nan_to_null

SKETCH_K = 65535  # the largest size; about a megabyte a column
SKETCH_BYTES = 256 << 20  # of all sketches that a task holds
TOGETHER = 16  # values that are sketched in one pass
MAX_BORDERS = 254
BORDER_COUNTS = (32, 64, 128, 254)


def sketches(df: DataFrame, values: dict[str, Column], k: int = SKETCH_K) -> DataFrame:
    """One row with a quantile sketch per named value; NULL and NaN are left out. ``TOGETHER`` values take a pass over the rows:
    the code that computes many more is too long to be compiled, and they are projected first, as an aggregate would interpret
    their expressions. The partitions' sketches are merged in a task per column."""
    names, parts = list(values), []
    for start in range(0, len(names), TOGETHER):
        own = range(start, min(start + TOGETHER, len(names)))
        flat = df.select(F.spark_partition_id().alias("part"), *[nan_to_null(values[names[i]].cast("double")).alias(f"v{i}") for i in own])
        part = flat.groupBy("part").agg(*[F.kll_sketch_agg_double(f"v{i}", F.lit(k)).alias(f"v{i}") for i in own])
        parts.append(part.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("s")) for i in own])).alias("v")))
    per = reduce(DataFrame.unionAll, parts).select("v.i", "v.s").groupBy("i").agg(F.kll_merge_agg_double("s", F.lit(k)).alias("s"))
    return per.agg(*[F.first(F.when(F.col("i") == i, F.col("s")), ignorenulls=True).alias(n) for i, n in enumerate(names)])


def fine_rank(number: int, count: int) -> int:
    """Which of the 254 fine borders is border ``number`` (from 1) of ``count``: the first at or above its rank."""
    return -(-number * (MAX_BORDERS + 1) // (count + 1))


def quantiles(sketched: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, place, value): the 255-quantiles of every sketched column, places 1 to 255 (the last is the maximum). A
    column without values has none."""
    ranks = F.array(*[F.lit(j / (MAX_BORDERS + 1)) for j in range(1, MAX_BORDERS + 2)])
    one = sketched.select(F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("k")) for n in names])).alias("s"))
    q = F.when(F.kll_sketch_get_n_double("s.k") > 0, F.kll_sketch_get_quantile_double("s.k", ranks))  # the ranks stand once in the plan
    one = one.select("s.feature", q.alias("q"))
    return one.select("feature", F.posexplode("q").alias("at", "value")).select(
        "feature", (F.col("at") + 1).alias("place"), "value")


def border_table(quantile_rows: DataFrame, counts: Sequence[int] = BORDER_COUNTS) -> DataFrame:
    """(feature, border_count, border_no, border): distinct quantiles below the column's maximum, numbered from 0."""
    wanted = [F.struct(F.lit(c).alias("c"), F.lit(fine_rank(j, c)).alias("p")) for c in counts for j in range(1, c + 1)]
    tops = quantile_rows.where(F.col("place") == MAX_BORDERS + 1).select("feature", F.col("value").alias("top"))
    picks = F.broadcast(quantile_rows.sparkSession.range(1).select(F.explode(F.array(*wanted)).alias("w")).select("w.c", "w.p"))
    rows = quantile_rows.join(picks, F.col("place") == F.col("p")).join(F.broadcast(tops), "feature")
    rows = rows.where(F.col("value") < F.col("top")).groupBy("feature", F.col("c").alias("border_count")).agg(
        F.sort_array(F.collect_set("value")).alias("b"))  # at most 254 values
    return rows.select("feature", "border_count", F.posexplode("b").alias("border_no", "border"))


@dataclass
class Borders:
    """Borders of every column of a matrix, and which of them a smaller border count keeps."""

    names: list[str]
    fine: list[np.ndarray]  # ascending
    coarse: dict[int, list[np.ndarray]]  # border count -> per column, the kept borders' places among the fine ones

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(b) + 1 for b in self.fine], np.int64)


def sketch_size(columns: int) -> int:
    """The largest sketch of which a task can hold one per column within ``SKETCH_BYTES``, about 16 bytes an item."""
    return max(2048, min(SKETCH_K, SKETCH_BYTES // (16 * max(1, columns))))


def learn_borders(df: DataFrame, values: dict[str, Column], k: int | None = None) -> Borders:
    names = list(values)
    k = k or sketch_size(len(names))
    rows = border_table(quantiles(sketches(df, values, k), names)).collect()  # columns x 478 borders at most
    by: dict[tuple[str, int], list[tuple[int, float]]] = {}
    for r in rows:
        by.setdefault((r["feature"], r["border_count"]), []).append((r["border_no"], r["border"]))
    sorted_ = {key: np.array([v for _, v in sorted(vs)]) for key, vs in by.items()}
    none = np.zeros(0)
    fine = [sorted_.get((n, MAX_BORDERS), none) for n in names]
    coarse = {c: [np.searchsorted(f, sorted_.get((n, c), none)) for n, f in zip(names, fine)] for c in BORDER_COUNTS}
    return Borders(names, fine, coarse)


def bin_matrix(values: np.ndarray, borders: Sequence[np.ndarray]) -> np.ndarray:
    """Bins (uint8) of a matrix of values, column by column."""
    out = np.empty(values.shape, np.uint8)
    for j, b in enumerate(borders):
        out[:, j] = np.searchsorted(b, np.where(np.isnan(values[:, j]), -np.inf, values[:, j]), side="left")
    return out


def array_rows(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column of doubles as a matrix; NULLs become NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(np.float64, copy=False)


def packed_rows(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    data = np.ascontiguousarray(matrix)
    width = data.shape[1] * data.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(data), [None, pa.py_buffer((np.arange(len(data) + 1) * width).astype(np.int32)), pa.py_buffer(data)])


def unpacked_rows(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Binary values of equal width as the rows of a matrix."""
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype) if data is not None and data.size else np.zeros(0, dtype)
    return flat[column.offset * width : (column.offset + len(column)) * width].reshape(len(column), width)


def binned(df: DataFrame, values: dict[str, Column], borders: Borders, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns plus ``bins``, one byte per value in the order of ``borders.names``."""
    row = F.array(*[values[n].cast("double") for n in borders.names])
    narrow = df.select(*keep, row.alias("_values"))
    fine, width = borders.fine, len(borders.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = bin_matrix(array_rows(batch.column("_values"), width), fine)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], packed_rows(bins)], names=[*keep, "bins"])

    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.drop("_values").schema.fields] + ["bins binary"])
    return narrow.mapInArrow(run, ddl)


def bin_counts(matrix: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, bin, n_rows) of a binned matrix: tasks count in arrays, what is shuffled are columns x bins numbers."""
    width = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, 256), np.int64)
        for batch in batches:
            bins = unpacked_rows(batch.column("bins"), np.uint8, width)
            for j in range(width):
                total[j] += np.bincount(bins[:, j], minlength=256)
        at, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[j] for j in at], pa.string()), pa.array(b.astype(np.int32)), pa.array(total[at, b])], names=["feature", "bin", "n"])

    part = matrix.select("bins").mapInArrow(run, "feature string, bin int, n bigint")
    return part.groupBy("feature", "bin").agg(F.sum("n").alias("n_rows"))
