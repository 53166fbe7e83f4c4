"""Exact median per column without gathering a column into one task.

``F.median`` keeps a map of every distinct value of a group in the final aggregation task; for a global median
that is the whole column. Here:

* small columns (at most ``rows_per_bucket`` present values): values are stacked to (column, value), collapsed to
  distinct values with counts and ranked with the bucketed prefix sum;
* large columns: a two-pass selection. ``approxQuantile`` (Greenwald-Khanna sketch, bounded memory, rank error
  <= eps * n) brackets the middle ranks with [lo, hi]; one pass counts, per column, the rows below ``lo`` and keeps
  only the rows inside [lo, hi] (about 6 * eps * n of them); those few are ranked exactly as above (equal-width
  buckets over [lo, hi] are monotone in the value). If a bracket ever misses the middle ranks the column falls back
  to the full ranking, so the answer is always exact.

Only the one or two rows holding the middle ranks reach the driver. Interpolation matches the SQL median: the mean
of the two middle values when the count is even.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.columns import nan_to_null
from kestrel.operators.prefix import DEFAULT_ROWS_PER_BUCKET, exclusive_prefix


def _stack(df: DataFrame, cols: Sequence[str], bucket: dict[str, Column] | None = None) -> DataFrame:
    structs = [
        F.struct(F.lit(c).alias("col"), (bucket[c] if bucket else F.lit(0)).cast("long").alias("bucket"),
                 F.col(c).alias("v"))
        for c in cols
    ]
    return df.select(F.explode(F.array(*structs)).alias("s")).select("s.*").where(F.col("v").isNotNull())


def _pick(stacked: DataFrame, targets: dict[str, tuple[int, int]], n_buckets: int) -> dict[str, tuple]:
    """Values at the (lo, hi) 0-based ranks of each column among the stacked rows."""
    distinct = stacked.groupBy("col", "bucket", "v").agg(F.count("*").alias("cnt"))
    ranked = exclusive_prefix(distinct, ["col"], "bucket", ["v"], {"before": F.col("cnt")},
                              offset_rows_bound=len(targets) * (n_buckets + 1))
    lo_map = F.create_map(*[x for c, (lo, _) in targets.items() for x in (F.lit(c), F.lit(lo))])
    hi_map = F.create_map(*[x for c, (_, hi) in targets.items() for x in (F.lit(c), F.lit(hi))])

    def covers(r):
        return (F.col("before") <= r) & (r < F.col("before") + F.col("cnt"))

    lo, hi = lo_map[F.col("col")], hi_map[F.col("col")]
    picked = ranked.where(covers(lo) | covers(hi)).select("col", "v", covers(lo).alias("is_lo"),
                                                          covers(hi).alias("is_hi"))
    out: dict[str, list] = {c: [None, None] for c in targets}
    for r in picked.collect():  # at most two rows per column
        if r["is_lo"]:
            out[r["col"]][0] = r["v"]
        if r["is_hi"]:
            out[r["col"]][1] = r["v"]
    return {c: tuple(v) for c, v in out.items()}


def _median(a: float, b: float) -> float:
    return a if a == b else 0.5 * a + 0.5 * b


def exact_medians(
    df: DataFrame, cols: Sequence[str], rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, eps: float = 1e-4
) -> dict[str, float | None]:
    cols = list(cols)
    if not cols:
        return {}
    clean = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    counts_row = clean.agg(*[F.count(c).alias(c) for c in cols]).first()
    counts = {c: int(counts_row[c]) for c in cols}
    out: dict[str, float | None] = {c: None for c in cols}
    present = [c for c in cols if counts[c] > 0]
    targets = {c: ((counts[c] - 1) // 2, counts[c] // 2) for c in present}
    small = [c for c in present if counts[c] <= rows_per_bucket]
    large = [c for c in present if counts[c] > rows_per_bucket]

    if small:
        got = _pick(_stack(clean, small), {c: targets[c] for c in small}, 1)
        out.update({c: _median(*got[c]) for c in small})
    if not large:
        return out

    eps = max(eps, 1.0 / (4 * rows_per_bucket))
    band = 3 * eps
    brackets = clean.approxQuantile(large, [max(0.0, 0.5 - band), min(1.0, 0.5 + band)], eps)
    lo = {c: b[0] for c, b in zip(large, brackets)}
    hi = {c: b[1] for c, b in zip(large, brackets)}
    below_row = clean.agg(*[F.count(F.when(F.col(c) < F.lit(lo[c]), 1)).alias(c) for c in large]).first()
    below = {c: int(below_row[c]) for c in large}
    inner = clean.select(*[F.when((F.col(c) >= F.lit(lo[c])) & (F.col(c) <= F.lit(hi[c])), F.col(c)).alias(c)
                           for c in large])
    n_inner_max = max(1, int(2 * band * max(counts[c] for c in large)) + 1)
    n_buckets = max(1, math.ceil(n_inner_max / rows_per_bucket))
    width = {c: (hi[c] - lo[c]) or 1.0 for c in large}
    bucket = {c: F.least(F.floor((F.col(c) - F.lit(lo[c])) / F.lit(width[c]) * F.lit(n_buckets)),
                         F.lit(n_buckets - 1)) for c in large}
    shifted = {c: (targets[c][0] - below[c], targets[c][1] - below[c]) for c in large}
    got = _pick(_stack(inner, large, bucket), shifted, n_buckets)
    missed = []
    for c in large:
        a, b = got[c]
        if a is None or b is None:
            missed.append(c)
        else:
            out[c] = _median(a, b)
    if missed:  # the sketch's bracket did not hold the middle ranks: rank the whole column exactly
        got = _pick(_full_bucketed(clean, missed, counts, rows_per_bucket), {c: targets[c] for c in missed},
                    max(1, math.ceil(max(counts[c] for c in missed) / rows_per_bucket)))
        out.update({c: _median(*got[c]) for c in missed})
    return out


def _full_bucketed(clean: DataFrame, cols: list[str], counts: dict, rows_per_bucket: int) -> DataFrame:
    from pyspark.ml.feature import Bucketizer

    n_buckets = max(1, math.ceil(max(counts[c] for c in cols) / rows_per_bucket))
    if n_buckets == 1:
        return _stack(clean, cols)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = clean.approxQuantile(cols, probs, 1.0 / (4 * n_buckets))
    splits = [[-math.inf, *sorted(set(b)), math.inf] for b in bounds]
    outs = [f"__b{i}" for i in range(len(cols))]
    b = Bucketizer(splitsArray=splits, inputCols=cols, outputCols=outs, handleInvalid="keep").transform(clean)
    return _stack(b, cols, {c: F.col(o) for c, o in zip(cols, outs)})
