"""Bucketed prefix sums: exact running totals and ranks without a one-task window.

A window ``PARTITION BY label ORDER BY key`` puts a whole class (or, unpartitioned, the whole table) into one task.
Here the order key is first cut into buckets that are monotone in the key (leading md5 hex digits, or quantile
boundaries of a score). Then:

1. bucket totals by a plain grouped sum (pre-aggregated before its shuffle, at most ``groups x buckets`` rows) and
   their exclusive running total: the bucket offsets;
2. one shuffle of the rows on (group, bucket); a window inside (group, bucket) gives the running sum within the bucket,
   so every task holds about ``rows_per_bucket`` rows even when one group (one class, one category level) holds a
   third of the table;
3. offsets joined to the rows: broadcast when their size is within a bound of bytes, else a shuffle join.

The input is read twice (totals, then rows) and shuffled once.

The result equals the plain window exactly; buckets only change how the work is spread.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ROWS_PER_BUCKET = 1 << 20
MAX_BROADCAST_BYTES = 32 << 20
ROW_BYTES = 64  # of an offsets row with a short key, about; a caller's row bound is turned into bytes by it


def hex_digits_for(n_rows: int, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET, max_digits: int = 8) -> int:
    """Fewest leading md5 hex digits so that a bucket holds about ``rows_per_bucket`` rows or fewer."""
    need = max(1.0, n_rows / max(1, rows_per_bucket))
    return int(min(max_digits, max(1, math.ceil(math.log(need, 16)) if need > 1 else 1)))


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, bound: int | None = None) -> DataFrame:
    """Broadcast-hint ``df`` only when its size is within ``max_bytes``; otherwise leave the join to a shuffle.

    ``bound`` is an analytic upper bound on the row count of narrow rows (e.g. groups x buckets); without one the
    rows are measured, written out as JSON.
    """
    if bound is not None:
        size = bound * ROW_BYTES
    else:
        size = df.select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def exclusive_prefix(
    df: DataFrame,
    group_cols: Sequence[str],
    bucket: str,
    order: Sequence[Column | str],
    sums: dict[str, Column | str],
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    offset_rows_bound: int | None = None,
) -> DataFrame:
    """Add, per row, the sum of each ``sums`` expression over rows of the same group strictly before it.

    The order is (bucket, *order); ``bucket`` must be a column of ``df`` that is monotone in ``order``. Ties in
    ``order`` are broken by input position, so callers pass a total order (e.g. md5 key, then id).
    Output columns are named after the keys of ``sums``. ``offset_rows_bound`` (groups x buckets, when the caller
    knows it) decides the broadcast without an extra pass over the data.
    """
    group_cols = list(group_cols)
    tmp = {name: f"__v_{name}" for name in sums}
    base = df.withColumns({tmp[n]: (F.col(e) if isinstance(e, str) else e) for n, e in sums.items()})

    part = Window.partitionBy(*group_cols, bucket)
    w_in = part.orderBy(*[F.col(o) if isinstance(o, str) else o for o in order]).rowsBetween(
        Window.unboundedPreceding, -1)
    within = base.withColumns({f"__in_{n}": F.coalesce(F.sum(tmp[n]).over(w_in), F.lit(0)) for n in sums})
    totals = base.groupBy(*group_cols, bucket).agg(*[F.sum(tmp[n]).alias(f"__tot_{n}") for n in sums])
    w_off = Window.partitionBy(*group_cols).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*group_cols, bucket]
    offsets = totals.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.coalesce(F.sum(f"__tot_{n}").over(w_off), F.lit(0)).alias(f"__off_{n}") for n in sums],
    )
    offsets = broadcast_if_small(offsets, max_broadcast_bytes, offset_rows_bound)
    # null-safe: a NULL group is a group
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    joined = within.join(offsets, on=cond, how="inner").drop(*[f"__k{i}" for i in range(len(keys))])
    return joined.withColumns({n: F.col(f"__off_{n}") + F.col(f"__in_{n}") for n in sums}).drop(
        *tmp.values(), *[f"__off_{n}" for n in sums], *[f"__in_{n}" for n in sums]
    )
