"""Places of rows in a total order, for operators that number rows (11, 12): no window over a whole table or group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import broadcast_if_small, written

RANGE_ROWS = 1 << 18  # rows of a range, about
TASK_BITS = 33  # bits that ``monotonically_increasing_id`` leaves for the place inside a task


def numbered(df: DataFrame, order: Sequence[Column], place: str = "place", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` plus ``place`` (from 0) in the order, which must be total up to rows that are equal in all that counts.

    Rows are shuffled once, by ranges of the order, sorted inside each range and written; a range's first place comes
    from the counts of the ranges before it (one row per range). ``df`` is read twice (bounds, then rows), so it should
    be narrow and written.
    """
    ranges = max(1, -(-df.count() // range_rows))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt = written(dealt.withColumn("_at", F.monotonically_increasing_id()))
    row, inside = F.shiftright("_at", TASK_BITS), F.col("_at").bitwiseAND((1 << TASK_BITS) - 1)
    sizes = {r["task"]: r["n"] for r in dealt.groupBy(row.alias("task")).agg(F.count("*").alias("n")).collect()}
    firsts, before = [], 0
    for task in sorted(sizes):
        firsts.append((task, before))
        before += sizes[task]
    starts = df.sparkSession.createDataFrame(firsts, "_task bigint, _first bigint")
    out = dealt.withColumn("_task", row).join(broadcast_if_small(starts), "_task")
    return out.withColumn(place, F.col("_first") + inside).drop("_at", "_task", "_first")
