"""Stratified hold-out and k-fold assignment (V1, V2) and the class-size guard.

Rows are ranked inside their class by ``md5("<id>:<seed>")`` (then id). The first ``ceil(test_size * n_class)``
ranks of each class are the hold-out; the others are cut into k ranges of ranks whose sizes differ by one at most.
So a split is fixed by k + 1 cut keys per class. The cuts come from counts of md5 prefixes and from the few prefix
buckets in which a cut falls; assigning rows is then a projection over a broadcast of one row per class. No row is
shuffled, no task holds a class, and the split is a pure function of (id, seed): a retried task, a lost executor, or
DuckDB all produce the same rows. A NULL label raises: it can be in no class.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.columns import md5_bucket, md5_key
from kestrel.operators.prefix import DEFAULT_ROWS_PER_BUCKET, broadcast_if_small, exclusive_prefix, hex_digits_for
from kestrel.session import cut_lineage

log = logging.getLogger(__name__)

TEST = "test"
TRAIN = "trainval"


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class; the result has one row per class, so it is collected. NULL labels raise with their number."""
    counts = {r[0]: int(r[1]) for r in df.groupBy(label).count().collect()}
    if counts.get(None):
        raise ValueError(f"{counts[None]} rows have a NULL label in '{label}'")
    return counts


def rank_within_class(
    df: DataFrame,
    label: str = "y",
    id_col: str = "id",
    seed: int | str = 42,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    rank_col: str = "rank",
    n_rows: int | None = None,
    n_classes: int | None = None,
) -> DataFrame:
    """1-based rank of each row inside its class in md5(id:seed), id order."""
    if n_rows is None or n_classes is None:
        counts = class_counts(df, label)
        n_rows, n_classes = sum(counts.values()), len(counts)
    digits = hex_digits_for(n_rows, rows_per_bucket)
    keyed = df.withColumn("__key", md5_key(id_col, seed)).withColumn("__bucket", md5_bucket("__key", digits))
    ranked = exclusive_prefix(
        keyed, [label], "__bucket", ["__key", id_col], {"__before": F.lit(1)},
        offset_rows_bound=n_classes * 16**digits,
    )
    return ranked.withColumn(rank_col, F.col("__before") + 1).drop("__key", "__bucket", "__before")


def cut_keys(keyed: DataFrame, label: str, id_col: str, digits: int, starts: list[str]) -> DataFrame:
    """For each class and each cut, the key and id of the row with that 1-based rank: columns ``label``, ``cut``,
    ``key``, ``id``.

    ``keyed`` has __key (md5 hex), ``starts`` are SQL expressions of the cut ranks in ``n`` (rows of the class). Only
    counts of md5 prefixes are summed over, and only rows of the buckets in which a cut falls are ordered.
    """
    bucketed = keyed.withColumn("__bucket", md5_bucket("__key", digits))
    counts = bucketed.groupBy(label, "__bucket").agg(F.count("*").alias("__c"))
    upto = Window.partitionBy(label).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("__upto", F.sum("__c").over(upto)).withColumn("n", F.sum("__c").over(Window.partitionBy(label)))
    ranks = F.array(*[F.struct(F.lit(i).alias("cut"), F.expr(e).cast("bigint").alias("rank")) for i, e in enumerate(starts)])
    wanted = counts.withColumn("__r", F.explode(ranks)).where(
        (F.col("__r.rank") <= F.col("__upto")) & (F.col("__r.rank") > F.col("__upto") - F.col("__c")))
    wanted = wanted.select(label, "__bucket", F.col("__r.cut").alias("cut"),
                           (F.col("__r.rank") - F.col("__upto") + F.col("__c")).alias("__at"))
    wanted = cut_lineage(wanted)  # a row per class and cut
    in_bucket = Window.partitionBy(label, "__bucket").orderBy("__key", id_col)
    rows = bucketed.join(broadcast_if_small(wanted.select(label, "__bucket").distinct()), [label, "__bucket"])
    rows = rows.select(label, "__bucket", "__key", id_col).withColumn("__at", F.row_number().over(in_bucket))
    return rows.join(broadcast_if_small(wanted), [label, "__bucket", "__at"]).select(
        label, "cut", F.col("__key").alias("key"), F.col(id_col).alias("id"))


def _narrow(df: DataFrame, label: str, id_col: str, seed) -> tuple[DataFrame, int]:
    """(label, id and key of every row, written once; rows per bucket digit): what all cuts of a split are found from."""
    keyed = cut_lineage(df.select(label, id_col).withColumn("__key", md5_key(id_col, seed)))
    return keyed, sum(class_counts(keyed, label).values())


def _assign(df: DataFrame, narrow: tuple[DataFrame, int], label: str, id_col: str, seed, starts: dict[str, list[str]],
            rows_per_bucket: int) -> DataFrame:
    """Add for every name in ``starts`` how many of its cuts lie at or before the row in its class's order. All cuts come
    from the narrow copy in one go; ``df`` itself is only projected."""
    keyed, n_rows = narrow
    digits = hex_digits_for(n_rows, min(rows_per_bucket, CUT_BUCKET_ROWS))
    every = [e for es in starts.values() for e in es]
    cuts = cut_keys(keyed, label, id_col, digits, every)
    one = F.struct("cut", "key", "id")
    per_class = cut_lineage(cuts.groupBy(label).agg(F.sort_array(F.collect_list(one)).alias("__cuts")))  # a row per class
    out = df.withColumn("__key", md5_key(id_col, seed)).join(broadcast_if_small(per_class), label, "left")
    here = F.struct(F.col("__key").alias("key"), F.col(id_col).alias("id"))
    first, ranges = 0, {}
    for name, own in starts.items():
        ranges[name] = F.size(F.filter("__cuts", _passed(first, first + len(own), here)))
        first += len(own)
    return out.withColumns(ranges).drop("__key", "__cuts")


def _passed(low: int, high: int, here: Column):
    """Whether a cut has a number from ``low`` to below ``high`` and lies at or before ``here``."""
    return lambda c: (c["cut"] >= low) & (c["cut"] < high) & (F.struct(c["key"].alias("key"), c["id"].alias("id")) <= here)


CUT_BUCKET_ROWS = 1 << 14  # rows of a bucket that is ordered to find a cut, about


def stratified_split(
    df: DataFrame,
    label: str = "y",
    id_col: str = "id",
    test_size: float = 0.2,
    k: int = 5,
    seed: int | str = 42,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    cv_scope: str = "trainval",
) -> DataFrame:
    """Add ``split`` ('test'/'trainval') and ``fold`` (0..k-1; NULL on hold-out rows when cv_scope='trainval').

    ``cv_scope='all'`` numbers folds over every row (the first baseline's CV on 100 % of rows) while still marking
    the hold-out.
    """
    columns = df.columns
    n_test = f"cast(ceil({float(test_size)!r}D * n) as bigint)" if test_size > 0 else "0L"
    # Fold j of m rows starts at 0-based place ceil(j m / k); the hold-out comes before fold 0.
    inside = [f"({n_test}) + 1 + cast(-floor(-({j}L * (n - ({n_test}))) / {k}L) as bigint)" for j in range(k)]
    starts = {"__range": inside} if cv_scope != "all" else {"__range": [f"({n_test}) + 1"], "__all": all_starts(k)}
    out = _assign(df, _narrow(df, label, id_col, seed), label, id_col, seed, starts, rows_per_bucket)
    split = F.when(F.col("__range") == 0, F.lit(TEST)).otherwise(F.lit(TRAIN))
    fold = F.when(F.col("__range") > 0, F.col("__range") - 1) if cv_scope != "all" else F.col("__all") - 1
    return out.select(*columns, split.alias("split"), fold.cast("int").alias("fold"))


def all_starts(k: int) -> list[str]:
    """First ranks of k folds over all n rows of a class."""
    return [f"1L + cast(-floor(-({j}L * n) / {k}L) as bigint)" for j in range(k)]


def kfold(
    df: DataFrame,
    k: int = 5,
    label: str = "y",
    id_col: str = "id",
    seed: int | str = 42,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    fold_col: str = "fold",
) -> DataFrame:
    """Stratified k-fold over all rows of ``df`` (used inside stacking and calibration)."""
    out = _assign(df, _narrow(df, label, id_col, seed), label, id_col, seed, {"__range": all_starts(k)}, rows_per_bucket)
    return out.withColumn(fold_col, (F.col("__range") - 1).cast("int")).drop("__range")


def min_class_size(df: DataFrame, label: str = "y", n_splits: int = 5) -> DataFrame:
    """One row: smallest class size, n_splits, and a flag when a class is smaller than n_splits."""
    out = df.groupBy(label).count().agg(F.min("count").alias("min_class_size"))
    out = out.select(
        F.col("min_class_size").cast("bigint").alias("min_class_size"),
        F.lit(n_splits).cast("int").alias("n_splits"),
        (F.col("min_class_size") < n_splits).cast("int").alias("too_small"),
    )
    return out


def warn_if_small(df: DataFrame, label: str = "y", n_splits: int = 5, counts: dict | None = None) -> int:
    """Logs when the rarest class has fewer rows than there are folds; ``counts`` are its rows per class if known."""
    smallest = min((counts or class_counts(df, label)).values())
    if smallest < n_splits:
        log.warning(
            "%d rows in the rarest class: fewer than the %d folds, so some fold will not see it",
            smallest,
            n_splits,
        )
    return smallest
