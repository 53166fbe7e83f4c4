"""Exact accuracy, F1 (positive class), ROC AUC and their composite, per group (fold, experiment, ...).

ROC AUC counts tied scores half: rows collapse to distinct (group, score) with positive and negative counts, then
AUC = sum(pos * (neg_before + neg / 2)) / (P * N). ``neg_before`` is a bucketed prefix sum over quantile buckets of
the score, so no task holds the whole sorted score column. The sums are of integers and halves, hence exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.prefix import DEFAULT_ROWS_PER_BUCKET, exclusive_prefix
from kestrel.session import cut_lineage


def confusion(df: DataFrame, label: str, pred: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Counts per group; a NULL label or prediction raises with the number of such rows in the group."""
    y = F.col(label).cast("bigint")
    p = F.col(pred).cast("bigint")
    c = df.groupBy(*group_cols).agg(
        F.count("*").alias("n"),
        F.sum(y * p).alias("tp"),
        F.sum((1 - y) * p).alias("fp"),
        F.sum(y * (1 - p)).alias("fn"),
        F.count_if(y.isNull() | p.isNull()).alias("__bad"),
    )
    message = F.concat(F.col("__bad").cast("string"), F.lit(f" rows have a NULL in '{label}' or '{pred}'"))
    n = F.when(F.col("__bad") == 0, F.col("n")).otherwise(F.raise_error(message).cast("bigint"))
    return c.select(*group_cols, n.alias("n"), "tp", "fp", "fn")


def accuracy_f1(df: DataFrame, label: str = "y", pred: str = "prediction", group_cols: Sequence[str] = ()):
    c = confusion(df, label, pred, group_cols)
    f1_den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return c.select(
        *group_cols,
        ((F.col("n") - F.col("fp") - F.col("fn")) / F.col("n")).alias("accuracy"),
        F.when(f1_den > 0, 2 * F.col("tp") / f1_den).otherwise(F.lit(0.0)).alias("f1"),
    )


def roc_auc(
    df: DataFrame,
    label: str = "y",
    score: str = "score",
    group_cols: Sequence[str] = (),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    max_groups: int | None = None,
) -> DataFrame:
    """Exact ROC AUC per group; NULL when a group has only one class. NULL or NaN scores and NULL labels have no place
    in the order: they raise with their number."""
    group_cols = list(group_cols)
    y = F.col(label).cast("bigint")
    s = F.col(score)
    agg = df.groupBy(*group_cols, score).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"), F.count_if(s.isNull() | F.isnan(s) | y.isNull()).alias("bad")
    )
    agg = cut_lineage(agg)  # a row per distinct score: counted, cut into ranges and summed from this copy
    n_distinct, bad = agg.agg(F.count("*"), F.sum("bad")).first()
    if bad:
        raise ValueError(f"{bad} rows have a NULL or NaN in '{score}' or a NULL in '{label}'")
    agg = agg.drop("bad")
    n_buckets = max(1, math.ceil(n_distinct / rows_per_bucket))
    if n_buckets > 1:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        bounds = agg.approxQuantile(score, probs, 1.0 / (4 * n_buckets))
        splits = [-math.inf, *sorted(set(bounds)), math.inf]
        bucketed = Bucketizer(splits=splits, inputCol=score, outputCol="__b").transform(agg)
    else:
        bucketed = agg.withColumn("__b", F.lit(0.0))
    bound = None if max_groups is None else max_groups * (n_buckets + 1)
    pref = exclusive_prefix(bucketed, group_cols, "__b", [score], {"neg_before": F.col("neg")},
                            offset_rows_bound=bound)
    per = pref.groupBy(*group_cols).agg(
        F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))).alias("__num"),
        F.sum("pos").alias("__p"),
        F.sum("neg").alias("__n"),
    )
    return per.select(
        *group_cols,
        F.when((F.col("__p") > 0) & (F.col("__n") > 0), F.col("__num") / (F.col("__p").cast("double") * F.col("__n").cast("double"))).alias(
            "roc_auc"
        ),
    )


def classification_metrics(
    df: DataFrame,
    label: str = "y",
    pred: str = "prediction",
    prob: str = "y_prob",
    group_cols: Sequence[str] = (),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    max_groups: int | None = None,
) -> DataFrame:
    """Per group: accuracy, f1, roc_auc, composite = (accuracy + f1 + roc_auc) / 3."""
    keys = list(group_cols)
    if not keys:  # a constant key keeps the two one-row sides an equi-join
        df, keys = df.withColumn("__all", F.lit(0)), ["__all"]
    af = accuracy_f1(df, label, pred, keys)
    auc = roc_auc(df, label, prob, keys, rows_per_bucket, max_groups or 1 if not group_cols else max_groups)
    joined = af.join(auc, keys, "left").withColumn(
        "composite", (F.col("accuracy") + F.col("f1") + F.col("roc_auc")) / F.lit(3.0)
    )
    return joined if group_cols else joined.drop("__all")


def fold_mean(metrics: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Mean of each metric over folds (A5)."""
    return metrics.groupBy(*group_cols).agg(
        *[F.avg(m).alias(f"mean_{m}") for m in ("accuracy", "f1", "roc_auc", "composite")]
    )
