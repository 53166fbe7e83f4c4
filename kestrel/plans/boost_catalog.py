"""Registered queries of the boosters' parts, each with DuckDB SQL that works them out again from the tables.

``bin_borders`` and ``bin_counts`` (F10), ``leafwise_trees`` (C6: the first trees of the leaf-wise booster, node by node),
``symmetric_trees`` (C7, C8: the first symmetric trees, with leaf penalty), ``importance_value_change`` (M7, T1 over those
leaf-wise trees), ``category_combinations`` and ``ordered_target_permutations`` (F9). Rows are the training rows of the fixture view with its numeric columns, NULLs included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.columns import r6
from kestrel.operators import binning, boosting
from kestrel.operators.splits import TRAIN, stratified_split
from kestrel.operators.target_encoding import combination_gains, ordered_target_permutations
from kestrel.plans.search import top_importances
from kestrel.session import cut_lineage
from kestrel.sources.fixtures import ART_CAT, ART_NUM, art

NAMES = list(ART_NUM)
TREES = 2
LEAF = boosting.Setting(growth="leaf", trees=TREES)
LEVEL = boosting.Setting(growth="level", trees=TREES, rate=0.05, depth=6, l2=3.0)


def _values() -> dict[str, Column]:
    return {c: F.col(c) for c in NAMES}


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    """key, label, fold (-1: hold-out) and the numeric columns of every row, written."""
    a = art(spark, sf).select("id", "y", *NAMES)
    split = stratified_split(cut_lineage(a), "y", "id", 0.2, 5, 42)
    fold = F.when(F.col("split") == TRAIN, F.lit(0)).otherwise(F.lit(boosting.NO_FOLD))
    return cut_lineage(split.select(
        F.col("id").alias("key"), F.col("y").cast("double").alias("label"), fold.cast("int").alias("fold"), *NAMES))


def _train_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("fold") != boosting.NO_FOLD)


def q_bin_borders(spark: SparkSession, sf: str) -> DataFrame:
    sketched = binning.sketches(_train_rows(_rows(spark, sf)), _values())
    table = binning.border_table(binning.quantiles(cut_lineage(sketched), NAMES))
    return table.select("feature", "border_count", "border_no", r6(F.col("border")).alias("border"))


def _matrix(spark: SparkSession, sf: str):
    rows = _rows(spark, sf)
    borders = binning.learn_borders(_train_rows(rows), _values())
    return binning.binned(rows, _values(), borders, ["key", "label", "fold"]), borders


def q_bin_counts(spark: SparkSession, sf: str) -> DataFrame:
    matrix, borders = _matrix(spark, sf)
    return binning.bin_counts(matrix, borders.names)


def _nodes(spark: SparkSession, sf: str, setting: boosting.Setting) -> DataFrame:
    matrix, borders = _matrix(spark, sf)
    model = boosting.train(matrix, borders, [boosting.Fit(setting, list(range(len(NAMES))))])[0]
    return cut_lineage(spark.createDataFrame(boosting.node_rows(model, borders), boosting.NODE_SCHEMA))


def _paths(nodes: DataFrame, spark: SparkSession) -> DataFrame:
    """(tree, node, path): the turns from the root to every node. Nodes of a few trees, level by level."""
    at = nodes.where("node = 0").select("tree", "node", F.lit("").alias("path"))
    out = at
    step = nodes.where(F.col("left").isNotNull()).select("tree", F.col("node").alias("up"), F.explode(
        F.array(F.struct(F.col("left").alias("node"), F.lit("L").alias("turn")), F.struct(F.col("right").alias("node"), F.lit("R").alias("turn")))).alias("s"))
    step = cut_lineage(step.select("tree", "up", "s.node", "s.turn"))
    while True:
        up = at.select("tree", F.col("node").alias("up"), "path")
        at = cut_lineage(step.join(up, ["tree", "up"]).select("tree", "node", F.concat("path", "turn").alias("path")))
        if at.isEmpty():
            return out
        out = out.unionByName(at)


def _node_table(spark: SparkSession, sf: str, setting: boosting.Setting) -> DataFrame:
    nodes = _nodes(spark, sf, setting)
    value = F.when(F.col("feature").isNull(), F.col("value"))
    return nodes.join(_paths(nodes, spark), ["tree", "node"]).select(
        "tree", "path", "feature", r6(F.col("border")).alias("border"), "n_rows", r6(F.col("gain")).alias("gain"), r6(value).alias("value"))


def q_leafwise_trees(spark: SparkSession, sf: str) -> DataFrame:
    return _node_table(spark, sf, LEAF)


def q_symmetric_trees(spark: SparkSession, sf: str) -> DataFrame:
    return _node_table(spark, sf, LEVEL)


def q_importance_value_change(spark: SparkSession, sf: str) -> DataFrame:
    shares = boosting.value_change(_nodes(spark, sf, LEAF))
    return top_importances(shares.select("feature", r6(F.col("importance")).alias("importance")), 20)


def _category_rows(spark: SparkSession, sf: str) -> DataFrame:
    a = cut_lineage(art(spark, sf).select("id", "y", *ART_CAT))
    return cut_lineage(stratified_split(a, "y", "id", 0.2, 5, 42).where(F.col("split") == TRAIN))


def q_category_combinations(spark: SparkSession, sf: str) -> DataFrame:
    """what single categories and their combination explain of the label."""
    gains = combination_gains(_category_rows(spark, sf), list(ART_CAT))
    return gains.select("feature", "n_levels", r6(F.col("gain")).alias("gain"))


def q_ordered_target_permutations(spark: SparkSession, sf: str) -> DataFrame:
    """ordered statistics of both categories and their combination in three orders."""
    features = [[c] for c in ART_CAT] + [list(ART_CAT)]
    out = ordered_target_permutations(_category_rows(spark, sf), features, seeds=SEEDS)
    return out.select("id", "permutation", "feature", r6(F.col("te")).alias("te"))


SEEDS = ("cb0", "cb1", "cb2")

BOOST: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bin_borders": q_bin_borders,
    "bin_counts": q_bin_counts,
    "leafwise_trees": q_leafwise_trees,
    "symmetric_trees": q_symmetric_trees,
    "importance_value_change": q_importance_value_change,
    "category_combinations": q_category_combinations,
    "ordered_target_permutations": q_ordered_target_permutations,
}
