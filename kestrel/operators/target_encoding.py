"""Ordered target statistics for categorical columns (F9; Prokhorenkova et al., 2018).

Training rows: for each row, in a random but deterministic order (md5 of id and seed), the encoding uses only the
rows of the same level that come before it: ``(sum_y_before + prior) / (count_before + 1)``. The running sums come
from the bucketed prefix sum, so a level that holds a third of the table is still spread over many tasks.
Scoring rows: the full training statistics of the level, ``(sum_y + prior) / (count + 1)`` (``OrderedTargetEncoder``).
Its levels are a table (column, level, encoding) of any size, joined to the rows to score: NULL is a level of its own,
apart from any string, and values are compared as Spark casts them to strings.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLWritable)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.columns import md5_bucket, md5_key
from kestrel.operators.prefix import DEFAULT_ROWS_PER_BUCKET, broadcast_if_small, exclusive_prefix, hex_digits_for
from kestrel.session import cut_lineage


def ordered_target_encode(
    df: DataFrame,
    cat_cols: Sequence[str],
    label: str = "y",
    id_col: str = "id",
    seed: str | int = "cb",
    prior: float | None = None,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    suffix: str = "_te",
) -> DataFrame:
    """Add ``<col>_te`` for each categorical column (NULL levels must be filled first)."""
    stats = df.agg(F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("p")).first()
    n_rows, p = int(stats["n"]), (stats["p"] if prior is None else prior)
    digits = hex_digits_for(n_rows, rows_per_bucket)
    out = df.withColumn("__k", md5_key(id_col, seed)).withColumn("__bk", md5_bucket("__k", digits))
    for c in cat_cols:
        n_levels = out.select(c).distinct().count()
        out = exclusive_prefix(
            out, [c], "__bk", ["__k", id_col],
            {"__s": F.col(label).cast("double"), "__n": F.lit(1)},
            offset_rows_bound=n_levels * 16**digits,
        )
        out = out.withColumn(c + suffix, (F.col("__s") + F.lit(p)) / (F.col("__n") + F.lit(1.0))).drop("__s", "__n")
    return out.drop("__k", "__bk")


def ordered_target_encode_folds(
    df: DataFrame, cat_cols: Sequence[str], label: str, id_col: str, fold_col: str, k: int, seed: str | int = "cb",
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``<col>_te_<j>`` for every fold j, as a model without fold j sees the rows: rows of other folds by the ordered
    statistics of these other folds, rows of fold j by their full statistics. One shuffle per column serves all folds (the
    running sums of all folds go through the same buckets). NULL levels must be filled first."""
    y = F.col(label).cast("double")
    inside = [F.col(fold_col) != j for j in range(k)]
    prior = df.agg(*[F.avg(F.when(c, y)).alias(f"p{j}") for j, c in enumerate(inside)], F.count("*").alias("n")).first()
    digits = hex_digits_for(int(prior["n"]), rows_per_bucket)
    out = df.withColumn("__k", md5_key(id_col, seed)).withColumn("__bk", md5_bucket("__k", digits))
    for c in cat_cols:
        sums = {f"__s{j}": F.when(i, y).otherwise(0.0) for j, i in enumerate(inside)}
        sums |= {f"__n{j}": F.when(i, F.lit(1)).otherwise(0) for j, i in enumerate(inside)}
        totals = cut_lineage(df.groupBy(F.col(c).alias("__level")).agg(*[F.sum(e).alias(n.replace("__", "__t")) for n, e in sums.items()]))
        out = exclusive_prefix(out, [c], "__bk", ["__k", id_col], sums, offset_rows_bound=totals.count() * 16**digits)
        out = out.join(broadcast_if_small(totals), F.col(c).eqNullSafe(F.col("__level")))
        te = {}
        for j, i in enumerate(inside):
            s, n = (F.when(i, F.col(f"__{a}{j}")).otherwise(F.col(f"__t{a}{j}")) for a in ("s", "n"))
            te[f"{c}_te_{j}"] = (s + F.lit(prior[f"p{j}"])) / (n + F.lit(1.0))
        out = out.withColumns(te).drop("__level", *sums, *[n.replace("__", "__t") for n in sums])
    return out.drop("__k", "__bk")


def combined(cols: Sequence[str]) -> Column:
    """One level for the values of several columns; NULL is a value of its own."""
    return F.to_json(F.array(*[_level(c) for c in cols]))


def _stacked(df: DataFrame, features: Sequence[Sequence[str]], *keep: Column) -> DataFrame:
    """A row per row and feature (one column or several): ``keep``, ``feature`` (names joined by +) and ``level``."""
    one = F.array(*[F.struct(F.lit("+".join(f)).alias("feature"), combined(f).alias("level")) for f in features])
    return df.select(*keep, F.explode(one).alias("s")).select("*", "s.feature", "s.level").drop("s")


def combination_gains(df: DataFrame, cat_cols: Sequence[str], label: str = "y", size: int = 2) -> DataFrame:
    """(feature, n_levels, gain) of every column and of every combination of up to ``size`` columns: what their smoothed level
    means explain of the label, sum of n_l (m_l - p)^2 with m_l = (s_l + p) / (n_l + 1). Sums per level come from one grouped
    pass over all features."""
    features = [c for n in range(1, size + 1) for c in itertools.combinations(cat_cols, n)]
    y = F.col(label).cast("double")
    p = df.agg(F.avg(y)).first()[0]
    levels = _stacked(df, features, y.alias("y")).groupBy("feature", "level").agg(F.sum("y").alias("s"), F.count("*").alias("n"))
    d = (F.col("s") + F.lit(p)) / (F.col("n") + F.lit(1.0)) - F.lit(p)
    return levels.groupBy("feature").agg(F.count("*").alias("n_levels"), F.sum(F.col("n") * d * d).alias("gain"))


def chosen_combinations(gains: DataFrame, least: float = 1.1) -> list[list[str]]:
    """The combinations that explain at least ``least`` times what the best of their single columns explains."""
    by = {r["feature"]: r["gain"] for r in gains.collect()}  # a row per feature
    names = [f.split("+") for f in sorted(by)]
    return [f for f in names if len(f) > 1 and by["+".join(f)] >= least * max(by.get(c, 0.0) for c in f)]


def ordered_target_permutations(
    df: DataFrame, features: Sequence[Sequence[str]], label: str = "y", id_col: str = "id", seeds: Sequence[str] = ("cb0", "cb1", "cb2"),
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
) -> DataFrame:
    """(id, permutation, feature, te): ordered target statistics in several seeded orders, of single columns and of
    combinations. All orders and features go through the same bucketed prefix sums: one shuffle in all, on (permutation,
    feature, level, bucket), so that a level that holds a third of the rows is spread over many tasks."""
    y = F.col(label).cast("double")
    stats = df.agg(F.count("*").alias("n"), F.avg(y).alias("p")).first()
    digits = hex_digits_for(int(stats["n"] or 0), rows_per_bucket)
    orders = F.explode(F.array(*[F.struct(F.lit(i).alias("permutation"), md5_key(id_col, s).alias("k")) for i, s in enumerate(seeds)]))
    rows = _stacked(df, features, F.col(id_col).alias("id"), y.alias("y")).select("*", orders.alias("o"))
    rows = rows.select("id", "y", "feature", "level", "o.permutation", F.col("o.k").alias("__k")).withColumn("__bk", md5_bucket("__k", digits))
    sums = exclusive_prefix(rows, ["permutation", "feature", "level"], "__bk", ["__k", "id"], {"__s": F.col("y"), "__n": F.lit(1)})
    te = (F.col("__s") + F.lit(stats["p"])) / (F.col("__n") + F.lit(1.0))
    return sums.select("id", "permutation", "feature", te.alias("te"))


def _level(col: str):
    return F.col(col).cast("string")


class OrderedTargetEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Scoring-side encoder: full-training-data level statistics, one row per column and level."""

    catCols = Param(Params._dummy(), "catCols", "categorical columns", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)

    @keyword_only
    def __init__(self, catCols=None, labelCol="y"):
        super().__init__()
        self._setDefault(catCols=[], labelCol="y")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "OrderedTargetEncoderModel":
        y = F.col(self.getOrDefault(self.labelCol)).cast("double")
        p = dataset.agg(F.avg(y)).first()[0]
        cats = self.getOrDefault(self.catCols)
        stacked = dataset.select(y.alias("y"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("col"), _level(c).alias("level")) for c in cats])).alias("s"))
        stats = stacked.groupBy("s.col", "s.level").agg(F.sum("y").alias("s"), F.count("*").alias("n"))
        m = OrderedTargetEncoderModel()
        m._set(catCols=cats, prior=float(p))
        m.levels = cut_lineage(stats.select("col", "level", ((F.col("s") + F.lit(p)) / (F.col("n") + F.lit(1.0))).alias("te")))
        return m


class _LevelWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.levels.write.parquet(f"{path.rstrip('/')}/levels")


class _LevelReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.levels = SparkSession.getActiveSession().read.parquet(f"{path.rstrip('/')}/levels")
        return model


class OrderedTargetEncoderModel(Model, MLWritable, MLReadable):
    catCols = Param(Params._dummy(), "catCols", "categorical columns", TypeConverters.toListString)
    prior = Param(Params._dummy(), "prior", "positive rate of the training rows", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(catCols=[], prior=0.5)
        self.levels: DataFrame | None = None  # col, level, te

    def write(self):
        return _LevelWriter(self)

    @classmethod
    def read(cls):
        return _LevelReader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = self.getOrDefault(self.prior)
        out = dataset
        for i, c in enumerate(self.getOrDefault(self.catCols)):
            own = self.levels.where(F.col("col") == c).select(F.col("level").alias(f"__l{i}"), F.col("te").alias(f"__te{i}"))
            own = broadcast_if_small(own)
            out = out.join(own, _level(c).eqNullSafe(F.col(f"__l{i}")), "left")
            out = out.withColumn(c + "_te", F.coalesce(F.col(f"__te{i}"), F.lit(p))).drop(f"__l{i}", f"__te{i}")
        return out
