"""Fit-on-training-rows preprocessing as pyspark.ml stages.

``TabularPreprocessor`` fits, in at most three aggregate passes over the training rows:
  * numeric: mean, population variance and present count per column (one pass), exact median if asked (F2);
  * categorical: (column, value) counts in one grouped pass -> mode (ties: smallest value) and sorted levels.
The fitted model is a single projection of built-in expressions: impute (coalesce), standardise with population
sigma (constant column -> 0), one-hot with the alphabetically first level dropped, and assembly into one vector
(``array_to_vector``) that carries attribute names for importances. It persists inside a ``PipelineModel``.

``fit_folds`` fits all k "all folds but k" models from one grouped pass (fold sufficient statistics): per-fold
mean and M2 merged with the parallel-variance rule, per-fold level counts subtracted from the total.
"""

from __future__ import annotations

import json
import logging
import math
import re
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from kestrel.functions.columns import nan_to_null
from kestrel.operators.quantiles import exact_medians

log = logging.getLogger(__name__)

MISSING = "missing"  # fixed value: the constant categorical fill


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of any numeric type, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def level_name(col: str, level: str) -> str:
    return f"{col}_{re.sub(r'[^0-9A-Za-z]+', '_', str(level)).strip('_')}"


def unique_names(names: Sequence[str], taken: Sequence[str] = ()) -> list[str]:
    """``names`` with a running number behind those that are taken or met before (in order, so it is repeatable)."""
    used, out = set(taken), []
    for n in names:
        name, i = n, 2
        while name in used:
            name, i = f"{n}_{i}", i + 1
        used.add(name)
        out.append(name)
    return out


class _PreParams(Params):
    numCols = Param(Params._dummy(), "numCols", "numeric input columns", TypeConverters.toListString)
    catCols = Param(Params._dummy(), "catCols", "categorical input columns", TypeConverters.toListString)
    numStrategy = Param(Params._dummy(), "numStrategy", "mean | median | none", TypeConverters.toString)
    catStrategy = Param(Params._dummy(), "catStrategy", "mode | constant | none", TypeConverters.toString)
    fillValue = Param(Params._dummy(), "fillValue", "constant categorical fill", TypeConverters.toString)
    scale = Param(Params._dummy(), "scale", "standardise numeric columns", TypeConverters.toBoolean)
    oneHot = Param(Params._dummy(), "oneHot", "one-hot categorical columns (drop first)", TypeConverters.toBoolean)
    handleInvalid = Param(Params._dummy(), "handleInvalid", "unseen level: error | keep", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "assembled vector column", TypeConverters.toString)
    outputMode = Param(Params._dummy(), "outputMode", "vector | columns", TypeConverters.toString)
    maxLevels = Param(Params._dummy(), "maxLevels", "most levels of a one-hot column", TypeConverters.toInt)

    def _defaults(self):
        self._setDefault(
            numCols=[], catCols=[], numStrategy="mean", catStrategy="mode", fillValue=MISSING, scale=True,
            oneHot=True, handleInvalid="error", outputCol="features", outputMode="vector", maxLevels=10000,
        )


class TabularPreprocessor(Estimator, _PreParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, numCols=None, catCols=None, numStrategy="mean", catStrategy="mode", fillValue=MISSING,
                 scale=True, oneHot=True, handleInvalid="error", outputCol="features", outputMode="vector",
                 maxLevels=10000):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def g(self, p):
        return self.getOrDefault(p)

    # ---- statistics -------------------------------------------------------------------------------------------
    def _num_moments(self, df: DataFrame, group: str | None = None):
        nums = self.g(self.numCols)
        aggs = [F.count("*").alias("__n")]
        for i, c in enumerate(nums):
            x = nan_to_null(F.col(c).cast("double"))
            aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
        rows = (df.groupBy(group) if group else df.groupBy()).agg(*aggs).collect()  # one row per fold at most
        return rows

    def _cat_counts(self, df: DataFrame, group: str | None = None) -> DataFrame | None:
        """Distributed (group,) col, v, count; None when no fitted state depends on the levels."""
        cats = self.g(self.catCols)
        if not cats or not (self.g(self.oneHot) or self.g(self.catStrategy) == "mode"):
            return None
        keys = [group] if group else []
        stacked = df.select(
            *keys,
            F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("v")) for c in cats])).alias("s"),
        ).select(*keys, "s.col", "s.v")
        counted = stacked.groupBy(*keys, "col", "v").count()
        if self.g(self.oneHot):  # the levels become features and come to the driver, so their number is checked first
            for r in counted.select("col", "v").distinct().groupBy("col").count().collect():  # one row per column
                if r["count"] > self.g(self.maxLevels):
                    raise ValueError(f"column '{r['col']}' has {r['count']} levels; one-hot accepts {self.g(self.maxLevels)}")
        return counted

    @staticmethod
    def _best(n: Column) -> Column:
        """Most frequent level, ties to the smallest, as (minus count, level); NULL where nothing is counted."""
        return F.min(F.when(F.col("v").isNotNull() & (n > 0), F.struct((-n).alias("n"), F.col("v").alias("v"))))

    def _cat_tables(self, df: DataFrame) -> dict:
        """col -> {level: count}: all levels for one-hot columns, else the most frequent one alone."""
        counted = self._cat_counts(df)
        out: dict = {}
        if counted is None:
            return out
        if self.g(self.oneHot):
            for r in counted.collect():
                out.setdefault(r["col"], {})[r["v"]] = int(r["count"])
            return out
        for r in counted.groupBy("col").agg(self._best(F.col("count")).alias("b")).collect():  # one row per column
            if r["b"] is not None:
                out[r["col"]] = {r["b"]["v"]: -int(r["b"]["n"])}
        return out

    def _fold_cat_tables(self, df: DataFrame, fold_col: str, left_out: Sequence[int | None]) -> list[dict]:
        """``_cat_tables`` of the rows outside each fold of ``left_out`` (None: all folds), from one grouped pass."""
        df = df.where(F.col(fold_col).isNotNull())
        counted = self._cat_counts(df, fold_col)
        tables: list[dict] = [{} for _ in left_out]
        if counted is None:
            return tables
        if self.g(self.oneHot):
            for r in counted.collect():
                for j, out in zip(left_out, tables):
                    if j is None or int(r[fold_col]) != j:
                        d = out.setdefault(r["col"], {})
                        d[r["v"]] = d.get(r["v"], 0) + int(r["count"])
            return tables
        n = F.col("count")
        rest = [F.sum(n if j is None else F.when(F.col(fold_col) != j, n).otherwise(0)).alias(f"n{i}") for i, j in enumerate(left_out)]
        best = counted.groupBy("col", "v").agg(*rest).groupBy("col").agg(
            *[self._best(F.col(f"n{i}")).alias(f"b{i}") for i in range(len(tables))])
        for r in best.collect():  # one row per column
            for i, out in enumerate(tables):
                if r[f"b{i}"] is not None:
                    out[r["col"]] = {r[f"b{i}"]["v"]: -int(r[f"b{i}"]["n"])}
        return tables

    def _model_from(self, n: int, moments: dict, cat_counts: dict, medians: dict | None = None):
        """moments: col -> (count, mean, M2); cat_counts: col -> {value or None: count}."""
        nums, cats = self.g(self.numCols), self.g(self.catCols)
        strategy = self.g(self.numStrategy)
        kept, fill, mean, scale, warnings = [], [], [], [], []
        for c in nums:
            cnt, m, m2 = moments[c]
            if strategy != "none" and cnt == 0:
                warnings.append(f"column '{c}' has no observed values in the training rows and is dropped")
                log.warning(warnings[-1])
                continue
            if strategy == "median":
                f = medians[c]
            elif strategy == "mean":
                f = m
            else:
                f = None
            if strategy == "mean":
                mu, var = m, (m2 / n if n else 0.0)  # imputed rows add no deviation but count in n
            elif strategy == "median":
                mu = (cnt * m + (n - cnt) * f) / n
                var = (m2 + cnt * (m - mu) ** 2 + (n - cnt) * (f - mu) ** 2) / n
            else:
                mu, var = m, (m2 / cnt if cnt else 0.0)
            sd = math.sqrt(var) if var and var > 0 else 0.0
            kept.append(c)
            fill.append(float("nan") if f is None else float(f))
            mean.append(float(mu) if mu is not None else 0.0)
            scale.append(float(sd) if sd > 0 else 1.0)
        cat_fill, filled, levels = [], [], {}
        for c in cats:
            counts = cat_counts.get(c, {})
            present = {v: k for v, k in counts.items() if v is not None and k > 0}
            n_null = counts.get(None, 0)
            cs = self.g(self.catStrategy)
            if cs == "mode":
                f = min(present.items(), key=lambda kv: (-kv[1], kv[0]))[0] if present else None
            elif cs == "constant":
                f = self.g(self.fillValue)
            else:
                f = None
            lv = set(present)
            if n_null and f is not None:
                lv.add(f)
            cat_fill.append("" if f is None else f)
            filled.append(int(f is not None))
            levels[c] = sorted(lv)
        model = TabularPreprocessorModel()
        model._set(**{p.name: self.g(p) for p in self.params if self.isDefined(p)})
        model._set(
            numCols=kept, numFill=fill, numMean=mean, numScale=scale, catFill=cat_fill,
            catFilled=filled, catLevels=json.dumps(levels), fitWarnings=warnings,
        )
        return model

    def _fit(self, dataset: DataFrame) -> "TabularPreprocessorModel":
        nums = self.g(self.numCols)
        row = self._num_moments(dataset)[0]
        n = int(row["__n"])
        moments = {
            c: (int(row[f"c{i}"]), row[f"m{i}"], (row[f"v{i}"] or 0.0) * int(row[f"c{i}"]))
            for i, c in enumerate(nums)
        }
        medians = exact_medians(dataset, nums) if self.g(self.numStrategy) == "median" else None
        return self._model_from(n, moments, self._cat_tables(dataset), medians)

    def fit_folds(self, dataset: DataFrame, fold_col: str, k: int,
                  include_all: bool = False) -> list["TabularPreprocessorModel"]:
        """The k models fitted on 'every fold but j', from one grouped pass (plus per-fold medians if asked).

        ``include_all`` appends the model fitted on every fold (same pass): the refit's preprocessing.
        """
        nums = self.g(self.numCols)
        per = {int(r[fold_col]): r for r in self._num_moments(dataset, fold_col) if r[fold_col] is not None}
        left_out = [*range(k), *([None] if include_all else [])]
        cat_tables = self._fold_cat_tables(dataset, fold_col, left_out)
        models = []
        for j, counts in zip(left_out, cat_tables):
            others = [r for f, r in per.items() if f != j]
            n = sum(int(r["__n"]) for r in others)
            moments = {}
            for i, c in enumerate(nums):
                parts = [(int(r[f"c{i}"]), r[f"m{i}"], r[f"v{i}"]) for r in others if int(r[f"c{i}"]) > 0]
                cnt = sum(p[0] for p in parts)
                if cnt == 0:
                    moments[c] = (0, None, 0.0)
                    continue
                mu = sum(p[0] * p[1] for p in parts) / cnt
                m2 = sum(p[0] * p[2] + p[0] * (p[1] - mu) ** 2 for p in parts)
                moments[c] = (cnt, mu, m2)
            medians = None
            if self.g(self.numStrategy) == "median":
                rows = dataset if j is None else dataset.where(F.col(fold_col) != j)
                medians = exact_medians(rows.where(F.col(fold_col).isNotNull()), nums)
            models.append(self._model_from(n, moments, counts, medians))
        return models


class TabularPreprocessorModel(Model, _PreParams, DefaultParamsReadable, DefaultParamsWritable):
    numFill = Param(Params._dummy(), "numFill", "numeric fill values", TypeConverters.toListFloat)
    numMean = Param(Params._dummy(), "numMean", "means of the imputed columns", TypeConverters.toListFloat)
    numScale = Param(Params._dummy(), "numScale", "population sigma (1 if constant)", TypeConverters.toListFloat)
    catFill = Param(Params._dummy(), "catFill", "categorical fill values", TypeConverters.toListString)
    catFilled = Param(Params._dummy(), "catFilled", "1 where catFill applies", TypeConverters.toListInt)
    catLevels = Param(Params._dummy(), "catLevels", "JSON: column -> sorted levels", TypeConverters.toString)
    fitWarnings = Param(Params._dummy(), "fitWarnings", "messages from fitting", TypeConverters.toListString)

    def __init__(self):
        super().__init__()
        self._defaults()
        self._setDefault(numFill=[], numMean=[], numScale=[], catFill=[], catFilled=[], catLevels="{}", fitWarnings=[])

    def g(self, p):
        return self.getOrDefault(p)

    def levels(self) -> dict[str, list[str]]:
        return json.loads(self.g(self.catLevels))

    def feature_names(self) -> list[str]:
        """Output features in order, all different: levels whose names coincide get a running number."""
        names = list(self.g(self.numCols))
        lv = self.levels()
        for c in self.g(self.catCols):
            if self.g(self.oneHot):
                names += unique_names([level_name(c, v) for v in lv[c][1:]], names)
            else:
                names.append(c)
        return names

    def feature_keys(self) -> list[tuple]:
        """What every output feature is made from, in assembly order: equal keys give equal values (but for unseen levels)."""
        how = self.g(self.numStrategy), self.g(self.scale)
        keys: list[tuple] = [("number", *k, *how) for k in zip(self.g(self.numCols), self.g(self.numFill), self.g(self.numMean), self.g(self.numScale))]
        lv = self.levels()
        for c, f, on in zip(self.g(self.catCols), self.g(self.catFill), self.g(self.catFilled)):
            fill = f if self.g(self.catStrategy) != "none" and on else None
            keys += [("is", c, fill, level) for level in lv[c][1:]] if self.g(self.oneHot) else [("level", c, fill)]
        return keys

    def feature_columns(self) -> dict[str, Column]:
        """Name -> expression of every output feature, in assembly order."""
        exprs: list[Column] = []
        strategy = self.g(self.numStrategy)
        for c, f, m, s in zip(self.g(self.numCols), self.g(self.numFill), self.g(self.numMean), self.g(self.numScale)):
            x = nan_to_null(F.col(c).cast("double"))
            if strategy != "none":
                x = F.coalesce(x, F.lit(f))
            if self.g(self.scale):
                x = (x - F.lit(m)) / F.lit(s)
            exprs.append(x)
        lv = self.levels()
        bare: list[tuple[Column, Column]] = []  # checks of columns without a feature of their own
        for c, f, on in zip(self.g(self.catCols), self.g(self.catFill), self.g(self.catFilled)):
            v = F.col(c).cast("string")
            if self.g(self.catStrategy) != "none" and on:
                v = F.coalesce(v, F.lit(f))
            if not self.g(self.oneHot):
                exprs.append(v)
                continue
            levels = lv[c]
            known = F.coalesce(v.isin(levels), F.lit(False)) if levels else F.lit(False)
            message = F.concat(F.lit(f"unseen level in '{c}': "), F.coalesce(v, F.lit("NULL")))
            if self.g(self.handleInvalid) == "error" and len(levels) < 2:
                bare.append((known, message))
            for i, level in enumerate(levels[1:]):
                hit = F.when(v == F.lit(level), F.lit(1.0)).otherwise(F.lit(0.0))
                if self.g(self.handleInvalid) == "error" and i == 0:
                    hit = F.when(known, hit).otherwise(F.raise_error(message))
                exprs.append(hit)
        for known, message in bare:
            if exprs:
                exprs[0] = F.when(known, exprs[0]).otherwise(F.raise_error(message))
        return dict(zip(self.feature_names(), exprs))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.feature_columns()
        if self.g(self.outputMode) == "columns":
            drop = [c for c in self.g(self.catCols) if self.g(self.oneHot)]
            return dataset.withColumns(cols).drop(*drop)
        names = list(cols)
        meta = {"ml_attr": {"num_attrs": len(names),
                            "attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]}}}
        vec = array_to_vector(F.array(*[cols[n].cast("double") for n in names]))
        return dataset.withColumn(self.g(self.outputCol), vec.alias(self.g(self.outputCol), metadata=meta))
