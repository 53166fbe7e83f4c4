"""Classifiers (C1-C8) as pyspark.ml estimators over a ``features`` vector and a double ``label``.

Mostly built-ins with the reference's settings translated:
  * logistic regression, L2 or L1, inverse strength C: the per-row objective is divided by C*n, so
    ``regParam = 1 / (C * n)`` with n counted at fit time (per fold), ``standardization=False``;
  * Gaussian naive Bayes: ``NaiveBayes(modelType='gaussian')`` (variance smoothing 1e-9 * max variance);
  * the leaf-wise booster (100 trees, rate 0.1, 31 leaves, 20 rows a leaf at least) and the fixed booster of symmetric
    trees (1000 x 0.05 x depth 6, leaf penalty 3) on binned rows: ``histogram_booster.HistogramBooster``;
  * MLP (100, 50): ``MultilayerPerceptronClassifier``; the input width is read from the vector's attributes.
    Hidden units are sigmoid and the solver is l-bfgs (Spark offers no relu/adam): a documented parity limit;
  * RBF SVM with probabilities, re-aimed: random Fourier features (Rahimi & Recht, 2007; gamma = 1 / (d * Var X))
    -> ``LinearSVC`` -> Platt scaling fitted on out-of-fold margins. Class = sign of the margin.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from kestrel.operators.histogram_booster import HistogramBooster
from kestrel.operators.persistence import CompositePersistence

SEED = 42


def vector_size(df: DataFrame, col: str = "features") -> int:
    """Width of a vector column: from its ml_attr metadata, else from one row."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    return int(df.select(col).first()[0].size)


class _Base(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "features column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "max iterations", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    def _base_defaults(self):
        self._setDefault(featuresCol="features", labelCol="label", maxIter=100, seed=SEED)

    def g(self, p):
        return self.getOrDefault(p)


class ScaledLogisticRegression(Estimator, _Base, DefaultParamsReadable, DefaultParamsWritable):
    """Logistic regression parameterised by inverse strength C and penalty 'l2' | 'l1'."""

    C = Param(Params._dummy(), "C", "inverse regularisation strength", TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "l2 | l1", TypeConverters.toString)
    tol = Param(Params._dummy(), "tol", "convergence tolerance", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, C=1.0, penalty="l2", maxIter=1000, tol=1e-6, featuresCol="features", labelCol="label",
                 seed=SEED):
        super().__init__()
        self._base_defaults()
        self._setDefault(C=1.0, penalty="l2", tol=1e-6)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        n = dataset.count()
        lr = LogisticRegression(
            featuresCol=self.g(self.featuresCol), labelCol=self.g(self.labelCol), maxIter=self.g(self.maxIter),
            tol=self.g(self.tol), regParam=1.0 / (self.g(self.C) * max(n, 1)),
            elasticNetParam=1.0 if self.g(self.penalty) == "l1" else 0.0, standardization=False,
        )
        return lr.fit(dataset)


class MLP(Estimator, _Base, DefaultParamsReadable, DefaultParamsWritable):
    hidden = Param(Params._dummy(), "hidden", "hidden layer sizes", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, hidden=(100, 50), maxIter=800, seed=SEED, featuresCol="features", labelCol="label"):
        super().__init__()
        self._base_defaults()
        self._setDefault(hidden=[100, 50])
        kw = dict(self._input_kwargs)
        if "hidden" in kw:
            kw["hidden"] = list(kw["hidden"])
        self._set(**kw)

    def _fit(self, dataset: DataFrame):
        d = vector_size(dataset, self.g(self.featuresCol))
        return MultilayerPerceptronClassifier(
            featuresCol=self.g(self.featuresCol), labelCol=self.g(self.labelCol),
            layers=[d, *self.g(self.hidden), 2], maxIter=self.g(self.maxIter), seed=self.g(self.seed),
            blockSize=128, solver="l-bfgs",
        ).fit(dataset)


# ---- RBF kernel approximation ----------------------------------------------------------------------------------
def _rff_udf(weights: np.ndarray, offsets: np.ndarray):
    scale = math.sqrt(2.0 / weights.shape[1])

    @F.pandas_udf(ArrayType(DoubleType()))
    def rff(x: pd.Series) -> pd.Series:
        if len(x) == 0:
            return pd.Series([], dtype=object)
        z = np.cos(np.vstack(x.to_numpy()) @ weights + offsets) * scale
        return pd.Series(list(z))

    return rff


class FourierFeaturesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    inputCol = Param(Params._dummy(), "inputCol", "input vector", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output vector", TypeConverters.toString)
    weights = Param(Params._dummy(), "weights", "d x D projection, row-major", TypeConverters.toListFloat)
    offsets = Param(Params._dummy(), "offsets", "D phase offsets", TypeConverters.toListFloat)
    dim = Param(Params._dummy(), "dim", "input width d", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="rff", weights=[], offsets=[], dim=0)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        d = self.getOrDefault(self.dim)
        w = np.asarray(self.getOrDefault(self.weights)).reshape(d, -1)
        b = np.asarray(self.getOrDefault(self.offsets))
        udf = _rff_udf(w, b)
        x = vector_to_array(F.col(self.getOrDefault(self.inputCol)))
        return dataset.withColumn(self.getOrDefault(self.outputCol), array_to_vector(udf(x)))


def fit_fourier(df: DataFrame, input_col: str, output_col: str, n_components: int, gamma: float | None,
                seed: int) -> FourierFeaturesModel:
    d = vector_size(df, input_col)
    if gamma is None:  # 'scale': 1 / (d * variance of all matrix entries), one aggregate pass
        arr = vector_to_array(F.col(input_col))
        s = df.select(
            F.aggregate(arr, F.lit(0.0), lambda a, v: a + v).alias("s"),
            F.aggregate(arr, F.lit(0.0), lambda a, v: a + v * v).alias("ss"),
        ).agg(F.sum("s"), F.sum("ss"), F.count("*")).first()
        n = s[2] * d
        var = s[1] / n - (s[0] / n) ** 2
        gamma = 1.0 / (d * var) if var > 0 else 1.0
    rng = np.random.RandomState(seed)
    w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(d, n_components))
    b = rng.uniform(0.0, 2.0 * math.pi, size=n_components)
    m = FourierFeaturesModel()
    m._set(inputCol=input_col, outputCol=output_col, weights=w.ravel().tolist(), offsets=b.tolist(), dim=d)
    return m


class CalibratedRBFSVM(Estimator, _Base, DefaultParamsReadable, DefaultParamsWritable):
    C = Param(Params._dummy(), "C", "inverse regularisation strength", TypeConverters.toFloat)
    nComponents = Param(Params._dummy(), "nComponents", "random Fourier features", TypeConverters.toInt)
    calibrationFolds = Param(Params._dummy(), "calibrationFolds", "folds for Platt scaling", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "row id for deterministic folds", TypeConverters.toString)

    @keyword_only
    def __init__(self, C=1.0, nComponents=200, calibrationFolds=5, maxIter=100, seed=SEED, idCol="id",
                 featuresCol="features", labelCol="label"):
        super().__init__()
        self._base_defaults()
        self._setDefault(C=1.0, nComponents=200, calibrationFolds=5, idCol="id")
        self._set(**self._input_kwargs)

    def _svm(self, n: int) -> LinearSVC:
        return LinearSVC(featuresCol="__rff", labelCol=self.g(self.labelCol), maxIter=self.g(self.maxIter),
                         regParam=1.0 / (self.g(self.C) * max(n, 1)), standardization=False)

    def _fit(self, dataset: DataFrame):
        from kestrel.operators.splits import kfold

        from kestrel.session import fit_frame

        rff = fit_fourier(dataset, self.g(self.featuresCol), "__rff", self.g(self.nComponents), None, self.g(self.seed))
        k = self.g(self.calibrationFolds)
        label = self.g(self.labelCol)
        # the projected features are computed once and reused by every SVM iteration and fold
        folded_cached, folded, n_all = fit_frame(kfold(rff.transform(dataset).withColumn("__y", F.col(label).cast("int")),
                                                       k, "__y", self.g(self.idCol), "platt"))
        z = folded
        oof = None
        for j in range(k):
            tr, va = folded.where(F.col("fold") != j), folded.where(F.col("fold") == j)
            m = self._svm(tr.count()).fit(tr)
            part = m.transform(va).select(label, vector_to_array("rawPrediction")[1].alias("margin"))
            oof = part if oof is None else oof.unionByName(part)
        platt = LogisticRegression(featuresCol="__m", labelCol=label, regParam=0.0).fit(
            oof.withColumn("__m", array_to_vector(F.array("margin")))
        )
        svm = self._svm(n_all).fit(z)
        folded_cached.unpersist()
        out = CalibratedRBFSVMModel()
        out._set(featuresCol=self.g(self.featuresCol))
        out.rff, out.svm = rff, svm
        out._set(plattA=float(platt.coefficients[0]), plattB=float(platt.intercept))
        return out


class CalibratedRBFSVMModel(CompositePersistence, Model, _Base):
    plattA = Param(Params._dummy(), "plattA", "Platt slope", TypeConverters.toFloat)
    plattB = Param(Params._dummy(), "plattB", "Platt intercept", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._base_defaults()
        self._setDefault(plattA=1.0, plattB=0.0)
        self.rff = None
        self.svm = None

    def _children(self):
        return {"rff": self.rff, "svm": self.svm}

    def _state(self):
        return {}

    @classmethod
    def _restore(cls, state, children):
        m = cls()
        m.rff, m.svm = children["rff"], children["svm"]
        return m

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = self.svm.transform(self.rff.transform(dataset))
        margin = vector_to_array("rawPrediction")[1]
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.g(self.plattA)) * margin + F.lit(self.g(self.plattB)))))
        return scored.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p))).drop("__rff")


# ---- factories with the reference's settings ---------------------------------------------------------------------
def logistic(C: float = 1.0, max_iter: int = 1000, penalty: str = "l2") -> ScaledLogisticRegression:
    return ScaledLogisticRegression(C=C, penalty=penalty, maxIter=max_iter)


def gaussian_nb() -> NaiveBayes:
    return NaiveBayes(modelType="gaussian", featuresCol="features", labelCol="label")


def gbt_leafwise(max_iter: int = 100, seed: int = SEED) -> HistogramBooster:
    return HistogramBooster(growth="leaf", maxIter=max_iter, stepSize=0.1, numLeaves=31, minRows=20, seed=seed)


def gbt_fixed(iterations: int = 1000, learning_rate: float = 0.05, depth: int = 6, seed: int = SEED) -> HistogramBooster:
    return HistogramBooster(growth="level", maxIter=iterations, stepSize=learning_rate, maxDepth=depth, l2=3.0, borderCount=254,
                            baggingTemperature=1.0, randomStrength=1.0, seed=seed)


def mlp(hidden=(100, 50), max_iter: int = 800, seed: int = SEED) -> MLP:
    return MLP(hidden=hidden, maxIter=max_iter, seed=seed)


def rbf_svm(C: float = 1.0, n_components: int = 200, seed: int = SEED) -> CalibratedRBFSVM:
    return CalibratedRBFSVM(C=C, nComponents=n_components, seed=seed)
