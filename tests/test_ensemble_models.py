"""Learners and ensembles: planted signal is learned, LR reaches its optimum, vote weights, stacking shape."""

import math

import numpy as np
from pyspark.sql import functions as F

from kestrel.functions.columns import positive_probability
from kestrel.operators import models as L
from kestrel.operators.ensemble import SoftVotingClassifier, StackingClassifier, weighted_vote
from kestrel.operators.metrics import roc_auc
from kestrel.operators.preprocess import TabularPreprocessor
from kestrel.sources.fixtures import ART_CAT, art

SF = "/root/testdata/sf0.001"
NUM = ["x1", "x2", "t0", "t1", "t2", "t3", "t4"]


def _design(spark):
    df = art(spark, SF)
    pre = TabularPreprocessor(numCols=NUM, catCols=list(ART_CAT)).fit(df)
    return pre.transform(df).withColumn("label", F.col("y").cast("double")).cache()


def test_vote_weights(spark):
    # vote frame: weights 2:1:1, 1:2, 1:1, equal; scale invariance
    df = spark.createDataFrame([(1, 0.9, 0.3, 0.0)], "id long, p1 double, p2 double, p3 double")
    cols = [F.col("p1"), F.col("p2"), F.col("p3")]
    r = df.select(weighted_vote(cols, [2, 1, 1]).alias("a"), weighted_vote(cols, [4, 2, 2]).alias("b"),
                  weighted_vote(cols[:2], [1, 2]).alias("c"), weighted_vote(cols[:2]).alias("d"),
                  weighted_vote(cols).alias("e")).first()
    assert math.isclose(r.a, 0.525) and math.isclose(r.a, r.b)
    assert math.isclose(r.c, 0.5) and math.isclose(r.d, 0.6) and math.isclose(r.e, 0.4)


def test_logistic_reaches_penalised_optimum(spark):
    d = _design(spark)
    m = L.logistic(C=1.0).fit(d)
    x = np.array([v.toArray() for v in d.select("features").toPandas()["features"]])
    y = np.array(d.select("label").toPandas()["label"])
    w, b = m.coefficients.toArray(), m.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    grad_w = x.T @ (p - y) + w  # C * sum(loss) + 0.5 ||w||^2 with C = 1
    grad_b = np.sum(p - y)
    assert np.linalg.norm(np.append(grad_w, grad_b)) < 1e-2 * len(y)
    auc = roc_auc(m.transform(d).withColumn("p", positive_probability()), "y", "p").first()[0]
    assert auc > 0.85


def test_soft_vote_and_stacking(spark):
    d = _design(spark)
    vote = SoftVotingClassifier([("lr", L.logistic(max_iter=50)), ("nb", L.gaussian_nb())], weights=[1, 2]).fit(d)
    v = vote.transform(d).withColumn("p", positive_probability())
    assert v.count() == d.count()
    assert roc_auc(v, "y", "p").first()[0] > 0.85
    stack = StackingClassifier([("lr", L.logistic(max_iter=50)), ("nb", L.gaussian_nb())], cv=3,
                               passthrough=True).fit(d)
    s = stack.transform(d).withColumn("p", positive_probability())
    assert s.select("id").distinct().count() == d.count()
    assert roc_auc(s, "y", "p").first()[0] > 0.85


def test_boosted_mlp_and_svm_learn_signal(spark):
    d = _design(spark)
    for est in (L.gbt_leafwise(max_iter=5), L.mlp(max_iter=30),
                L.CalibratedRBFSVM(nComponents=50, calibrationFolds=2, maxIter=10)):
        out = est.fit(d).transform(d).withColumn("p", positive_probability())
        assert out.where(F.col("p").isNull()).count() == 0
        assert roc_auc(out, "y", "p").first()[0] > 0.8, type(est).__name__


def test_composite_models_persist(spark, tmp_path):
    from pyspark.ml import PipelineModel

    d = _design(spark)
    vote = SoftVotingClassifier([("lr", L.logistic(max_iter=20)), ("nb", L.gaussian_nb())], weights=[2, 1]).fit(d)
    stack = StackingClassifier([("lr", L.logistic(max_iter=20)), ("nb", L.gaussian_nb())], cv=2).fit(d)
    svm = L.CalibratedRBFSVM(nComponents=20, calibrationFolds=2, maxIter=5).fit(d)
    for i, m in enumerate((vote, stack, svm)):
        path = str(tmp_path / f"m{i}")
        PipelineModel(stages=[m]).write().overwrite().save(path)
        again = PipelineModel.load(path)
        a = m.transform(d).select("id", "probability").orderBy("id").collect()
        b = again.transform(d).select("id", "probability").orderBy("id").collect()
        assert a == b


def test_stacking_out_of_fold_one_value_per_row(spark):
    d = _design(spark)
    st = StackingClassifier([("lr", L.logistic(max_iter=20)), ("nb", L.gaussian_nb())], cv=3)
    folded = st.fold(d).cache()
    oof = st.out_of_fold(folded)
    n = d.count()
    assert oof.count() == n and oof.select("id").distinct().count() == n
    assert oof.where(F.col("p_lr").isNull() | F.col("p_nb").isNull()).count() == 0
    sizes = [r["count"] for r in folded.groupBy("__fold").count().collect()]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 2
