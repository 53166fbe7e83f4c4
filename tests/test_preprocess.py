"""Imputation, scaling and one-hot against hand-computed micro-frames; fold statistics; persistence."""

import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from kestrel.operators.preprocess import TabularPreprocessor


def _impute_frame(spark):
    rows = [(1, 1.0, "b", None), (2, None, "a", None), (3, float("nan"), "b", None), (4, 4.0, "a", None),
            (5, 7.0, None, None)]
    return spark.createDataFrame(rows, "id long, x double, c string, z double")


def test_mean_imputation_nan_null_and_all_null_column(spark):
    df = _impute_frame(spark)
    m = TabularPreprocessor(numCols=["x", "z"], catCols=["c"], scale=False, oneHot=False,
                            outputMode="columns").fit(df)
    assert m.getOrDefault(m.numCols) == ["x"]  # all-NULL column dropped with a warning
    assert any("'z'" in w for w in m.getOrDefault(m.fitWarnings))
    out = {r.id: (r.x, r.c) for r in m.transform(df).collect()}
    assert out[2][0] == 4.0 and out[3][0] == 4.0  # mean of 1, 4, 7; NaN treated as missing
    assert out[5][1] == "a"  # mode tie a/b (2 each) -> smallest


def test_median_imputation_exact(spark):
    df = _impute_frame(spark)
    m = TabularPreprocessor(numCols=["x"], numStrategy="median", scale=False, outputMode="columns").fit(df)
    assert m.getOrDefault(m.numFill) == [4.0]
    df2 = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 10.0), (4, 20.0)], "id long, x double")
    m2 = TabularPreprocessor(numCols=["x"], numStrategy="median", scale=False).fit(df2)
    assert m2.getOrDefault(m2.numFill) == [6.0]


def test_constant_fill_adds_level(spark):
    df = _impute_frame(spark)
    m = TabularPreprocessor(catCols=["c"], catStrategy="constant").fit(df)
    assert m.levels()["c"] == ["a", "b", "missing"]
    assert m.feature_names() == ["c_b", "c_missing"]


def test_population_sigma_and_constant_column(spark):
    rows = [(i, float(v), 3.0) for i, v in enumerate([1, 2, 3, 4, 5, 6])]
    df = spark.createDataFrame(rows, "id long, x double, k double")
    m = TabularPreprocessor(numCols=["x", "k"], outputMode="columns").fit(df)
    out = sorted((r.id, r.x, r.k) for r in m.transform(df).collect())
    sigma = math.sqrt(sum((v - 3.5) ** 2 for v in [1, 2, 3, 4, 5, 6]) / 6)
    assert math.isclose(out[0][1], (1 - 3.5) / sigma)
    assert all(r[2] == 0.0 for r in out)


def test_one_hot_drop_first_and_unseen_level(spark):
    train = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id long, c string")
    m = TabularPreprocessor(catCols=["c"], outputMode="columns").fit(train)
    assert m.feature_names() == ["c_y", "c_z"]
    got = {r.id: (r.c_y, r.c_z) for r in m.transform(train).collect()}
    assert got == {1: (0.0, 0.0), 2: (1.0, 0.0), 3: (0.0, 1.0)}
    unseen = spark.createDataFrame([(4, "w")], "id long, c string")
    with pytest.raises(Exception, match="unseen level"):
        m.transform(unseen).collect()
    keep = TabularPreprocessor(catCols=["c"], handleInvalid="keep", outputMode="columns").fit(train)
    assert keep.transform(unseen).select("c_y", "c_z").first() == (0.0, 0.0)


def test_fold_statistics_equal_direct_fits(spark):
    rows = [(i, (i * 7919 % 101) / 3.0 if i % 9 else None, ["a", "b", "c"][i % 3] if i % 5 else None, i % 4)
            for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, c string, fold int")
    pre = TabularPreprocessor(numCols=["x"], catCols=["c"], oneHot=False)
    folds = pre.fit_folds(df, "fold", 4)
    for j, fm in enumerate(folds):
        direct = pre.fit(df.where(F.col("fold") != j))
        assert math.isclose(fm.getOrDefault(fm.numMean)[0], direct.getOrDefault(direct.numMean)[0], rel_tol=1e-12)
        assert math.isclose(fm.getOrDefault(fm.numScale)[0], direct.getOrDefault(direct.numScale)[0], rel_tol=1e-12)
        assert fm.getOrDefault(fm.catFill) == direct.getOrDefault(direct.catFill)


def test_vector_output_has_named_attributes_and_persists(spark, tmp_path):
    df = _impute_frame(spark)
    pipe = Pipeline(stages=[TabularPreprocessor(numCols=["x"], catCols=["c"])]).fit(df)
    out = pipe.transform(df)
    attrs = out.schema["features"].metadata["ml_attr"]["attrs"]["numeric"]
    assert [a["name"] for a in attrs] == ["x", "c_b"]
    path = str(tmp_path / "pre")
    pipe.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(df)
    assert [r.features.toArray().tolist() for r in out.orderBy("id").collect()] == \
        [r.features.toArray().tolist() for r in again.orderBy("id").collect()]


def test_fold_statistics_include_all_equals_full_fit(spark):
    rows = [(i, (i * 37 % 53) / 7.0 if i % 6 else None, ["u", "v"][i % 2] if i % 4 else None, i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, x double, c string, fold int")
    pre = TabularPreprocessor(numCols=["x"], catCols=["c"])
    *_, all_model = pre.fit_folds(df, "fold", 3, include_all=True)
    full = pre.fit(df)
    assert math.isclose(all_model.getOrDefault(all_model.numMean)[0], full.getOrDefault(full.numMean)[0], rel_tol=1e-12)
    assert math.isclose(all_model.getOrDefault(all_model.numScale)[0], full.getOrDefault(full.numScale)[0], rel_tol=1e-12)
    assert all_model.levels() == full.levels() and all_model.getOrDefault(all_model.catFill) == full.getOrDefault(full.catFill)
