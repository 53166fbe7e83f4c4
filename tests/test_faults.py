"""Ordinary inputs that used to lose data or fail: names in any script, missing labels and scores, NULL levels, columns
without values, many checkpoints, other id columns, models by path, restarted streams."""

import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from kestrel.operators import models as L
from kestrel.operators.metrics import accuracy_f1, classification_metrics, roc_auc
from kestrel.operators.preprocess import TabularPreprocessor
from kestrel.operators.splits import stratified_split
from kestrel.operators.target_encoding import OrderedTargetEncoder, OrderedTargetEncoderModel
from kestrel.session import checkpoint_dir, cut_lineage


def test_one_hot_keeps_levels_of_any_script(spark):
    levels = ["월요일", "화요일", "수요일", "a b", "a-b", "a_b", "", "!", "é"]
    df = spark.createDataFrame([(i, levels[i % len(levels)], "a b"[i % 3 : i % 3 + 1]) for i in range(36)], "id long, c string, c_a string")
    model = TabularPreprocessor(catCols=["c", "c_a"]).fit(df)
    names = model.feature_names()
    assert len(names) == len(set(names)) == len(levels) - 1 + 2
    out = model.transform(df).select("c", "features").collect()
    assert all(len(r.features) == len(names) for r in out)
    seen = {r.c: tuple(r.features.toArray()[: len(levels) - 1]) for r in out}
    assert len(set(seen.values())) == len(levels) and all(sum(v) in (0, 1) for v in seen.values())


def test_unseen_level_raises_whatever_the_number_of_levels(spark):
    for levels in (["a"], ["a", "b"], ["a", "b", "c"]):
        train = spark.createDataFrame([(float(i), v) for i, v in enumerate(levels)], "x double, c string")
        model = TabularPreprocessor(numCols=["x"], catCols=["c"]).fit(train)
        assert model.transform(train).count() == len(levels)
        with pytest.raises(Exception, match="unseen level"):
            model.transform(spark.createDataFrame([(1.0, "new")], "x double, c string")).collect()


def test_empty_string_can_be_the_mode(spark):
    df = spark.createDataFrame([("",), ("",), ("b",), (None,)], "c string")
    model = TabularPreprocessor(catCols=["c"], oneHot=False, outputMode="columns").fit(df)
    assert sorted(r.c for r in model.transform(df).collect()) == ["", "", "", "b"]


def test_levels_are_bounded_only_where_they_become_columns(spark):
    df = spark.range(300).select("id", F.col("id").cast("string").alias("c"), (F.col("id") % 3).cast("int").alias("fold"))
    for strategy in ("constant", "mode"):
        pre = TabularPreprocessor(catCols=["c"], oneHot=False, catStrategy=strategy, outputMode="columns", maxLevels=10)
        assert pre.fit(df).transform(df).count() == 300
        assert len(pre.fit_folds(df, "fold", 3, include_all=True)) == 4
    with pytest.raises(ValueError, match="300 levels"):
        TabularPreprocessor(catCols=["c"], maxLevels=10).fit(df)


def test_fold_modes_equal_separate_fits(spark):
    df = spark.range(200).select((F.col("id") % 5).cast("int").alias("fold"), F.when(F.col("id") % 7 > 0, F.col("id") * 13 % 6).cast("string").alias("c"))
    pre = TabularPreprocessor(catCols=["c"], oneHot=False)
    for j, m in enumerate(pre.fit_folds(df, "fold", 5)):
        alone = pre.fit(df.where(F.col("fold") != j))
        assert m.getOrDefault(m.catFill) == alone.getOrDefault(alone.catFill)


def test_missing_labels_and_scores_raise_with_their_number(spark):
    df = spark.createDataFrame([(i, None if i < 10 else i % 2) for i in range(100)], "id long, y int")
    with pytest.raises(ValueError, match="10 rows"):
        stratified_split(df, "y", "id")
    rows = [(1, 1, 0.9), (0, 0, 0.1), (None, 1, 0.5), (1, None, 0.5)]
    df = spark.createDataFrame(rows, "y int, prediction int, y_prob double")
    with pytest.raises(Exception, match="2 rows have a NULL"):
        accuracy_f1(df).collect()
    with pytest.raises(ValueError, match="1 rows"):
        classification_metrics(df, "y").collect()
    for bad in (None, math.nan):
        with pytest.raises(ValueError, match="1 rows"):
            roc_auc(spark.createDataFrame([(1, 0.9), (0, 0.1), (0, bad)], "y int, score double"))


def test_split_shuffles_no_rows(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"), F.lit("wide").alias("payload"))
    plan = stratified_split(df, "y", "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan and "Window" not in plan


def test_encoder_tells_null_from_the_word_and_reads_booleans(spark, tmp_path):
    rows = [(None, True, 1), (None, True, 1), ("None", False, 0), ("x", False, 1), ("x", True, 0)]
    df = spark.createDataFrame(rows, "c string, b boolean, y int")
    model = OrderedTargetEncoder(catCols=["c", "b"], labelCol="y").fit(df)
    p = 0.6
    want = {None: (2 + p) / 3, "None": (0 + p) / 2, "x": (1 + p) / 3}
    PipelineModel([model]).write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert isinstance(loaded, OrderedTargetEncoderModel)
    for m in (model, loaded):
        for r in m.transform(df).collect():
            assert r.c_te == pytest.approx(want[r.c])
            assert r.b_te == pytest.approx((2 + p) / 4 if r.b else (1 + p) / 3)
        new = m.transform(spark.createDataFrame([("new", None, 0)], "c string, b boolean, y int")).first()
        assert new.c_te == new.b_te == pytest.approx(p)


def test_a_column_without_values_does_not_stop_training(spark):
    from kestrel.plans.train import train_tuned

    df = spark.range(240).select("id", (F.col("id") * 7 % 11).cast("double").alias("x"), F.lit(None).cast("double").alias("empty"),
                                 (F.col("id") % 4).cast("string").alias("c"), (F.col("id") * 7 % 11 > 5).cast("int").alias("y"))
    res = train_tuned(df, ["c"], n_iter=1, k=2, search_iterations=2, final_iterations=3, patience=2)
    assert any("empty" in w for w in res.warnings)
    assert res.metrics.first().roc_auc > 0.9


def test_checkpoint_folder_stays_where_it_is(spark):
    before = checkpoint_dir(spark)
    for i in range(200):
        cut_lineage(spark.range(1), eager=i % 50 == 0)
    assert checkpoint_dir(spark) == before


def test_experiment_with_another_id_column(spark):
    from kestrel.plans.experiment import run_experiment

    df = spark.range(300).select(F.col("id").alias("key"), (F.col("id") % 10).cast("double").alias("x"), F.lit("a").alias("c"),
                                 (F.col("id") % 10 > 4).cast("int").alias("y"))
    est = L.CalibratedRBFSVM(nComponents=4, calibrationFolds=2, maxIter=3)
    assert run_experiment(df, est, ["x"], [], id_col="key", k=2).count() == 4


def test_model_is_looked_up_in_the_sessions_file_system(spark, tmp_path):
    from kestrel.sources.sinks import load_model

    with pytest.raises(FileNotFoundError):
        load_model(str(tmp_path / "nowhere"))
    PipelineModel([]).write().save(str(tmp_path / "m"))
    assert load_model(str(tmp_path / "m")).stages == []
    assert load_model(f"file://{tmp_path}/m").stages == []


def test_a_restarted_stream_goes_on_where_it_stopped(spark, tmp_path):
    from kestrel.streaming.scoring import start_scoring_stream
    from pyspark.ml.classification import LogisticRegression

    train = spark.range(50).select("id", F.col("id").cast("double").alias("x"), (F.col("id") > 20).cast("double").alias("label"))
    pre = TabularPreprocessor(numCols=["x"]).fit(train)
    model = PipelineModel([pre, LogisticRegression(maxIter=5).fit(pre.transform(train))])
    model.write().save(str(tmp_path / "model"))
    rows = train.select("id", "x")
    for part in range(2):
        rows.where(F.col("id") % 2 == part).write.mode("append").parquet(str(tmp_path / "in"))
        q = start_scoring_stream(spark, str(tmp_path / "model"), str(tmp_path / "in"), rows.schema, str(tmp_path / "out"),
                                 query_name="restart", progress_dir=str(tmp_path / "progress"))
        q.processAllAvailable()
        q.stop()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 50 and out.select("id").distinct().count() == 50
