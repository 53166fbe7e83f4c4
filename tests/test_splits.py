"""Splits: bucketed ranks equal the plain window; folds disjoint, complete and stratified; class-size guard."""

import logging
import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.functions.columns import md5_key
from kestrel.operators.splits import kfold, min_class_size, rank_within_class, stratified_split, warn_if_small


def _frame(spark, n=3000):
    return spark.range(n).withColumn("y", (F.col("id") % 3 == 0).cast("int"))


def test_bucketed_rank_equals_plain_window(spark):
    df = _frame(spark)
    fast = rank_within_class(df, "y", "id", 42, rows_per_bucket=50)  # forces many buckets
    w = Window.partitionBy("y").orderBy(md5_key("id", 42), "id")
    plain = df.withColumn("rank", F.row_number().over(w))
    diff = fast.join(plain.withColumnRenamed("rank", "r2"), ["id", "y"]).where(F.col("rank") != F.col("r2"))
    assert diff.count() == 0


def test_holdout_and_folds(spark):
    df = _frame(spark)
    s = stratified_split(df, "y", "id", 0.2, 5, 42, rows_per_bucket=100)
    counts = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    n1, n0 = 1000, 2000
    assert counts[(1, "test")] == math.ceil(0.2 * n1) and counts[(0, "test")] == math.ceil(0.2 * n0)
    tv = s.where(F.col("split") == "trainval")
    assert s.where((F.col("split") == "test") & F.col("fold").isNotNull()).count() == 0
    per = tv.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in per if r.y == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert tv.count() == tv.select("id").distinct().count() == 3000 - 600


def test_split_is_deterministic(spark):
    df = _frame(spark, 500)
    a = stratified_split(df, "y", "id", 0.2, 5, 42).orderBy("id").collect()
    b = stratified_split(df.repartition(7), "y", "id", 0.2, 5, 42).orderBy("id").collect()
    assert a == b


def test_cv_scope_all_numbers_every_row(spark):
    s = stratified_split(_frame(spark, 600), "y", "id", 0.2, 5, 42, cv_scope="all")
    assert s.where(F.col("fold").isNull()).count() == 0


def test_kfold_stratified(spark):
    f = kfold(_frame(spark, 1000), 4, "y", "id", "s")
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) - min(sizes) <= 2


def test_small_class_guard(spark, caplog):
    # strata frame: a class of 4 rows with k = 5 -> warning and flag
    df = spark.createDataFrame([(i, 1 if i < 4 else 0) for i in range(40)], "id long, y int")
    assert min_class_size(df, "y", 5).first() == (4, 5, 1)
    with caplog.at_level(logging.WARNING):
        assert warn_if_small(df, "y", 5) == 4
    assert "fewer than the 5 folds" in caplog.text
