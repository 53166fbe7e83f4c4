"""Exact median and ordered target statistics: bucketed plans equal the direct computation."""

import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.functions.columns import md5_key
from kestrel.operators.quantiles import exact_medians
from kestrel.operators.target_encoding import OrderedTargetEncoder, ordered_target_encode


def test_exact_median_bucketed(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.choice([None, rnd.random() * 100, 5.0]), float(i % 2)) for i in range(1001)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    got = exact_medians(df, ["a", "b"], rows_per_bucket=40)
    exp = df.agg(F.median("a"), F.median("b")).first()
    assert math.isclose(got["a"], exp[0]) and math.isclose(got["b"], exp[1])


def test_ordered_target_mean_matches_plain_window(spark):
    rows = [(i, ["hot", "hot", "hot", "a", "b"][i % 5], int(i * 31 % 7 < 3)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, c string, y int")
    fast = ordered_target_encode(df, ["c"], "y", "id", seed="cb", rows_per_bucket=30)
    p = df.agg(F.avg("y")).first()[0]
    w = Window.partitionBy("c").orderBy(md5_key("id", "cb"), "id").rowsBetween(Window.unboundedPreceding, -1)
    plain = df.select("id", ((F.coalesce(F.sum("y").over(w), F.lit(0)) + p) /
                             (F.coalesce(F.count("*").over(w), F.lit(0)) + 1.0)).alias("e"))
    bad = fast.join(plain, "id").where(F.abs(F.col("c_te") - F.col("e")) > 1e-12).count()
    assert bad == 0


def test_scoring_encoder_uses_full_statistics(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 0), (3, "b", 1)], "id long, c string, y int")
    m = OrderedTargetEncoder(catCols=["c"], labelCol="y").fit(df)
    p = 2 / 3
    got = {r.c: r.c_te for r in m.transform(df).collect()}
    assert math.isclose(got["a"], (1 + p) / 3) and math.isclose(got["b"], (1 + p) / 2)


def test_exact_median_band_selection_continuous_and_heavy(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.gauss(0, 1), 3.0 if i % 3 else rnd.random(), None if i % 5 == 0 else float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, g double, h double, k double")
    for rpb in (50, 500, 1 << 20):
        got = exact_medians(df, ["g", "h", "k"], rows_per_bucket=rpb)
        exp = df.agg(F.median("g"), F.median("h"), F.median("k")).first()
        assert math.isclose(got["g"], exp[0]) and math.isclose(got["h"], exp[1]) and math.isclose(got["k"], exp[2])
