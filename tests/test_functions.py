"""Golden micro-frames for the scalar column functions (hand-computed)."""

import math

from pyspark.sql import functions as F

from kestrel.functions import columns as C
from kestrel.functions.derive import NEWS_DERIVATIONS, derive


def test_row_max_and_std_skip_missing(spark):
    # rowstat frame: 0, 1 and 5 present values
    rows = [(1, None, None, None, None, None), (2, 0.3, None, None, None, None), (3, 1.0, 2.0, 3.0, 4.0, 5.0),
            (4, 1.0, None, 3.0, None, None)]
    df = spark.createDataFrame(rows, "id long, t0 double, t1 double, t2 double, t3 double, t4 double")
    cols = ["t0", "t1", "t2", "t3", "t4"]
    out = {r.id: (r.mx, r.sd) for r in df.select("id", C.row_max(cols).alias("mx"), C.row_std(cols).alias("sd")).collect()}
    assert out[1] == (None, None)
    assert out[2] == (0.3, None)
    assert out[3][0] == 5.0 and math.isclose(out[3][1], math.sqrt(2.5))
    assert out[4][0] == 3.0 and math.isclose(out[4][1], math.sqrt(2.0))


def test_nan_is_normalised_before_row_max(spark):
    df = spark.createDataFrame([(1, float("nan"), 2.0)], "id long, a double, b double")
    r = df.select(C.row_max([C.nan_to_null("a"), C.nan_to_null("b")]).alias("m")).first()
    assert r.m == 2.0


def test_guarded_ratio_spread_product_threshold(spark):
    df = spark.createDataFrame([(10.0, 0.0, 3.0, 1500), (None, 2.0, 1.0, 1400)], "a double, b double, c double, s long")
    r = df.select(C.guarded_ratio("a", "b").alias("r"), C.spread("a", "c").alias("sp"), C.product("b", "c").alias("p"),
                  C.threshold_label("s").alias("y")).collect()
    assert math.isclose(r[0].r, 10.0 / 1e-6) and r[0].sp == 7.0 and r[0].p == 0.0 and r[0].y == 1
    assert r[1].r is None and r[1].sp is None and r[1].p == 2.0 and r[1].y == 0


def test_r6_rounds_half_up(spark):
    df = spark.createDataFrame([(0.0000005,), (1.2345674,), (-0.0000005,)], "x double")
    assert [r[0] for r in df.select(C.r6("x")).collect()] == [0.000001, 1.234567, 0.0]


def test_guarded_derivation_warns_and_continues(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.1, 0.2)], "n_tokens_content double, num_hrefs double, "
                               "title_subjectivity double, title_sentiment_polarity double")
    out, warnings = derive(df, NEWS_DERIVATIONS)
    assert "feat_content_to_href_ratio" in out.columns and "feat_title_sentiment_strength" in out.columns
    assert "feat_lda_max_value" not in out.columns
    assert any("feat_lda_std_dev" in w for w in warnings)


def test_md5_uniform_is_deterministic_and_in_range(spark):
    df = spark.range(1000).withColumn("u", C.md5_uniform("id", "x"))
    stats = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0.0 <= stats[0] < stats[1] < 1.0 and abs(stats[2] - 0.5) < 0.05
    assert df.collect() == df.collect()


def test_fit_frame_coalesces_small_frames_and_keeps_rows(spark):
    from kestrel.session import default_parallelism, fit_frame

    df = spark.range(5000).repartition(64)
    cached, view, n = fit_frame(df, rows_per_partition=1000)
    try:
        assert n == 5000 and view.count() == 5000
        assert view.rdd.getNumPartitions() == max(default_parallelism(spark), 5)
    finally:
        cached.unpersist()
    few = spark.range(100).coalesce(2)
    cached, view, n = fit_frame(few)
    try:
        assert view.rdd.getNumPartitions() == 2 and n == 100  # never increases the partition count
    finally:
        cached.unpersist()
