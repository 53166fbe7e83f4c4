"""Metrics against hand-computed values and a brute-force AUC."""

import itertools
import math

from kestrel.functions.columns import hard_class
from kestrel.operators.metrics import accuracy_f1, classification_metrics, roc_auc


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return s / (len(pos) * len(neg))


def test_score_frame(spark):
    # score frame: ties count half; exactly 0.5 is class 0
    rows = [(1, 1, 0.9), (2, 0, 0.5), (3, 1, 0.5), (4, 0, 0.1), (5, 1, 0.5), (6, 0, 0.7)]
    df = spark.createDataFrame(rows, "id long, y int, p double").withColumn("pred", hard_class("p"))
    assert [r.pred for r in df.orderBy("id").collect()] == [1, 0, 0, 0, 0, 1]
    m = classification_metrics(df, "y", "pred", "p").first()
    assert math.isclose(m.accuracy, 3 / 6)  # rows 3, 5 (positives at 0.5) and 6 are misclassified
    assert math.isclose(m.f1, 2 * 1 / (2 * 1 + 1 + 2))
    assert math.isclose(m.roc_auc, brute_auc([(y, p) for _, y, p in rows]))
    assert math.isclose(m.composite, (m.accuracy + m.f1 + m.roc_auc) / 3)


def test_f1_zero_without_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, pred int")
    assert accuracy_f1(df, "y", "pred").first().f1 == 0.0


def test_auc_bucketed_equals_brute_force(spark):
    rows = [(i, int((i * 37) % 5 < 2), round(((i * 7919) % 1000) / 1000, 2), i % 3) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, y int, s double, g int")
    got = {r.g: r.roc_auc for r in roc_auc(df, "y", "s", ["g"], rows_per_bucket=7).collect()}
    for g in range(3):
        assert math.isclose(got[g], brute_auc([(y, s) for _, y, s, gg in rows if gg == g]), rel_tol=1e-12)


def test_auc_undefined_for_one_class(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, s double")
    assert roc_auc(df, "y", "s").first().roc_auc is None
