"""Randomised properties (hypothesis): the distributed exact operators equal brute force on small random frames,
with tiny buckets forced so that the bucketed and sketch-bracketed paths run."""

import itertools
import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kestrel.operators.metrics import roc_auc
from kestrel.operators.quantiles import exact_medians
from kestrel.operators.splits import rank_within_class

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg)) / (len(pos) * len(neg))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12)), min_size=4, max_size=120))
def test_auc_matches_brute_force(spark, rows):
    if len({y for y, _ in rows}) < 2:
        return
    df = spark.createDataFrame([(y, s / 4.0) for y, s in rows], "y int, s double")
    got = roc_auc(df, "y", "s", rows_per_bucket=3).first()[0]
    assert math.isclose(got, brute_auc([(y, s / 4.0) for y, s in rows]), rel_tol=1e-12)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=150))
def test_median_matches_numpy(spark, values):
    df = spark.createDataFrame([(i, None if v is None else v / 3.0) for i, v in enumerate(values)], "id long, x double")
    got = exact_medians(df, ["x"], rows_per_bucket=4)["x"]
    present = [v / 3.0 for v in values if v is not None]
    if not present:
        assert got is None
    else:
        assert math.isclose(got, float(np.median(present)), rel_tol=1e-12, abs_tol=1e-12)


@SETTINGS
@given(st.lists(st.integers(0, 2), min_size=1, max_size=200))
def test_ranks_are_a_permutation_per_class(spark, labels):
    df = spark.createDataFrame(list(enumerate(labels)), "id long, y int")
    ranks = rank_within_class(df, "y", "id", 7, rows_per_bucket=5).collect()
    by_class = {}
    for r in ranks:
        by_class.setdefault(r.y, []).append(r["rank"])
    for y, rs in by_class.items():
        assert sorted(rs) == list(range(1, labels.count(y) + 1))
