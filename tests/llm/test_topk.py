"""Exact top-k against brute force: ties, signs, awkward vectors, many shards and query blocks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import topk


def brute(rows, k, scale=1024):
    vecs = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) or abs(x * scale) >= 2**53 for x in v):
            continue
        q = [math.floor(x * scale) for x in v]
        vecs[i] = min(vecs.get(i, q), q)
    out = []
    for q, a in vecs.items():
        if q % 100:
            continue
        found = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i) for i, b in vecs.items() if i != q and len(a) == len(b))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def _run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string").repartition(5)
    return sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0, **options).collect())


@pytest.mark.parametrize("kind", ["normal", "ties", "negative", "sparse"])
def test_equals_brute_force(spark, kind):
    rnd = random.Random(kind)
    draw = {
        "normal": lambda: rnd.gauss(0, 0.2), "ties": lambda: rnd.choice([-1, 0, 1]) / 1024,
        "negative": lambda: rnd.random() if rnd.random() < 0.5 else -5.0, "sparse": lambda: rnd.choice([0.0] * 9 + [rnd.random()]),
    }[kind]
    rows = [(i, [draw() for _ in range(12)]) for i in range(900)]
    assert _run(spark, rows, query_bytes=3 * 12 * 8) == brute(rows, 10)


def test_awkward_vectors(spark):
    v = [0.1, -0.2, 0.3]
    rows = [(0, v), (1, v), (2, v), (2, v), (100, None), (200, []), (300, [0.1, None, 0.2]), (400, [math.nan, 1.0, 1.0]),
            (500, [math.inf, 0.0, 0.0]), (600, [0.5, 0.5]), (601, [0.25, 0.5]), (700, [1e300, 0.0, 0.0]), (None, v),
            (3, [1e9, 1e9, 1e9]), (800, [1e9, -1e9, 3.0]), (4, [4e12, 1.0, 1.0]), (5, [0.0, 0.0, 0.0]), (6, [1.0, 2.0, 3.0]), (6, [0.0, 9.0, 9.0]),
            (900, [1.0, 1.0, 1.0, 1.0])]
    assert _run(spark, rows) == brute(rows, 10)


def test_empty_and_no_query(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_max_score_skips_work_and_stays_exact():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 64))
    vectors = np.floor(1024 * (base[rng.integers(0, 40, 4000)] + 0.05 * rng.normal(size=(4000, 64))) / 8)
    shard = topk.Shard(np.arange(4000), vectors)
    q = vectors[7]
    full = vectors @ q
    full[7] = -np.inf
    order = np.lexsort((np.arange(4000), -full))[:10]
    stats = {}
    ids, scores = topk.max_score(shard, q, 7, 10, full[order[-1]], stats)
    merged = np.lexsort((ids, -scores))[:10]
    assert ids[merged].tolist() == order.tolist() and scores[merged].tolist() == full[order].tolist()
    assert stats["products"] < 0.6 * 64 * 4000
