"""Embedding near-dedup against brute force; recall of the graph; awkward vectors."""

import math

import numpy as np
import pytest

from kestrel.llm import nn_descent
from kestrel.llm.common import checkpointed
from kestrel.llm.queries import op2_embedding_near_dedup


def brute(rows, threshold=0.98):
    """rows: (vec_id, vector, label) -> {vec_id: (n_links, component_id)}"""
    vecs = {}
    for i, v, l in rows:
        if i is not None:
            key = (l is not None, "" if l is None else str(l), v is not None, [] if v is None else [(x is not None, 0 if x is None else x) for x in v])
            if i not in vecs or key < vecs[i][0]:
                vecs[i] = (key, v, l)
    good = {}
    for i, (_, v, l) in vecs.items():
        if l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, float) / np.abs(v).max()
            good.setdefault((l, len(v)), []).append((i, x / np.linalg.norm(x)))
    out = {i: (0, i) for i in vecs}
    for members in good.values():
        ids = np.array([i for i, _ in members])
        x = np.array([x for _, x in members])
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        group = ids.copy()
        while True:
            new = np.minimum(group, np.where(linked, group[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (new == group).all():
                break
            group = new
        out |= {int(i): (int(n), int(g)) for i, n, g in zip(ids, linked.sum(axis=1), group)}
    return out


def _run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, l, "x") for i, v, l in rows], "vec_id long, embedding array<float>, label int, kept string").repartition(4)
    got = nn_descent.near_duplicates(df, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return {r.vec_id: (r.n_links, r.component_id) for r in got}, len(got)


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(7)
    rows = []

    def add(x, label):
        rows.append((len(rows), [float(np.float32(v)) for v in x], label))

    for _ in range(900):
        add(rng.normal(size=16), int(rng.integers(3)))
    for size, noise in ((260, 0.02), (60, 0.03), (25, 0.04), (2, 0.01), (2, 0.01), (3, 0.02)):
        center, label = rng.normal(size=16), int(rng.integers(3))
        for _ in range(size):
            add(center + noise * rng.normal(size=16), label)
    chain = rng.normal(size=16)
    for _ in range(30):  # neighbours linked, ends far apart
        chain = chain + 0.13 * rng.normal(size=16)
        add(chain, 1)
    copy = [float(np.float32(v)) for v in rng.normal(size=16)]
    for label in [0] * 40 + [1] * 5 + [None] * 3:
        rows.append((len(rows), copy, label))
    return rows


def test_planted_groups_equal_brute_force(spark, planted):
    want = brute(planted)
    got, n = _run(spark, planted, block=100)
    assert n == len(want) and got == want


def test_short_lists_are_enlarged_and_recall_is_audited(spark, planted):
    got, _ = _run(spark, planted, k=4, k_max=8, trees=1, window=32, cell=64)
    want = brute(planted)
    assert sum(min(got[i][0], want[i][0]) for i in want) >= 0.95 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)


def test_awkward_vectors(spark):
    v = [1.0, 2.0]
    rows = [(1, v, 0), (2, [2.0, 4.0], 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0], 0), (6, [math.nan, 1.0], 0), (7, [math.inf, 1.0], 0),
            (8, [None, 1.0], 0), (9, v, None), (10, v, 1), (11, [1.0, 2.0, 0.0], 0), (None, v, 0), (12, v, 0), (12, v, 0), (13, [-1.0, -2.0], 0),
            (14, [1e-30, 2e-30], 0), (15, [1e30, 2e30], 0), (16, [-0.0, 1.0], 0), (17, [0.0, 1.0], 0)]
    got, n = _run(spark, rows)
    assert got == brute(rows) and n == 17


def test_empty_table(spark):
    assert _run(spark, [])[1] == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert {r.vec_id: (r.n_links, r.component_id) for r in op2_embedding_near_dedup(spark, sf).collect()} == brute(rows)


def test_rounds_go_on_while_lists_change(spark):
    x = np.random.default_rng(3).normal(size=(600, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, "g", v.tolist()) for i, v in enumerate(x)], "rep bigint, grp string, x array<double>")
    points = checkpointed(nn_descent.prepare(df, 3, 0, 3))
    graph = nn_descent.neighbour_graph(points, 3, 10, 10, 2.0, window=8)  # no pair is a link
    got = {(r.u, r.v) for r in graph.collect()}
    s = x @ x.T
    np.fill_diagonal(s, -2)
    want = {(u, int(v)) for u, row in enumerate(np.argsort(-s, axis=1)[:, :10]) for v in row}
    assert len(got & want) >= 0.95 * len(want), len(got & want)


def test_trees_grow_with_cells():
    for bits in (0, 7, 16, 25, 30):
        trees = nn_descent.start_trees(bits, nn_descent.TREES, 0.98)
        same = (1 - math.acos(0.98) / math.pi) ** bits
        assert trees >= nn_descent.TREES and (1 - same) ** trees <= nn_descent.START_MISS


def test_audit_sees_lost_pairs_beside_a_hot_group(spark):
    rng = np.random.default_rng(5)
    hot, pairs = rng.normal(size=32), rng.normal(size=(20, 32))
    x = [hot + 0.01 * rng.normal(size=32) for _ in range(300)] + [p + 0.01 * rng.normal(size=32) for p in pairs for _ in range(2)]
    df = spark.createDataFrame([(i, "g", v.tolist()) for i, v in enumerate(x)], "rep bigint, grp string, x array<double>")
    points = checkpointed(nn_descent.prepare(df, 1, 0, 1))
    every = spark.createDataFrame([(i, 299 if i < 300 else 1) for i in range(340)], "rep bigint, near bigint")
    assert nn_descent.audit(points, every, 0.98) == 1.0
    assert nn_descent.audit(points, every.where("near > 1"), 0.98) == 0.0


def test_missed_target_raises_on_the_last_try(spark, planted, monkeypatch):
    monkeypatch.setattr(nn_descent, "audit", lambda *a: 0.5)
    with pytest.raises(RuntimeError):
        _run(spark, planted[:100], tries=1)
