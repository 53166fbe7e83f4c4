"""Own boosters: equal to plain split-by-split growth, folds together equal folds alone, early stopping equals the full curve,
every setting acts, models persist, partial sums merge in any grouping, borders keep their rank."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from kestrel.operators import binning as N
from kestrel.operators import boosting as B
from kestrel.operators.histogram_booster import HistogramBooster, binned_trees, tree_margins
from kestrel.operators.target_encoding import (
    chosen_combinations, combination_gains, ordered_target_encode, ordered_target_encode_folds, ordered_target_permutations,
)
from kestrel.plans.experiment import shared_columns

D = 4


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 900
    x = rng.normal(size=(n, D)).round(2)
    x[:, 3] = rng.integers(0, 3, n)
    x[rng.random((n, D)) < 0.05] = np.nan
    z = np.nan_to_num(x)
    y = (z[:, 0] + 0.7 * z[:, 1] * (z[:, 3] > 0) + rng.normal(size=n) * 0.7 > 0).astype(float)
    rows = [(i, float(y[i]), int(rng.integers(0, 3)), [None if math.isnan(v) else float(v) for v in x[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "key long, label double, fold int, x array<double>").repartition(5).cache()
    return df, rows


def matrix_of(df, where=None):
    VALUES = {f"f{j}": F.col("x")[j] for j in range(D)}
    borders = N.learn_borders(df if where is None else df.where(where), VALUES)
    return N.binned(df, VALUES, borders, ["key", "label", "fold"]), borders


def plain_bins(rows, borders):
    x = np.array([[np.nan if v is None else v for v in r[3]] for r in rows])
    return np.array([[sum(b < v for b in borders.fine[j]) if v == v else 0 for j, v in enumerate(r)] for r in x]), x


def sums(g, h, rows):
    return g[rows].sum() / B.UNIT, h[rows].sum() / B.UNIT


def plain_leafwise(bins, y, s, base):
    """Trees grown one split at a time, with every candidate tried on the rows themselves."""
    margin, trees = np.full(len(y), base), []
    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.floor((p - y) * B.UNIT + 0.5), np.floor(p * (1 - p) * B.UNIT + 0.5)
        leaves, splits = {"": np.arange(len(y))}, []

        def best(rows):
            out = (0.0, None, None)
            G, H = sums(g, h, rows)
            for c in range(bins.shape[1]):
                for b in sorted(set(bins[rows, c]))[:-1]:
                    left, right = rows[bins[rows, c] <= b], rows[bins[rows, c] > b]
                    if min(len(left), len(right)) < s.min_rows:
                        continue
                    (a, ah), (r, rh) = sums(g, h, left), sums(g, h, right)
                    gain = a * a / (ah + s.l2) + r * r / (rh + s.l2) - G * G / (H + s.l2)
                    if gain > out[0]:
                        out = (gain, c, b)
            return out

        known = {"": best(leaves[""])}
        while len(leaves) < s.num_leaves:
            path = max(leaves, key=lambda q: known[q][0])
            gain, c, b = known[path]
            if c is None:
                break
            rows = leaves.pop(path)
            splits.append((path, c, int(b), round(gain, 6)))
            for turn, side in (("L", rows[bins[rows, c] <= b]), ("R", rows[bins[rows, c] > b])):
                leaves[path + turn] = side
                known[path + turn] = best(side)
        values = {}
        for path, rows in leaves.items():
            G, H = sums(g, h, rows)
            values[path] = -G / (H + s.l2) * s.rate
            margin[rows] += values[path]
        trees.append((sorted(splits), values))
    return trees, margin


def paths(tree):
    out, todo = {}, [(0, "")]
    while todo:
        n, path = todo.pop()
        out[n] = path
        if tree.left[n] >= 0:
            todo += [(tree.left[n], path + "L"), (tree.right[n], path + "R")]
    return out


@pytest.mark.parametrize("setting", [
    B.Setting(trees=3, num_leaves=9), B.Setting(trees=2, num_leaves=31, min_rows=5, l2=1.5, rate=0.3), B.Setting(trees=2, num_leaves=2),
    B.Setting(trees=1, num_leaves=500, min_rows=1),
])
def test_leafwise_growth_equals_split_by_split(table, setting):
    df, rows = table
    matrix, borders = matrix_of(df)
    bins, _ = plain_bins(rows, borders)
    model, = B.train(matrix, borders, [B.Fit(setting, list(range(D)))])
    want, _ = plain_leafwise(bins, np.array([r[1] for r in rows]), setting, model.base)
    for tree, (splits, values) in zip(model.trees, want, strict=True):
        at = paths(tree)
        assert sorted((at[i], int(tree.column[i]), int(tree.bin[i]), round(tree.gain[i], 6)) for i in at if tree.left[i] >= 0) == splits
        got = {at[i]: tree.value[i] for i in at if tree.left[i] < 0}
        assert got.keys() == values.keys() and all(got[k] == pytest.approx(values[k], abs=1e-12) for k in got)


def plain_symmetric(bins, y, s, base, weights=None):
    margin, trees = np.full(len(y), base), []
    for t in range(s.trees):
        p = 1 / (1 + np.exp(-margin))
        w = np.ones(len(y)) if weights is None else weights(t)
        g, h = np.floor((p - y) * w * B.UNIT + 0.5), np.floor(p * (1 - p) * w * B.UNIT + 0.5)
        place, splits = np.zeros(len(y), int), []
        for _ in range(s.depth):
            best = (-1.0, None, None)
            for c in range(bins.shape[1]):
                for b in sorted(set(bins[:, c]))[:-1]:
                    new = place * 2 + (bins[:, c] > b)
                    total = 0.0
                    for q in np.unique(new):
                        G, H = sums(g, h, new == q)
                        total += G * G / (H + s.l2)
                    if total > best[0] + 1e-9:
                        best = (total, c, b)
            place = place * 2 + (bins[:, best[1]] > best[2])
            splits.append((best[1], int(best[2])))
        value = np.zeros(2**s.depth)
        for q in range(2**s.depth):
            G, H = sums(g, h, place == q)
            value[q] = -G / (H + s.l2) * s.rate if H + s.l2 > 0 else 0.0
        margin += value[place]
        trees.append((splits, value))
    return trees


@pytest.mark.parametrize("t", [0.0, 1.5])
def test_symmetric_growth_equals_plain(table, t):
    df, rows = table
    s = B.Setting(growth="level", trees=2, depth=3, l2=2.0, rate=0.2, bagging_temperature=t)
    matrix, borders = matrix_of(df)
    bins, _ = plain_bins(rows, borders)
    key = np.array([r[0] for r in rows])
    model, = B.train(matrix, borders, [B.Fit(s, list(range(D)))])
    weights = (lambda n: B.bootstrap_weights(key, s, n)) if t else None
    for tree, (splits, value) in zip(model.trees, plain_symmetric(bins, np.array([r[1] for r in rows]), s, model.base, weights), strict=True):
        assert list(zip(tree.column.tolist(), tree.bin.tolist())) == splits
        assert tree.value == pytest.approx(value, abs=1e-12) and tree.rows.sum() == len(rows)


def test_fits_together_equal_fits_alone(table, monkeypatch):
    monkeypatch.setattr(B, "CUT_TREES", 2)
    df, _ = table
    matrix, borders = matrix_of(df)
    fits = [B.Fit(B.Setting(trees=5, num_leaves=4), list(range(D)), j) for j in range(2)]
    fits += [B.Fit(B.Setting(growth="level", trees=4, depth=2, l2=1.0, random_strength=1.0, colsample=0.5, bagging_temperature=1.0), [0, 1, 3])]
    together = B.train(matrix, borders, fits)
    for fit, model in zip(fits, together):
        alone, = B.train(matrix.repartition(3), borders, [fit])
        assert len(alone.trees) == len(model.trees) == fit.setting.trees
        for a, b in zip(alone.trees, model.trees):
            assert all(np.array_equal(getattr(a, f), getattr(b, f)) for f in ("column", "bin", "value", "rows"))
    # rows of no fold teach nothing
    few, = B.train(matrix.withColumn("fold", F.when(F.col("fold") == 0, F.lit(B.NO_FOLD)).otherwise(F.col("fold"))), borders, [B.Fit(fits[0].setting, fits[0].columns)])
    assert few.trees[0].rows[0] == together[0].trees[0].rows[0]


def test_scans_in_lots_and_merged_sums_change_nothing(table, monkeypatch):
    df, _ = table
    matrix, borders = matrix_of(df)
    fits = [B.Fit(B.Setting(trees=2, num_leaves=6), list(range(D)), j) for j in range(3)]
    want = B.train(matrix, borders, fits)
    monkeypatch.setattr(B, "SCAN_BYTES", 1)
    monkeypatch.setattr(B, "MERGE", 2)
    got = B.train(matrix, borders, fits)
    assert [t.value.tolist() for m in got for t in m.trees] == [t.value.tolist() for m in want for t in m.trees]


def test_stopping_while_growing_equals_the_full_curve(table):
    df, _ = table
    matrix, borders = matrix_of(df, "fold <> 1")
    setting = B.Setting(trees=24, num_leaves=4, rate=0.9)
    stopped, = B.train(matrix, borders, [B.Fit(setting, list(range(D)), 1, 4)])
    full, = B.train(matrix, borders, [B.Fit(setting, list(range(D)), 1, 1000)])
    assert len(full.auc) == 25 and stopped.auc == full.auc[: len(stopped.auc)]
    best = 0
    for m, a in enumerate(full.auc):  # patience on the full curve
        best = m if a > full.auc[best] else best
        if m - best >= 4:
            break
    assert len(stopped.trees) == best and len(stopped.auc) - 1 == min(24, best + 4) < 24
    # the curve is the AUC of the validation rows, up to pairs in one cell
    rows = [r for r in table[1] if r[2] == 1]
    bins, _ = plain_bins(rows, borders)
    margin = stopped.base + sum(t.margins(bins) for t in stopped.trees)
    y = np.array([r[1] for r in rows])
    pos, neg = margin[y == 1], margin[y == 0]
    exact = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert stopped.auc[best] == pytest.approx(exact, abs=1e-3)


@pytest.mark.parametrize("name,value", [("rate", 0.5), ("depth", 3), ("l2", 30.0), ("borders", 32), ("bagging_temperature", 2.0), ("random_strength", 50.0),
                                        ("colsample", 0.25), ("seed", 7)])
def test_every_setting_acts(table, name, value):
    df, _ = table
    matrix, borders = matrix_of(df)
    base = dict(growth="level", trees=2, depth=2, rate=0.1, l2=1.0, random_strength=1.0 if name == "seed" else 0.0,
                bagging_temperature=1.0 if name == "seed" else 0.0, colsample=0.75 if name == "seed" else 1.0)
    one, other = B.train(matrix, borders, [B.Fit(B.Setting(**s), list(range(D))) for s in (base, {**base, name: value})])
    assert [t.value.tolist() for t in one.trees] != [t.value.tolist() for t in other.trees]
    if name == "l2":
        assert max(abs(t.value).max() for t in other.trees) < max(abs(t.value).max() for t in one.trees)
    if name == "borders":
        assert all(b in borders.coarse[32][c] for t in other.trees for c, b in zip(t.column, t.bin))
    if name == "colsample":
        grower = B.LevelGrower(B.Setting(**{**base, name: value}), borders.sizes, np.ones(int(borders.sizes.sum()), bool), 0)
        assert grower._columns().sum() < borders.sizes.sum()


@pytest.mark.parametrize("growth", ["leaf", "level"])
def test_estimator_scores_persists_and_explains(spark, table, tmp_path, growth):
    df, rows = table
    d = df.withColumn("features", array_to_vector(F.transform("x", lambda v: F.coalesce(v, F.lit(float("nan")))))).withColumnRenamed("key", "id")
    model = HistogramBooster(growth=growth, maxIter=4, numLeaves=5, maxDepth=3, l2=1.0).fit(d)
    out = model.transform(d).select("id", "label", vector_to_array("probability")[1].alias("p"), "prediction").orderBy("id").collect()
    assert np.mean([(r.p > 0.5) == (r.label == 1) for r in out]) > 0.75 and all(r.prediction == float(r.p > 0.5) for r in out)
    PipelineModel(stages=[model]).write().overwrite().save(str(tmp_path / growth))
    again = PipelineModel.load(str(tmp_path / growth))
    assert [r.p for r in again.transform(d).select("id", vector_to_array("probability")[1].alias("p")).orderBy("id").collect()] == [r.p for r in out]
    # margins by the node table, one row at a time
    nodes = {}
    for r in model.nodes().collect():
        nodes.setdefault(r.tree, {})[r.node] = r
    for x, got in list(zip([r[3] for r in sorted(rows)], out))[:40]:
        margin = model.getOrDefault(model.base)
        for tree in nodes.values():
            n = tree[0]
            while n.feature is not None:
                v = x[int(n.feature[1:])]
                n = tree[n.right if v is not None and v > n.border else n.left]
            margin += n.value
        assert got.p == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-12)
    # M7 from the node table by hand
    want = {}
    for tree in nodes.values():
        for n in tree.values():
            if n.feature is not None:
                a, b = tree[n.left], tree[n.right]
                if a.n_rows + b.n_rows:
                    mean = (a.value * a.n_rows + b.value * b.n_rows) / (a.n_rows + b.n_rows)
                    want[n.feature] = want.get(n.feature, 0) + a.n_rows * (a.value - mean) ** 2 + b.n_rows * (b.value - mean) ** 2
    got = {r.feature: r.importance for r in B.value_change(model.nodes()).collect()}
    assert got.keys() == want.keys() and all(got[f] == pytest.approx(100 * want[f] / sum(want.values())) for f in got)


def test_degenerate_tables(spark):
    schema = "key long, label double, fold int, x array<double>"
    same = spark.createDataFrame([(i, float(i % 2), 0, [1.0, None, None, 2.0]) for i in range(50)], schema)
    matrix, borders = matrix_of(same)
    assert [len(b) for b in borders.fine] == [0] * D
    models = B.train(matrix, borders, [B.Fit(B.Setting(growth=g, trees=2, l2=1.0), list(range(D))) for g in ("leaf", "level")])
    assert [[len(t.value) for t in m.trees] for m in models] == [[1, 1]] * 2 and models[0].base == 0.0
    one = spark.createDataFrame([(i, 1.0, 0, [float(i), 0.0, 0.0, 0.0]) for i in range(50)], schema)
    model, = B.train(*matrix_of(one), [B.Fit(B.Setting(trees=1), list(range(D)))])
    assert model.base == pytest.approx(math.log(50.5 / 0.5))
    with pytest.raises(ValueError):
        B.train(*matrix_of(one.withColumn("label", F.lit(2.0))), [B.Fit(B.Setting(trees=1), [0])])


def test_borders_keep_their_rank_beyond_the_sketch_size(spark):
    df = spark.range(60_000).select(((F.col("id") * 7919) % 60_013).cast("double").alias("v")).repartition(6)
    for k, error in ((200, 0.04), (4096, 0.002)):
        rows = N.quantiles(N.sketches(df, {"v": F.col("v")}, k), ["v"]).collect()
        ordered = np.sort([r.v for r in df.collect()])
        assert max(abs(np.searchsorted(ordered, r.value, side="right") / len(ordered) - r.place / 255) for r in rows) < error


def test_fold_encodings_equal_one_fold_at_a_time(spark):
    rows = [(i, f"c{i * 7 % 5}", float(i * 13 % 3 == 0), i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, c string, label double, fold int")
    out = {r.id: r for r in ordered_target_encode_folds(df, ["c"], "label", "id", "fold", 4, rows_per_bucket=16).collect()}
    assert len(out) == 200
    for j in range(4):
        train = df.where(F.col("fold") != j)
        for r in ordered_target_encode(train, ["c"], "label", "id", rows_per_bucket=1 << 20).collect():
            assert out[r.id][f"c_te_{j}"] == pytest.approx(r.c_te)
        t = [r for r in rows if r[3] != j]
        p = sum(r[2] for r in t) / len(t)
        for i, c, _, fold in rows:
            if fold == j:
                own = [r[2] for r in t if r[1] == c]
                assert out[i][f"c_te_{j}"] == pytest.approx((sum(own) + p) / (len(own) + 1))


def test_combinations_and_permutations(spark):
    """A label that only the combination explains; every order equals that order on its own."""
    rows = [(i, f"a{i % 2}", None if i // 2 % 3 == 0 else f"b{i // 2 % 3}", float((i % 2) ^ (i // 2 % 3 == 1))) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, a string, b string, y double")
    gains = combination_gains(df, ["a", "b"])
    assert {r.feature: r.n_levels for r in gains.collect()} == {"a": 2, "b": 3, "a+b": 6}
    assert chosen_combinations(gains) == [["a", "b"]] and chosen_combinations(gains, 1e9) == []
    both = df.withColumn("ab", F.concat_ws("|", F.coalesce("a", F.lit("?")), F.coalesce("b", F.lit("?")))).fillna("?", ["b"])
    got = {(r.id, r.permutation, r.feature): r.te for r in ordered_target_permutations(df, [["a"], ["b"], ["a", "b"]], seeds=["s", "t"], rows_per_bucket=32).collect()}
    assert len(got) == 240 * 2 * 3
    for k, seed in enumerate(["s", "t"]):
        for r in ordered_target_encode(both, ["a", "b", "ab"], "y", "id", seed=seed).collect():
            assert [got[r.id, k, f] for f in ("a", "b", "a+b")] == pytest.approx([r.a_te, r.b_te, r.ab_te])


def test_rows_are_kept_in_blocks_that_the_scans_share(table, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 64)
    df, rows = table
    matrix, borders = matrix_of(df)
    blocks, partitions, counts = B.prepare_rows(matrix, D, 2)
    assert blocks.rdd.getNumPartitions() == partitions and sum(counts.values()) == len(rows) and blocks.count() < len(rows) / 32
    back = {r.key: (r.label, r.fold) for r in B.fit_rows(blocks, D, 2).collect()}
    assert back == {r[0]: (r[1], r[2]) for r in rows}
    blocks.unpersist()


def test_leafwise_trees_enter_only_branches_asked_for(monkeypatch):
    #        0: column 0 > 3 -> 2 (column 1 > 1 -> 4 else 3) else 1
    tree = B.Tree(np.array([0, -1, 1, -1, -1]), np.array([3, -1, 1, -1, -1]), np.array([1, -1, 3, -1, -1]), np.array([2, -1, 4, -1, -1]),
                  np.array([0, 1.0, 0, 2.0, 3.0]), np.zeros(5, int), np.zeros(5))
    columns = np.array([[1, 5, 7, 3], [9, 0, 2, 9]], np.uint8)
    assert tree.values(columns, 4).tolist() == tree.margins(columns.T).tolist() == [1.0, 2.0, 3.0, 1.0]
    assert [(n, at.tolist()) for n, at in tree.parts(columns, 4, np.array([0, 1, 0, 0, 0], bool))] == [(1, [0, 3])]
    assert [(n, at.tolist()) for n, at in tree.parts({0: columns[0]}, 4, np.array([0, 0, 1, 0, 0], bool))] == [(2, [1, 2])]  # no branch below
    assert not B.due([[tree], [tree, tree]]) and B.due([[tree, tree], [tree, tree]])


@pytest.mark.parametrize("bits", [53, 20])
def test_columns_of_few_bins_are_counted_together(monkeypatch, bits):
    """Joint codes and the one sum of hessians and rows give the sums of the columns one by one, also where one sum is too narrow."""
    monkeypatch.setattr(B, "EXACT_BITS", bits)
    rng = np.random.default_rng(5)
    n, sizes = 700, np.array([255, 2, 1, 3, 2, 40, 2])
    columns = np.array([rng.integers(0, s, n) for s in sizes], np.uint8)
    block = B.Block(n, None, rng.integers(0, 2, n).astype(np.uint8), rng.integers(-1, 3, n).astype(np.int8), columns, rng.normal(size=(1, n)))
    groups = B.column_groups(sizes)
    assert sorted(c for g in groups for c in g) == list(range(7)) and len(groups) == 3
    assert all(math.prod(int(sizes[c]) for c in g) <= B.GROUP_CELLS for g in groups)
    tree = B.Tree(np.array([0, -1, -1]), np.array([90, -1, -1]), np.array([1, -1, -1]), np.array([2, -1, -1]), np.zeros(3), np.zeros(3, int), np.zeros(3))
    for partial, place, places in ((None, np.array([0]), 1), (tree, np.array([-1, 1, 0]), 2)):
        ask = B.Ask(B.Fit(B.Setting(), list(range(7)), 2), 0.1, sizes, 0, [], partial, place, places)
        found = ask.sums()
        ask.count(block, block.margins[0], found, None)
        want = np.zeros((3, places, int(sizes.sum())), np.int64)
        g, h = B.gradients(block.y, block.margins[0] + 0.1, None, ask.fit.setting, 0)
        for i in np.flatnonzero((block.fold != 2) & (block.fold != B.NO_FOLD)):
            node = 0 if partial is None else 1 + (columns[0, i] > 90)
            for c, end in enumerate(np.cumsum(sizes)):
                want[:, place[node], end - sizes[c] + columns[c, i]] += [int(g[i]), int(h[i]), 1]
        assert np.array_equal(ask.total(found), want)


def test_scans_read_blocks_as_stored_and_cores_get_even_tasks(table, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 16)
    monkeypatch.setattr(B, "TASK_ROWS", 50)
    df, rows = table
    matrix, _ = matrix_of(df)
    blocks, partitions, counts = B.prepare_rows(matrix, D, 2, keyed=False)
    assert partitions % df.sparkSession.sparkContext.defaultParallelism == 0 and partitions >= 900 / 50
    first = blocks.rdd.first()
    assert first.key is None and first.y.dtype == np.uint8 and first.fold.dtype == np.int8 and first.margins.shape == (2, first.n)
    assert sum(counts.values()) == len(rows) == sum(blocks.rdd.map(lambda b: b.n).collect())
    blocks.unpersist()


def grown(rng, columns, leaves):
    """A random leaf-wise tree: children after their parents."""
    left, right, column, at = [-1], [-1], [-1], [-1]
    for _ in range(leaves - 1):
        node = int(rng.choice([i for i in range(len(left)) if left[i] < 0]))
        left[node], right[node], column[node], at[node] = len(left), len(left) + 1, int(rng.integers(0, len(columns))), int(rng.integers(0, 9))
        for a in (left, right, column, at):
            a += [-1, -1]
    n = len(left)
    return B.Tree(*[np.array(a) for a in (column, at, left, right)], rng.normal(size=n), np.zeros(n, int), np.zeros(n))


@pytest.mark.parametrize("leaves", [1, 7, 64, 65, 90])
def test_masks_find_the_rows_that_places_find(leaves):
    rng = np.random.default_rng(leaves)
    n, columns = 500, rng.integers(0, 10, (4, 500)).astype(np.uint8)
    tree = grown(rng, columns, leaves)
    want, node_of = np.empty(n), np.empty(n, int)
    for node, at in tree.parts(columns, n):
        want[at], node_of[at] = tree.value[node], node
    assert np.array_equal(tree.values(columns, n), want)
    some = np.flatnonzero(tree.left < 0)[::3]
    number = np.full(len(tree.left), -1)
    number[some] = np.arange(len(some))
    rows = rng.random(n) < 0.6
    found = tree.numbers(columns, n, number, rows).astype(int) - 1
    assert np.array_equal(found, np.where(rows, number[node_of], -1))
    block = B.Block(n, None, np.zeros(n), np.zeros(n, int), columns, np.zeros((1, n)))
    use, place = B.Ask(B.Fit(B.Setting(), [0, 1, 2, 3]), 0.0, np.full(4, 10), 0, [], tree, number, len(some)).rows(block, rows)
    assert dict(zip(use.tolist(), place.tolist())) == {i: p for i, p in enumerate(found) if p >= 0}
    if leaves > 1:  # scoring: every value is compared with the borders once
        x = np.where(rng.random((n, 4)) < 0.1, np.nan, columns.T + rng.normal(size=(n, 4)).round(1))
        border = np.where(tree.column >= 0, tree.bin + rng.integers(0, 3, len(tree.bin)) / 2, 0.0)
        saved = {"column": tree.column, "border": border, "left": tree.left, "right": tree.right, "value": tree.value, "rows": tree.rows, "gain": tree.gain}
        got = tree_margins(*binned_trees([{k: v.tolist() for k, v in saved.items()}] * 2), x)
        for i in range(n):
            node = 0
            while tree.left[node] >= 0:
                node = tree.right[node] if x[i, tree.column[node]] > border[node] else tree.left[node]
            assert got[i] == 2 * tree.value[node]


def test_fits_share_equal_features():
    none, one = np.zeros(0), np.array([0.0])
    fine = [np.array([1.0, 2.0]), one, np.array([1.0, 2.0]), one, none]
    borders = N.Borders([f"n{i}" for i in range(5)], fine, {32: [np.arange(len(b)) for b in fine]})
    keys = [("number", "x", 0.5), ("is", "c", "a", "b"), ("number", "x", 0.25), ("is", "c", "a", "b"), ("is", "c", "a", "b")]
    values, own, place = shared_columns(dict.fromkeys(borders.names), keys, borders)
    # equal features and borders once; an equal feature with other borders is a column of its own
    assert list(values) == own.names == ["n0", "n1", "n2", "n4"] and place == [0, 1, 2, 1, 3]
    assert [len(b) for b in own.fine] == [len(b) for b in own.coarse[32]] == [2, 1, 2, 0]


def test_borders_of_many_columns(spark, monkeypatch):
    """More values than one pass takes, over several partitions, columns without values among them."""
    monkeypatch.setattr(N, "TOGETHER", 2)
    df = spark.range(0, 600, 1, 4)
    values = {f"f{i}": (F.col("id") % (i + 2)).cast("double") if i != 3 else F.lit(None).cast("double") for i in range(5)}
    borders = N.learn_borders(df, values)
    assert [b.tolist() for b in borders.fine] == [[float(v) for v in range(i + 1)] if i != 3 else [] for i in range(5)]
    assert N.learn_borders(df.where("id < 0"), values).fine[0].tolist() == []
