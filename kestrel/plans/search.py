"""Tuned booster: parameter space (V6), randomized search (V7), best trial (V8), early stopping (V9),
native-categorical boosting (F9 + C8), importances (M7, T1).

``OrderedBoostingClassifier`` = ordered target statistics for the categorical columns (training rows see only the rows
before them; scoring uses full training statistics) + the own booster of symmetric trees over numeric + encoded columns. Its
fitted form is a plain ``PipelineModel`` (encoder, assembler, booster), so it persists and scores like any Spark model. All
seven settings act: rate, depth, leaf penalty, border count, row weights, noise of the scores and columns per level.

The search grows all its models (settings x folds) in common scans: one binned matrix with the numeric columns and every
fold's encodings, whose borders come from one sketch per column and serve all border counts. The number of scans of a round
depends on the deepest tree, not on the number of trials, as long as the sums fit in ``boosting.SCAN_BYTES``.

Early stopping happens while the model grows (``HistogramBooster.fit_stopped``): no tree is grown past the best number of
trees + patience.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.operators import boosting
from kestrel.operators.binning import binned, learn_borders, unpacked_rows
from kestrel.operators.histogram_booster import HistogramBooster, HistogramBoosterModel
from kestrel.operators.metrics import roc_auc
from kestrel.operators.target_encoding import OrderedTargetEncoder, ordered_target_encode, ordered_target_encode_folds
from kestrel.session import cut_lineage

# The tuned booster's search space (7 lists, 5*4*6*4*5*5*5 = 60,000 settings).
PARAM_SPACE: dict[str, list] = {
    "learning_rate": [0.01, 0.03, 0.05, 0.07, 0.1],
    "depth": [4, 6, 8, 10],
    "l2_leaf_reg": [1, 3, 5, 7, 9, 12],
    "border_count": [32, 64, 128, 254],
    "bagging_temperature": [0, 0.5, 1.0, 1.5, 2.0],
    "random_strength": [0.1, 0.5, 1, 2, 5],
    "colsample_bylevel": [0.6, 0.7, 0.8, 0.9, 1.0],
}
SEARCH_ITERATIONS = 1000  # trees per search fit
FINAL_ITERATIONS = 2000  # upper bound for the early-stopped final fit
PATIENCE = 50
N_ITER = 30
APPLIED = dict.fromkeys(PARAM_SPACE, True)


def space_size(space: dict[str, list] = PARAM_SPACE) -> int:
    return math.prod(len(v) for v in space.values())


def sample_settings(n_iter: int = N_ITER, seed: int = 42, space: dict[str, list] = PARAM_SPACE) -> list[dict]:
    """``n_iter`` distinct settings drawn without replacement from the grid (mixed-radix decoding of an index)."""
    total = space_size(space)
    picks = random.Random(seed).sample(range(total), min(n_iter, total))
    out = []
    for idx in picks:
        setting = {}
        for name, values in space.items():
            idx, digit = divmod(idx, len(values))
            setting[name] = values[digit]
        out.append(setting)
    return out


def tree_setting(setting: dict, trees: int, seed: int) -> boosting.Setting:
    """A point of the search space as the booster's setting."""
    return boosting.Setting(
        growth="level", trees=trees, rate=float(setting["learning_rate"]), depth=int(setting["depth"]),
        l2=float(setting["l2_leaf_reg"]), borders=int(setting["border_count"]),
        bagging_temperature=float(setting["bagging_temperature"]), random_strength=float(setting["random_strength"]),
        colsample=float(setting["colsample_bylevel"]), seed=seed)


DEFAULT_SETTING = {"learning_rate": 0.03, "depth": 6, "l2_leaf_reg": 3, "border_count": 254, "bagging_temperature": 1.0,
                   "random_strength": 1, "colsample_bylevel": 1.0}


class OrderedBoostingClassifier(Estimator):
    """Ordered target statistics for ``cat_cols`` + symmetric trees over numeric and encoded columns."""

    def __init__(self, num_cols: Sequence[str], cat_cols: Sequence[str], setting: dict | None = None,
                 iterations: int = SEARCH_ITERATIONS, seed: int = 42, label_col: str = "label", id_col: str = "id"):
        super().__init__()
        self.num_cols, self.cat_cols = list(num_cols), list(cat_cols)
        self.setting = {**DEFAULT_SETTING, **(setting or {})}
        self.iterations, self.seed, self.label_col, self.id_col = iterations, seed, label_col, id_col

    def feature_names(self) -> list[str]:
        return self.num_cols + [f"{c}_te" for c in self.cat_cols]

    def booster(self, iterations: int | None = None) -> HistogramBooster:
        s = tree_setting(self.setting, iterations or self.iterations, self.seed)
        return HistogramBooster(
            growth="level", maxIter=s.trees, stepSize=s.rate, maxDepth=s.depth, l2=s.l2, borderCount=s.borders,
            baggingTemperature=s.bagging_temperature, randomStrength=s.random_strength, colsampleByLevel=s.colsample,
            seed=s.seed, labelCol=self.label_col, idCol=self.id_col)

    def assembler(self) -> VectorAssembler:
        # a median may be missing in tiny folds: NULLs are the booster's lowest bin
        return VectorAssembler(inputCols=self.feature_names(), outputCol="features", handleInvalid="keep")

    def encode_training(self, dataset: DataFrame) -> DataFrame:
        """Training-side frame: ordered encodings + assembled features."""
        enc = ordered_target_encode(dataset, self.cat_cols, self.label_col, self.id_col, seed=f"cb{self.seed}")
        return self.assembler().transform(enc)

    def scoring_model(self, encoder, booster_model: HistogramBoosterModel) -> PipelineModel:
        return PipelineModel(stages=[encoder, self.assembler(), booster_model])

    def _fit(self, dataset: DataFrame, iterations: int | None = None) -> PipelineModel:
        encoder = OrderedTargetEncoder(catCols=self.cat_cols, labelCol=self.label_col).fit(dataset)
        train = cut_lineage(self.encode_training(dataset).select(self.id_col, self.label_col, "features"))
        return self.scoring_model(encoder, self.booster(iterations).fit(train))

    def fit_iterations(self, dataset: DataFrame, iterations: int) -> PipelineModel:
        return self._fit(dataset, iterations)

    def fit_stopped(self, dataset: DataFrame, eval_rows: DataFrame, patience: int = PATIENCE) -> tuple[PipelineModel, DataFrame]:
        """(model, curve): V9 on ``eval_rows``, encoded as scoring would; the curve has a row (trees, roc_auc) per tree."""
        encoder = OrderedTargetEncoder(catCols=self.cat_cols, labelCol=self.label_col).fit(dataset)
        keep = [self.id_col, self.label_col, "features"]
        train = self.encode_training(dataset).select(*keep, F.lit(False).alias("__valid"))
        valid = self.assembler().transform(encoder.transform(eval_rows)).select(*keep, F.lit(True).alias("__valid"))
        model, auc = self.booster().fit_stopped(cut_lineage(train.unionByName(valid)), "__valid", patience)
        curve = [(m, None if math.isnan(a) else float(a)) for m, a in enumerate(auc) if m]
        return self.scoring_model(encoder, model), dataset.sparkSession.createDataFrame(curve, "trees int, roc_auc double")


def search_models(data: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], settings: Sequence[dict], k: int = 5,
                  iterations: int = SEARCH_ITERATIONS, seed: int = 42, label_col: str = "label", id_col: str = "id"):
    """(models, rows with all margins, fits): every setting without every fold, setting by setting, in common scans."""
    enc = ordered_target_encode_folds(data, cat_cols, label_col, id_col, "fold", k, seed=f"cb{seed}")
    codes = [f"{c}_te_{j}" for j in range(k) for c in cat_cols]
    enc = cut_lineage(enc.select(F.xxhash64(id_col).alias("key"), F.col(label_col).cast("double").alias("label"), "fold", *num_cols, *codes))
    values = {c: F.col(c).cast("double") for c in [*num_cols, *codes]}
    outside = {f"{c}_te_{j}": F.when(F.col("fold") != j, F.col(f"{c}_te_{j}")) for j in range(k) for c in cat_cols}
    borders = learn_borders(enc, {**values, **outside})
    matrix = binned(enc, values, borders, ["key", "label", "fold"])
    n, d = len(num_cols), len(cat_cols)
    fits = [boosting.Fit(tree_setting(s, iterations, seed), [*range(n), *range(n + j * d, n + (j + 1) * d)], j)
            for s in settings for j in range(k)]
    models, rows = boosting.train_rows(matrix, borders, fits, margins=True)
    return models, rows, fits


def fit_aucs(rows: DataFrame, fits: Sequence[boosting.Fit]) -> DataFrame:
    """(fit, roc_auc): exact, over the rows of the fold that the fit leaves out."""
    by_fold: dict[int, list[int]] = {}
    for f, fit in enumerate(fits):
        by_fold.setdefault(fit.left_out, []).append(f)
    n = len(fits)

    def run(batches):
        for batch in batches:
            margins = unpacked_rows(batch.column("margins"), np.float64, n)
            fold, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "label"))
            for j, own in by_fold.items():
                at = np.flatnonzero(fold == j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.array(own, np.int32), len(at))), pa.array(np.repeat(y[at].astype(np.int32), len(own))),
                     pa.array(margins[at][:, own].ravel())], names=["fit", "y", "margin"])

    scored = cut_lineage(rows.mapInArrow(run, "fit int, y int, margin double"))  # a row per setting and row of the table
    return roc_auc(scored, "y", "margin", ["fit"], max_groups=n)


def randomized_search(data: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], n_iter: int = N_ITER,
                      k: int = 5, iterations: int = SEARCH_ITERATIONS, seed: int = 42, label_col: str = "label",
                      id_col: str = "id") -> DataFrame:
    """Trials table: one row per sampled setting with its mean k-fold ROC AUC. ``data`` carries a ``fold`` column."""
    settings = sample_settings(n_iter, seed)
    _, rows, fits = search_models(data, num_cols, cat_cols, settings, k, iterations, seed, label_col, id_col)
    aucs = {r["fit"]: r["roc_auc"] for r in fit_aucs(rows, fits).collect()}  # settings x folds rows
    spark = data.sparkSession
    trials = [(i, float(s["learning_rate"]), int(s["depth"]), float(s["l2_leaf_reg"]), int(s["border_count"]),
               float(s["bagging_temperature"]), float(s["random_strength"]), float(s["colsample_bylevel"]),
               sum(aucs[i * k + j] for j in range(k)) / k, dict(APPLIED)) for i, s in enumerate(settings)]
    schema = ("trial int, learning_rate double, depth int, l2_leaf_reg double, border_count int, "
              "bagging_temperature double, random_strength double, colsample_bylevel double, mean_auc double, "
              "applied map<string,boolean>")
    return spark.createDataFrame(trials, schema)


def best_trial(trials: DataFrame) -> DataFrame:
    """V8: the row with the highest mean AUC (ties: lowest trial number); the one-row limit is the feature."""
    return trials.orderBy(F.desc("mean_auc"), "trial").limit(1)


def best_setting(trials: DataFrame) -> dict:
    best = best_trial(trials).first()
    return {k: best[k] for k in PARAM_SPACE}


def best_prefix(curve: DataFrame, patience: int = PATIENCE) -> DataFrame:
    """V9: one row (trees, roc_auc), the best prefix at the point where the AUC has not improved for ``patience`` trees,
    or at the end. The curve has one row per prefix, so its windows are small; prefixes without AUC are skipped."""
    upto = Window.orderBy("trees").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("trees").rowsBetween(Window.unboundedPreceding, -1)
    known = curve.where(F.col("roc_auc").isNotNull()).select("trees", "roc_auc", F.max("roc_auc").over(before).alias("__top"))
    known = known.withColumn("__new", F.col("__top").isNull() | (F.col("roc_auc") > F.col("__top")))
    at = known.withColumn("__best", F.max(F.when(F.col("__new"), F.col("trees"))).over(upto))
    at = at.withColumn("__stop", F.max((~F.col("__new") & (F.col("trees") - F.col("__best") >= patience)).cast("int")).over(upto))
    return at.where("__new and __stop = 0").select("trees", "roc_auc").orderBy(F.desc("trees")).limit(1)


def best_iteration(curve: DataFrame, patience: int = PATIENCE) -> int:
    return int(best_prefix(curve, patience).first().trees)


def feature_importances(model: PipelineModel) -> DataFrame:
    """M7: (feature, importance), the change of value that the booster's splits make, in per cent of all. Features that no
    split uses have 0."""
    booster = model.stages[-1]
    names = booster.getOrDefault(booster.names)
    every = SparkSession.getActiveSession().createDataFrame([(n,) for n in names], "feature string")
    used = boosting.value_change(booster.nodes())
    return every.join(used, "feature", "left").select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))


def top_importances(imp: DataFrame, k: int = 20) -> DataFrame:
    """Descending importance, ties by name, first k (the limit is the feature)."""
    return imp.orderBy(F.desc("importance"), "feature").limit(k)


def search_report(trials: DataFrame) -> str:
    """M6: best settings and best CV AUC (the trials table has one row per sampled setting)."""
    best = best_trial(trials).first()
    settings = " ".join(f"{k}={best[k]}" for k in PARAM_SPACE)
    return f"best trial {best['trial']}: mean_auc={best['mean_auc']:.4f} {settings}"
