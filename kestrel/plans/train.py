"""J2 — tuned training: derive -> impute -> split -> class-size guard -> randomized search -> early-stopped final
fit -> importances -> hold-out metrics -> save.

The saved artefact is one ``PipelineModel``: [derived features, median/'missing' imputer, ordered target encoder,
assembler, booster]. Scoring (J3) loads it and runs one narrow projection per partition.

Leak flags (named, off by default): ``fit_scope='all'`` fits the medians on every row before the split, and
``eval_on='holdout'`` early-stops on the hold-out rows that are then reported. Defaults fit on the training rows and
early-stop on a validation fold of the training rows.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.columns import hard_class, positive_probability
from kestrel.functions.derive import Derivation, FeatureDeriver, derive
from kestrel.operators.metrics import classification_metrics
from kestrel.operators.preprocess import TabularPreprocessor, numeric_columns
from kestrel.operators.splits import TRAIN, stratified_split, warn_if_small
from kestrel.plans import search as S
from kestrel.session import cut_lineage, fit_frame

log = logging.getLogger(__name__)


@dataclass
class TrainResult:
    model: PipelineModel
    trials: DataFrame
    best: dict
    best_iteration: int
    curve: DataFrame
    importances: DataFrame
    metrics: DataFrame
    warnings: list[str]


def train_tuned(
    df: DataFrame,
    cat_cols: Sequence[str],
    derivations: Sequence[Derivation] = (),
    derivation_set: str | None = None,
    label: str = "y",
    id_col: str = "id",
    drop_cols: Sequence[str] = ("shares",),
    n_iter: int = S.N_ITER,
    k: int = 5,
    search_iterations: int = S.SEARCH_ITERATIONS,
    final_iterations: int = S.FINAL_ITERATIONS,
    patience: int = S.PATIENCE,
    seed: int = 42,
    test_size: float = 0.2,
    fit_scope: str = "train",
    eval_on: str = "validation",
    out_dir: str | None = None,
) -> TrainResult:
    derived, warnings = derive(df.drop(*drop_cols), derivations)
    num_cols = numeric_columns(derived, exclude=(id_col, label))  # after derivation (P3)
    imputer = TabularPreprocessor(numCols=num_cols, catCols=list(cat_cols), numStrategy="median",
                                  catStrategy="constant", scale=False, oneHot=False, outputMode="columns")
    # numbered rows are materialised once: the imputer's passes, the search and the final fits all read them
    split = cut_lineage(stratified_split(derived, label, id_col, test_size, k, seed)
                        .withColumn("label", F.col(label).cast("double")))
    imputer_model = imputer.fit(split if fit_scope == "all" else split.where(F.col("split") == TRAIN))
    warnings = [*warnings, *imputer_model.getOrDefault(imputer_model.fitWarnings)]
    num_cols = imputer_model.getOrDefault(imputer_model.numCols)  # without columns that have no value to learn from
    data = imputer_model.transform(split)
    trainval = data.where(F.col("split") == TRAIN)
    test = data.where(F.col("split") != TRAIN)
    warn_if_small(trainval, label, k)

    trials = S.randomized_search(trainval, num_cols, cat_cols, n_iter, k, search_iterations, seed, "label", id_col)
    trials = cut_lineage(trials)
    best = S.best_setting(trials)
    est = S.OrderedBoostingClassifier(num_cols, cat_cols, best, final_iterations, seed, "label", id_col)
    if eval_on == "holdout":
        fit_rows, eval_rows = trainval, test
    else:
        fit_rows, eval_rows = trainval.where(F.col("fold") != 0), trainval.where(F.col("fold") == 0)
    stopped, curve = est.fit_stopped(fit_rows, eval_rows, patience)
    best_m = len(stopped.stages[-1].trees)
    booster = stopped if eval_on == "holdout" else est.fit_iterations(trainval, max(1, best_m))

    stages = []
    if derivation_set is not None:
        stages.append(FeatureDeriver(derivationSet=derivation_set))
    model = PipelineModel(stages=[*stages, imputer_model, *booster.stages])
    importances = S.feature_importances(booster)

    scored = booster.transform(test).select(
        F.col("label").cast("int").alias("y"), positive_probability().alias("y_prob")
    ).withColumn("prediction", hard_class("y_prob"))
    scored_cached, scored, _ = fit_frame(scored)  # read by each metric pass
    metrics = cut_lineage(classification_metrics(scored, "y", "prediction", "y_prob"))
    scored_cached.unpersist()
    if out_dir:
        from kestrel.sources.sinks import save_model, write_table

        err = save_model(model, f"{out_dir}/model")
        if err:
            warnings.append(err)
            log.error(err)
        write_table(importances.orderBy(F.desc("importance")), f"{out_dir}/feature_importances", fmt="csv")
    return TrainResult(model, trials, best, best_m, curve, importances, metrics, warnings)
