"""Registered operator queries over the driver tables: one callable (spark, sf_dir) -> DataFrame per operator.

Inputs are the planted views of ``kestrel.sources.fixtures`` (whole tables, every row). Computed doubles are
rounded to 6 digits so that the DuckDB oracle in ``kestrel.plans.oracle`` compares equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from kestrel.functions import columns as C
from kestrel.functions.derive import ART_DERIVATIONS, ART_T, derive
from kestrel.operators import metrics as M
from kestrel.operators.ensemble import weighted_vote
from kestrel.operators.preprocess import TabularPreprocessor, numeric_columns
from kestrel.operators.splits import TRAIN, min_class_size, stratified_split
from kestrel.operators.target_encoding import ordered_target_encode
from kestrel.plans.search import best_prefix, best_trial, top_importances
from kestrel.session import cut_lineage
from kestrel.sources.fixtures import ART_CAT, art, docs

SEED = 42
K = 5
TEST_SIZE = 0.2
ART_NUM = ("x1", "x2", *ART_T)
ART_MODEL_COLS = ("id", "x1", "x2", "cat1", "cat2", *ART_T, "shares", "y")


def round_doubles(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            C.r6(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def art_model_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art(spark, sf_dir).select(*ART_MODEL_COLS)


def art_split(spark: SparkSession, sf_dir: str, cols=None) -> DataFrame:
    a = art(spark, sf_dir)
    if cols is not None:
        a = a.select(*cols)
    return stratified_split(a, "y", "id", TEST_SIZE, K, SEED)


def art_split_once(spark: SparkSession, sf_dir: str, cols=None) -> DataFrame:
    """For queries that read the numbered rows in several passes: the (md5-heavy) view is materialised once in the
    checkpoint folder, the split reads that copy, and the numbered rows are materialised too."""
    a = art(spark, sf_dir)
    a = cut_lineage(a.select(*cols) if cols is not None else a)
    return cut_lineage(stratified_split(a, "y", "id", TEST_SIZE, K, SEED))


def _trainval(df: DataFrame) -> DataFrame:
    return df.where(F.col("split") == TRAIN)


# ---- splits, counts, labels -------------------------------------------------------------------------------------
def q_holdout_split(spark, sf):
    return art_split(spark, sf, ["id", "y"]).select("id", "y", "split")


def q_kfold_assign(spark, sf):
    return _trainval(art_split(spark, sf, ["id", "y"])).select("id", "y", "fold")


def q_row_counts(spark, sf):
    return art_split(spark, sf, ["id", "y"]).groupBy("split").agg(F.count("*").alias("n_rows"))


def q_min_class_size(spark, sf):
    return min_class_size(_trainval(art_split(spark, sf, ["id", "y"])), "y", K)


def q_threshold_label(spark, sf):
    return art(spark, sf).select("id", "shares", C.threshold_label("shares").alias("y_label"))


def q_feature_projection(spark, sf):
    """Drop id/shares/y from the features, numeric by dtype, the explicit categorical list, label."""
    v = art_model_view(spark, sf)
    nums = numeric_columns(v, exclude=("id", "shares", "y"))
    return round_doubles(v.select("id", F.col("y").cast("double").alias("label"), *nums, *ART_CAT))


# ---- derived features ------------------------------------------------------------------------------------------
def _derived(spark, sf, names):
    d, _ = derive(art(spark, sf), ART_DERIVATIONS)
    return round_doubles(d.select("id", *names))


def q_derive_ratio(spark, sf):
    return _derived(spark, sf, ["feat_x1_to_x2_ratio"])


def q_derive_spread(spark, sf):
    return _derived(spark, sf, ["feat_x1_x2_spread"])


def q_derive_product(spark, sf):
    return _derived(spark, sf, ["feat_t0_t1_product"])


def q_row_max(spark, sf):
    return _derived(spark, sf, ["feat_t_max"])


def q_row_std(spark, sf):
    return _derived(spark, sf, ["feat_t_std"])


def q_derived_features(spark, sf):
    return _derived(spark, sf, [d.name for d in ART_DERIVATIONS])


# ---- preprocessing fitted on trainval, applied to every row ------------------------------------------------------
def _fit_apply(spark, sf, out_cols, **params):
    df = art_split_once(spark, sf, list(ART_MODEL_COLS))
    pre = TabularPreprocessor(outputMode="columns", **params)
    model = pre.fit(_trainval(df))
    out = model.transform(df)
    return round_doubles(out.select("id", *out_cols(model)))


def q_impute_mean(spark, sf):
    return _fit_apply(spark, sf, lambda m: ["x1", "x2"], numCols=["x1", "x2"], scale=False)


def q_impute_median(spark, sf):
    return _fit_apply(spark, sf, lambda m: ["x1", "x2"], numCols=["x1", "x2"], numStrategy="median", scale=False)


def q_impute_mode(spark, sf):
    return _fit_apply(spark, sf, lambda m: list(ART_CAT), catCols=list(ART_CAT), oneHot=False)


def q_impute_const(spark, sf):
    return _fit_apply(spark, sf, lambda m: list(ART_CAT), catCols=list(ART_CAT), catStrategy="constant", oneHot=False)


def q_standardize(spark, sf):
    return _fit_apply(spark, sf, lambda m: ["x1", "x2"], numCols=["x1", "x2"])


def q_one_hot_drop_first(spark, sf):
    return _fit_apply(spark, sf, lambda m: m.feature_names(), catCols=list(ART_CAT))


def q_design_matrix(spark, sf):
    return _fit_apply(spark, sf, lambda m: m.feature_names(), numCols=list(ART_NUM), catCols=list(ART_CAT))


def q_fold_statistics(spark, sf):
    """Leave-one-fold-out mean, population sigma (after mean imputation) and mode, from one grouped pass."""
    tv = _trainval(art_split_once(spark, sf, list(ART_MODEL_COLS)))
    pre = TabularPreprocessor(numCols=["x1", "x2"], catCols=list(ART_CAT), oneHot=False)
    models = pre.fit_folds(tv, "fold", K)
    counts = {int(r["fold"]): int(r["count"]) for r in tv.groupBy("fold").count().collect()}
    n_all = sum(counts.values())
    rows = []
    for j, m in enumerate(models):
        mean, scale, fill = m.getOrDefault(m.numMean), m.getOrDefault(m.numScale), m.getOrDefault(m.catFill)
        rows.append((j, n_all - counts.get(j, 0), mean[0], scale[0], mean[1], scale[1], fill[0], fill[1]))
    schema = ("fold int, n_train bigint, mean_x1 double, std_x1 double, mean_x2 double, std_x2 double, "
              "mode_cat1 string, mode_cat2 string")
    return round_doubles(spark.createDataFrame(rows, schema))


def q_ordered_target_mean(spark, sf):
    tv = _trainval(art_split_once(spark, sf, list(ART_MODEL_COLS)))
    tv = tv.withColumn("cat2", F.coalesce(F.col("cat2"), F.lit("missing")))
    return round_doubles(ordered_target_encode(tv, ["cat2"], "y", "id", seed="cb").select("id", "cat2_te"))


# ---- metrics on the fixed score column ---------------------------------------------------------------------------
def _fold_metrics(spark, sf):
    tv = _trainval(art_split_once(spark, sf, ["id", "y", "score"]))
    tv = tv.withColumn("prediction", C.hard_class("score"))
    return M.classification_metrics(tv, "y", "prediction", "score", ["fold"], max_groups=K)


def q_metric_accuracy(spark, sf):
    return round_doubles(_fold_metrics(spark, sf).select("fold", "accuracy"))


def q_metric_f1(spark, sf):
    return round_doubles(_fold_metrics(spark, sf).select("fold", "f1"))


def q_metric_auc(spark, sf):
    tv = _trainval(art_split_once(spark, sf, ["id", "y", "score"]))
    return round_doubles(M.roc_auc(tv, "y", "score", ["fold"], max_groups=K))


def q_metric_composite(spark, sf):
    return round_doubles(_fold_metrics(spark, sf).select("fold", "accuracy", "f1", "roc_auc", "composite"))


def q_fold_mean(spark, sf):
    return round_doubles(M.fold_mean(_fold_metrics(spark, sf)))


def q_holdout_metrics(spark, sf):
    te = art_split_once(spark, sf, ["id", "y", "score"]).where(F.col("split") == "test")
    te = te.withColumn("prediction", C.hard_class("score"))
    return round_doubles(M.classification_metrics(te, "y", "prediction", "score"))


# ---- learners with SQL-checkable fitted state ---------------------------------------------------------------------
def q_nb_tables(spark, sf):
    """Gaussian NB on the trainval design matrix: per class mean and population variance + 1e-9 * max variance."""
    from pyspark.ml.classification import NaiveBayes

    df = art_split_once(spark, sf, list(ART_MODEL_COLS))
    tv = _trainval(df)
    pre = TabularPreprocessor(numCols=list(ART_NUM), catCols=list(ART_CAT)).fit(tv)
    data = pre.transform(tv).withColumn("label", F.col("y").cast("double"))
    nb = NaiveBayes(modelType="gaussian", featuresCol="features", labelCol="label").fit(data)
    names = pre.feature_names()
    theta, sigma = nb.theta.toArray(), nb.sigma.toArray()
    rows = [
        (int(lab), names[j], float(theta[i, j]), float(sigma[i, j]))
        for i, lab in enumerate(range(nb.numClasses))  # rows of theta/sigma follow label order 0, 1
        for j in range(len(names))
    ]
    return round_doubles(spark.createDataFrame(rows, "label int, feature string, mean double, var double"))


def q_soft_vote(spark, sf):
    a = art(spark, sf)
    p = weighted_vote([F.col("p1"), F.col("p2"), F.col("p3")], [2.0, 1.0, 1.0])
    return round_doubles(a.select("id", p.alias("y_prob"), C.hard_class(p).alias("y_predict")))


# ---- the second view: documents with quality labels (skewed classes) ----------------------------------------------
def q_docs_split(spark, sf):
    d = docs(spark, sf)
    return stratified_split(d, "y", "id", TEST_SIZE, K, SEED).select("id", "y", "split", "fold")


def q_docs_design_matrix(spark, sf):
    d = stratified_split(docs(spark, sf), "y", "id", TEST_SIZE, K, SEED)
    pre = TabularPreprocessor(numCols=["n_chars"], catCols=["lang", "source"], outputMode="columns")
    m = pre.fit(_trainval(d))
    return round_doubles(m.transform(d).select("id", *m.feature_names()))


def q_kfold_all_rows(spark, sf):
    """V5: folds numbered over every row (the first baseline's CV on 100 % of rows)."""
    a = art(spark, sf).select("id", "y")
    return stratified_split(a, "y", "id", TEST_SIZE, K, SEED, cv_scope="all").select("id", "y", "split", "fold")


def q_fold_class_counts(spark, sf):
    """Stratification check: rows per (fold, class) on the trainval rows."""
    tv = _trainval(art_split(spark, sf, ["id", "y"]))
    return tv.groupBy("fold", "y").agg(F.count("*").alias("n_rows"))


def q_docs_ordered_target_mean(spark, sf):
    d = _trainval(stratified_split(docs(spark, sf), "y", "id", TEST_SIZE, K, SEED))
    return round_doubles(ordered_target_encode(d, ["source"], "y", "id", seed="cb").select("id", "source_te"))


def q_docs_fold_class_counts(spark, sf):
    """Stratification under skewed classes: rows per (fold, class) on the documents view's trainval rows."""
    d = _trainval(stratified_split(docs(spark, sf), "y", "id", TEST_SIZE, K, SEED))
    return d.groupBy("fold", "y").agg(F.count("*").alias("n_rows"))


def q_docs_auc(spark, sf):
    """Exact AUC of an integer score with many ties (document length for the quality label)."""
    return round_doubles(M.roc_auc(docs(spark, sf), "y", "n_chars", ["lang"], max_groups=64))


def q_bootstrap_weights(spark, sf):
    """Bayesian-bootstrap row weights (-ln u)^t for the bagging temperatures of the search space."""
    a = art(spark, sf).select("id")
    u = F.greatest(C.md5_uniform("id", "bw42"), F.lit(1e-12))
    return round_doubles(a.select("id", *[F.pow(-F.log(u), F.lit(t)).alias(f"w_{str(t).replace('.', '_')}")
                                          for t in (0.5, 1.0, 1.5, 2.0)]))


# ---- search and report logic over tables derived from the views ---------------------------------------------------
def q_best_trial(spark, sf):
    """V8 over 30 trials, each the mean of its rows' scores."""
    trials = art(spark, sf).groupBy((F.col("id") % 30).cast("int").alias("trial")).agg(C.r6(F.avg("score")).alias("mean_auc"))
    return best_trial(trials)


def _prefix_curve(spark, sf):
    a = art(spark, sf).select((F.col("id") % 200 + 1).cast("int").alias("trees"), "y", "score")
    return round_doubles(M.roc_auc(a, "y", "score", ["trees"]))


def q_early_stop(spark, sf):
    """V9 over 200 prefixes, each with the exact AUC of its own rows, patience 20."""
    return best_prefix(_prefix_curve(spark, sf), patience=20)


def q_top_importances(spark, sf):
    """The 20 largest of 300 shares, ties by name."""
    a = art(spark, sf).select(F.concat(F.lit("f"), (F.col("id") % 300).cast("string")).alias("feature"), F.floor(F.col("score") * 10).alias("v"))
    return top_importances(a.groupBy("feature").agg(C.r6(F.avg("v")).alias("importance")), 20)


def q_nb_score_batch(spark, sf):
    """A naive Bayes model of the training rows scores the whole unlabelled view."""
    from pyspark.ml import PipelineModel

    from kestrel.operators.models import gaussian_nb
    from kestrel.plans.score import score

    tv = _trainval(art_split_once(spark, sf, list(ART_MODEL_COLS))).withColumn("label", F.col("y").cast("double"))
    pre = TabularPreprocessor(numCols=list(ART_NUM), catCols=list(ART_CAT)).fit(tv)
    model = PipelineModel([pre, gaussian_nb().fit(pre.transform(tv))])
    unlabelled = art(spark, sf).select("id", *reversed(ART_NUM), *ART_CAT)
    return round_doubles(score(unlabelled, model))


EXACT: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "holdout_split": q_holdout_split,
    "kfold_assign": q_kfold_assign,
    "row_counts": q_row_counts,
    "min_class_size": q_min_class_size,
    "threshold_label": q_threshold_label,
    "feature_projection": q_feature_projection,
    "derive_ratio": q_derive_ratio,
    "derive_spread": q_derive_spread,
    "derive_product": q_derive_product,
    "row_max": q_row_max,
    "row_std": q_row_std,
    "derived_features": q_derived_features,
    "impute_mean": q_impute_mean,
    "impute_median": q_impute_median,
    "impute_mode": q_impute_mode,
    "impute_const": q_impute_const,
    "standardize": q_standardize,
    "one_hot_drop_first": q_one_hot_drop_first,
    "design_matrix": q_design_matrix,
    "fold_statistics": q_fold_statistics,
    "ordered_target_mean": q_ordered_target_mean,
    "metric_accuracy": q_metric_accuracy,
    "metric_f1": q_metric_f1,
    "metric_auc": q_metric_auc,
    "metric_composite": q_metric_composite,
    "fold_mean": q_fold_mean,
    "holdout_metrics": q_holdout_metrics,
    "nb_tables": q_nb_tables,
    "soft_vote": q_soft_vote,
    "docs_split": q_docs_split,
    "docs_design_matrix": q_docs_design_matrix,
    "kfold_all_rows": q_kfold_all_rows,
    "fold_class_counts": q_fold_class_counts,
    "docs_ordered_target_mean": q_docs_ordered_target_mean,
    "docs_auc": q_docs_auc,
    "docs_fold_class_counts": q_docs_fold_class_counts,
    "bootstrap_weights": q_bootstrap_weights,
    "best_trial": q_best_trial,
    "early_stop": q_early_stop,
    "top_importances": q_top_importances,
    "nb_score_batch": q_nb_score_batch,
}

from kestrel.plans.boost_catalog import BOOST  # noqa: E402 - they build on the views above
from kestrel.plans.round_trips import ROUND_TRIPS  # noqa: E402

EXACT.update(BOOST)
EXACT.update(ROUND_TRIPS)
