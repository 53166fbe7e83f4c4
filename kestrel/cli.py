"""Command line for the three jobs: ``experiment`` (J1), ``train`` (J2), ``score``.

    python -m kestrel.cli experiment --data train.csv --model logreg [--cv-scope all] [--metrics-out DIR]
    python -m kestrel.cli train --data train.csv --out DIR [--n-iter 30 --folds 5 ...]
    python -m kestrel.cli score --data test.csv --model DIR/model --out prediction_dir

Inputs are CSV (header) or parquet; ``--dictionary`` builds the CSV schema from the data dictionary instead of
inferring it. Numeric feature columns are every numeric column except the id, the raw outcome and the label.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from kestrel.operators import models as L
from kestrel.operators.ensemble import SoftVotingClassifier, StackingClassifier
from kestrel.operators.gam import BinnedAdditiveClassifier
from kestrel.operators.preprocess import numeric_columns

MODELS = {
    "logreg": lambda: L.logistic(max_iter=1000),
    "logreg_l1": lambda: L.logistic(penalty="l1", max_iter=1000),
    "naive_bayes": L.gaussian_nb,
    "rbf_svm": L.rbf_svm,
    "mlp": L.mlp,
    "gbt_leafwise": L.gbt_leafwise,
    "gbt_fixed": L.gbt_fixed,
    "gam": lambda: BinnedAdditiveClassifier(interactions=10),
    "vote_gbt_l1_nb": lambda: SoftVotingClassifier(
        [("gbt", L.gbt_leafwise()), ("lr_l1", L.logistic(penalty="l1")), ("nb", L.gaussian_nb())]),
    "vote_gbt_l1_mlp": lambda: SoftVotingClassifier(
        [("gbt", L.gbt_fixed(iterations=500)), ("lr_l1", L.logistic(penalty="l1")), ("mlp", L.mlp())],
        weights=[2, 1, 1]),
    "vote_lr_gbt": lambda: SoftVotingClassifier(
        [("lr", L.logistic(max_iter=200)), ("gbt", L.gbt_fixed(iterations=500))], weights=[1, 2]),
    "vote_lr_mlp": lambda: SoftVotingClassifier([("lr", L.logistic(max_iter=200)), ("mlp", L.mlp())]),
    "stack_lr_gbt": lambda: StackingClassifier(
        [("lr", L.logistic(max_iter=200)), ("gbt", L.gbt_fixed(iterations=500))], passthrough=True),
    "stack_lr_mlp": lambda: StackingClassifier([("lr", L.logistic(max_iter=200)), ("mlp", L.mlp())]),
}


def _read(spark: SparkSession, path: str, dictionary: str | None, labelled: bool) -> DataFrame:
    from kestrel.sources.tables import dictionary_schema, read_labelled, read_parquet

    if path.endswith(".parquet") or not path.endswith(".csv"):
        try:
            return read_parquet(spark, path)
        except FileNotFoundError:
            raise
        except Exception:  # noqa: BLE001 - not parquet: fall through to CSV
            pass
    schema = dictionary_schema(spark, dictionary, labelled) if dictionary else None
    return read_labelled(spark, path, schema)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="kestrel")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("experiment", "train", "score"):
        s = sub.add_parser(name)
        s.add_argument("--data", required=True)
        s.add_argument("--dictionary")
        s.add_argument("--id-col", default="id")
        s.add_argument("--label", default="y")
        s.add_argument("--outcome", default="shares")
        s.add_argument("--cat-cols", default="data_channel,weekday")
        s.add_argument("--seed", type=int, default=42)
        if name == "experiment":
            s.add_argument("--model", choices=sorted(MODELS), default="logreg")
            s.add_argument("--folds", type=int, default=5)
            s.add_argument("--cv-scope", choices=["trainval", "all"], default="trainval")
            s.add_argument("--parallelism", type=int, default=1)
            s.add_argument("--metrics-out")
        elif name == "train":
            s.add_argument("--out", required=True)
            s.add_argument("--n-iter", type=int, default=30)
            s.add_argument("--folds", type=int, default=5)
            s.add_argument("--search-iterations", type=int, default=1000)
            s.add_argument("--final-iterations", type=int, default=2000)
            s.add_argument("--patience", type=int, default=50)
            s.add_argument("--eval-on", choices=["validation", "holdout"], default="validation")
            s.add_argument("--fit-scope", choices=["train", "all"], default="train")
            s.add_argument("--derivations", choices=["news", "none"], default="news")
            s.add_argument("--parallelism", type=int, default=1)
        else:
            s.add_argument("--model", required=True)
            s.add_argument("--out", required=True)
            s.add_argument("--impute-scope", choices=["train", "batch"], default="train")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"kestrel-{a.job}").getOrCreate()
    from kestrel.session import ensure_checkpoint_dir, shared_dir

    if spark.sparkContext.master.startswith("local"):
        ensure_checkpoint_dir(spark)
    else:
        shared_dir(spark)
    cats = [c for c in a.cat_cols.split(",") if c]
    try:
        df = _read(spark, a.data, a.dictionary, labelled=a.job != "score")
    except FileNotFoundError as e:
        print(e, file=sys.stderr)
        return 2

    if a.job == "experiment":
        from kestrel.plans.experiment import report, run_experiment

        nums = numeric_columns(df, exclude=(a.id_col, a.outcome, a.label))
        m = run_experiment(df, MODELS[a.model](), nums, cats, name=a.model, label=a.label, id_col=a.id_col,
                           k=a.folds, seed=a.seed, cv_scope=a.cv_scope, parallelism=a.parallelism,
                           metrics_path=a.metrics_out)
        print(report(m))
    elif a.job == "train":
        from kestrel.functions.derive import NEWS_DERIVATIONS
        from kestrel.plans.search import search_report
        from kestrel.plans.train import train_tuned

        res = train_tuned(
            df, cats, NEWS_DERIVATIONS if a.derivations == "news" else (),
            "news" if a.derivations == "news" else None, label=a.label, id_col=a.id_col, drop_cols=(a.outcome,),
            n_iter=a.n_iter, k=a.folds, search_iterations=a.search_iterations, final_iterations=a.final_iterations,
            patience=a.patience, seed=a.seed, fit_scope=a.fit_scope, eval_on=a.eval_on, out_dir=a.out,
        )
        print(search_report(res.trials))
        print(f"early stopping kept {res.best_iteration} trees")
        res.importances.orderBy("importance", ascending=False).show(20, truncate=False)
        r = res.metrics.first()
        print(f"holdout accuracy={r.accuracy:.4f} f1={r.f1:.4f} roc_auc={r.roc_auc:.4f} "
              f"composite={r.composite:.4f}")
        for w in res.warnings:
            print(w, file=sys.stderr)
    else:
        from kestrel.plans.score import score
        from kestrel.sources.sinks import load_model, write_predictions

        try:
            model = load_model(a.model)
        except FileNotFoundError as e:
            print(e, file=sys.stderr)
            return 2
        n = write_predictions(score(df, model, a.id_col, a.impute_scope), a.out)
        print(f"{n} rows written to {a.out}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
