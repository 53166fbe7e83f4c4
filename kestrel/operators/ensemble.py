"""Weighted soft voting (E1) and stacking (E2) as pyspark.ml estimators.

Members are applied one after another to the same rows; each member's P(y = 1) is kept in its own column and the
member's output columns are dropped before the next one, so the whole vote is one narrow plan per partition
(no join, no shuffle). Stacking fits each base on k-1 folds and scores the held-out fold (out-of-fold
probabilities are one value per row), unions the folds by name, fits the combiner, then refits the bases on all
rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.columns import hard_class, positive_probability
from kestrel.operators.persistence import CompositePersistence

OUTPUT_COLS = ("rawPrediction", "probability", "prediction")


def weighted_vote(probs: Sequence[Column], weights: Sequence[float] | None = None) -> Column:
    """sum(w_i * p_i) / sum(w_i); equal weights when none are given."""
    weights = list(weights) if weights is not None else [1.0] * len(probs)
    total = None
    for p, w in zip(probs, weights):
        term = F.lit(float(w)) * p
        total = term if total is None else total + term
    return total / F.lit(float(sum(weights)))


def with_probability(df: DataFrame, prob: Column, features_out: bool = False) -> DataFrame:
    """Standard classifier outputs from P(y = 1): probability vector, rawPrediction, prediction (ties -> 0)."""
    return df.withColumns(
        {
            "probability": array_to_vector(F.array(F.lit(1.0) - prob, prob)),
            "rawPrediction": array_to_vector(F.array(F.lit(1.0) - prob, prob)),
            "prediction": hard_class(prob).cast("double"),
        }
    )


def member_probability(model, df: DataFrame, out_col: str, features_col: str = "features") -> DataFrame:
    """Apply one fitted member and keep only its P(y = 1) as ``out_col``."""
    existing = [c for c in OUTPUT_COLS if c in df.columns]
    scored = model.transform(df.drop(*existing))
    extra = [c for c in scored.columns if c not in df.columns or c in OUTPUT_COLS]
    return scored.withColumn(out_col, positive_probability("probability")).drop(*[c for c in extra if c != out_col])


def _fit_all(members, df: DataFrame, parallelism: int):
    """Fit every member on ``df``; each fit uses its own copy, so concurrent fold fits share no estimator state."""
    if parallelism <= 1 or len(members) <= 1:
        return [est.copy().fit(df) for _, est in members]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=parallelism) as pool:  # concurrent Spark jobs from one driver
        return list(pool.map(lambda m: m[1].copy().fit(df), members))


class SoftVotingClassifier(Estimator):
    """Weighted mean of the members' P(y = 1); class = mean > 0.5 (argmax, ties to class 0)."""

    def __init__(self, members, weights=None, parallelism: int = 1):
        super().__init__()
        self.members = list(members)
        self.weights = list(weights) if weights is not None else [1.0] * len(self.members)
        self.parallelism = parallelism

    def _fit(self, dataset: DataFrame) -> "SoftVotingModel":
        return SoftVotingModel([n for n, _ in self.members], _fit_all(self.members, dataset, self.parallelism),
                               self.weights)


class SoftVotingModel(CompositePersistence, Model):
    def __init__(self, names=(), models=(), weights=()):
        super().__init__()
        self.names, self.models, self.weights = list(names), list(models), list(weights)

    def _children(self):
        return {f"member_{i}": m for i, m in enumerate(self.models)}

    def _state(self):
        return {"names": self.names, "weights": [float(w) for w in self.weights]}

    @classmethod
    def _restore(cls, state, children):
        n = len(state["names"])
        return cls(state["names"], [children[f"member_{i}"] for i in range(n)], state["weights"])

    def member_probabilities(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for name, m in zip(self.names, self.models):
            out = member_probability(m, out, f"p_{name}")
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.member_probabilities(dataset)
        p = weighted_vote([F.col(f"p_{n}") for n in self.names], self.weights)
        return with_probability(out.withColumn("y_vote", p), F.col("y_vote")).drop(
            "y_vote", *[f"p_{n}" for n in self.names]
        )


class StackingClassifier(Estimator):
    """Out-of-fold P(y = 1) of each base (stratified ``cv`` folds) -> combiner; bases refit on all rows.

    ``passthrough`` appends the original features to the combiner's input.
    """

    def __init__(self, members, final=None, cv: int = 5, passthrough: bool = False, id_col: str = "id",
                 label_col: str = "label", features_col: str = "features", parallelism: int = 1, seed="stack"):
        super().__init__()
        from kestrel.operators.models import logistic

        self.members = list(members)
        self.final = final if final is not None else logistic(max_iter=100)
        self.cv, self.passthrough, self.id_col = cv, passthrough, id_col
        self.label_col, self.features_col, self.parallelism, self.seed = label_col, features_col, parallelism, seed

    def _meta_assembler(self):
        from pyspark.ml.feature import VectorAssembler

        cols = [f"p_{n}" for n, _ in self.members] + ([self.features_col] if self.passthrough else [])
        return VectorAssembler(inputCols=cols, outputCol="__meta")

    def out_of_fold(self, folded: DataFrame) -> DataFrame:
        """One row per input row: each base's P(y = 1) from the model fitted without that row's fold."""
        parts = []
        for j in range(self.cv):
            tr, va = folded.where(F.col("__fold") != j), folded.where(F.col("__fold") == j)
            models = _fit_all(self.members, tr, self.parallelism)
            for (name, _), m in zip(self.members, models):
                va = member_probability(m, va, f"p_{name}", self.features_col)
            parts.append(va.select(self.id_col, self.label_col, self.features_col, "__fold",
                                   *[f"p_{n}" for n, _ in self.members]))
        oof = parts[0]
        for p in parts[1:]:
            oof = oof.unionByName(p)
        return oof

    def fold(self, dataset: DataFrame) -> DataFrame:
        from kestrel.operators.splits import kfold

        return kfold(dataset.withColumn("__y", F.col(self.label_col).cast("int")), self.cv, "__y", self.id_col,
                     self.seed, fold_col="__fold")

    def _fit(self, dataset: DataFrame) -> "StackingModel":
        from kestrel.session import fit_frame

        folded_cached, folded, _ = fit_frame(self.fold(dataset))
        oof = self.out_of_fold(folded)
        meta_cached, meta, _ = fit_frame(self._meta_assembler().transform(oof))  # the combiner iterates over it
        final = self.final.copy()
        if hasattr(final, "_set") and final.hasParam("featuresCol"):
            final._set(featuresCol="__meta")
        final_model = final.fit(meta)
        bases = _fit_all(self.members, dataset, self.parallelism)
        meta_cached.unpersist()
        folded_cached.unpersist()
        return StackingModel([n for n, _ in self.members], bases, final_model, self._meta_assembler())


class StackingModel(CompositePersistence, Model):
    def __init__(self, names=(), bases=(), final=None, assembler=None):
        super().__init__()
        self.names, self.bases, self.final, self.assembler = list(names), list(bases), final, assembler

    def _children(self):
        return {**{f"base_{i}": m for i, m in enumerate(self.bases)}, "final": self.final, "assembler": self.assembler}

    def _state(self):
        return {"names": self.names}

    @classmethod
    def _restore(cls, state, children):
        n = len(state["names"])
        return cls(state["names"], [children[f"base_{i}"] for i in range(n)], children["final"], children["assembler"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for name, m in zip(self.names, self.bases):
            out = member_probability(m, out, f"p_{name}")
        scored = self.final.transform(self.assembler.transform(out))
        return scored.drop("__meta", *[f"p_{n}" for n in self.names])
