"""J3 — batch scoring: load model -> scan -> keep ids -> derive -> impute -> align -> class and probability ->
write ``id, y_predict, y_prob``.

With training-time medians (default) the whole job is one narrow stage: no shuffle, no aggregate. The reference
fills numeric gaps with the medians of the scored batch itself; ``impute_scope='batch'`` reproduces that with one
exact-median pass over the batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.columns import hard_class, positive_probability
from kestrel.operators.preprocess import TabularPreprocessorModel
from kestrel.operators.quantiles import exact_medians


def model_input_columns(model: PipelineModel) -> list[str]:
    """Columns the saved pipeline expects (numeric + categorical inputs of its imputer stage)."""
    for st in model.stages:
        if isinstance(st, TabularPreprocessorModel):
            return list(st.getOrDefault(st.numCols)) + list(st.getOrDefault(st.catCols))
    return []


def align(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ("id",)) -> DataFrame:
    """Reorder to the model's columns; a missing column is an error naming it; extras are dropped."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"Column mismatch between the data and the model features: missing {missing}")
    return df.select(*[c for c in keep if c in df.columns], *columns)


def _batch_medians(model: PipelineModel, df: DataFrame) -> PipelineModel:
    stages = []
    for st in model.stages:
        if isinstance(st, TabularPreprocessorModel):
            cols = st.getOrDefault(st.numCols)
            med = exact_medians(df, cols)
            st = st.copy()
            st._set(numFill=[med[c] if med[c] is not None else f for c, f in zip(cols, st.getOrDefault(st.numFill))])
        stages.append(st)
    return PipelineModel(stages=stages)


def score(df: DataFrame, model: PipelineModel, id_col: str = "id", impute_scope: str = "train") -> DataFrame:
    from kestrel.functions.derive import FeatureDeriver

    derived = df
    rest = []
    for st in model.stages:  # derivations first, so alignment sees the derived columns
        if isinstance(st, FeatureDeriver) and not rest:
            derived = st.transform(derived)
        else:
            rest.append(st)
    cols = model_input_columns(model)
    aligned = align(derived, cols, keep=(id_col,))
    scoring = PipelineModel(stages=rest)
    if impute_scope == "batch":
        scoring = _batch_medians(scoring, aligned)
    out = scoring.transform(aligned)
    p = positive_probability("probability")
    return out.select(F.col(id_col).cast("long").alias("id"), hard_class(p).alias("y_predict"), p.alias("y_prob"))


def score_to_csv(df: DataFrame, model_dir: str, out_path: str, impute_scope: str = "train") -> int:
    from kestrel.sources.sinks import load_model, write_predictions

    model = load_model(model_dir)
    return write_predictions(score(df, model, impute_scope=impute_scope), out_path)
