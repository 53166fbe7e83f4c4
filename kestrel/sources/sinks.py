"""Sinks (S5-S9) and model load.

Writes are distributed (one file per partition into a directory), never gathered on the driver. Row counts are
read back from the written output (a count alone).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_predictions(pred: DataFrame, path: str, fmt: str = "csv", id_col: str = "id") -> int:
    """``id, y_predict, y_prob`` with a header; returns the number of rows written."""
    out = pred.select(F.col(id_col).cast("long").alias("id"), F.col("y_predict").cast("int").alias("y_predict"),
                      F.col("y_prob").cast("double").alias("y_prob"))
    writer = out.write.mode("overwrite")
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path))
    # counted from the output: a session that has observed a metric can no longer serialise a logistic model with its
    # training summary, which would fail later fits
    reader = pred.sparkSession.read
    return (reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)).count()


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Importances, metrics (append per experiment with mode='append'), preprocessed table."""
    writer = df.write.mode(mode)
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path))


def write_preprocessed(df: DataFrame, fitted_preprocessor, path: str, fmt: str = "parquet",
                       keep=("id", "y")) -> None:
    """The fitted preprocessing applied to ``df`` as flat columns (imputed, scaled, one-hot), written out."""
    flat = fitted_preprocessor.copy()
    flat._set(outputMode="columns")
    out = flat.transform(df).select(*[c for c in keep if c in df.columns], *flat.feature_names())
    write_table(out, path, fmt=fmt)


def save_model(model: PipelineModel, path: str) -> str | None:
    """Save; returns an error message instead of raising, as the reference reports and continues."""
    try:
        model.write().overwrite().save(path)
        return None
    except Exception as e:  # noqa: BLE001 - reported to the caller
        return f"the model could not be written to {path}: {e}"


def load_model(path: str) -> PipelineModel:
    """Existence check, then load with a clear error."""
    spark = SparkSession.getActiveSession()
    where = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - the session's file system decides, not the driver's disk
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):  # noqa: SLF001
        raise FileNotFoundError(f"no saved model in {path}; train and save one before scoring")
    try:
        return PipelineModel.load(path)
    except Exception as e:  # noqa: BLE001
        raise RuntimeError(f"the model in {path} could not be read: {e}") from e
