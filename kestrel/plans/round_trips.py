"""Registered queries that go through files of the shared folder: labelled and unlabelled CSV scans with a schema from a
written data dictionary (S1, S2, S4), batch scoring with a saved and loaded model (S9, S10), and the prediction sink (S5).
What is read back is compared with the same SQL as the queries without files."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.columns import r6
from kestrel.operators.preprocess import TabularPreprocessor
from kestrel.operators.splits import TRAIN, stratified_split
from kestrel.session import cut_lineage, ensure_checkpoint_dir
from kestrel.sources.fixtures import ART_CAT, ART_NUM, art
from kestrel.sources.sinks import load_model, save_model, write_predictions, write_table
from kestrel.sources.tables import read_dictionary, read_labelled, read_unlabelled, schema_from_dictionary

# The view's columns under names of the data dictionary that have the same types.
AS_TEXT = {"cat1": "data_channel", "cat2": "weekday"}
COLUMNS = ["id", *ART_NUM, *ART_CAT, "shares", "y"]


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/round-trip-{uuid.uuid4().hex}"


def _as_csv(spark: SparkSession, sf: str, folder: str, labelled: bool) -> DataFrame:
    """The view written as CSV, and scanned with the schema of a dictionary that was written beside it."""
    names = [AS_TEXT.get(c, c) for c in COLUMNS]
    rows = art(spark, sf).select(*[F.col(c).alias(n) for c, n in zip(COLUMNS, names, strict=True)])
    kept = rows.columns if labelled else [n for n in names if n not in ("shares", "y")]
    write_table(rows.select(*kept), f"{folder}/rows", fmt="csv")
    entries = [(i, f"{n} ", "a column") for i, n in enumerate(names)]
    write_table(spark.createDataFrame(entries, "No int, Variable string, Description string").coalesce(1), f"{folder}/dictionary", fmt="csv")
    listed = [r.Variable for r in read_dictionary(spark, f"{folder}/dictionary").orderBy("No").collect()]  # a row per column
    read = read_labelled if labelled else read_unlabelled
    scanned = read(spark, f"{folder}/rows", schema_from_dictionary(listed, labelled))
    return scanned.withColumnsRenamed({v: k for k, v in AS_TEXT.items()})


def q_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = _as_csv(spark, sf, _folder(spark), labelled=True)
    return rows.select("id", F.col("y").cast("double").alias("label"), *[r6(F.col(c)).alias(c) for c in ART_NUM], *ART_CAT)


def q_score_files(spark: SparkSession, sf: str) -> DataFrame:
    from kestrel.operators.models import gaussian_nb
    from kestrel.plans.score import score

    folder = _folder(spark)
    rows = cut_lineage(stratified_split(cut_lineage(art(spark, sf).select(*COLUMNS)), "y", "id", 0.2, 5, 42))
    train = rows.where(F.col("split") == TRAIN).withColumn("label", F.col("y").cast("double"))
    pre = TabularPreprocessor(numCols=list(ART_NUM), catCols=list(ART_CAT)).fit(train)
    failed = save_model(PipelineModel([pre, gaussian_nb().fit(pre.transform(train))]), f"{folder}/model")
    if failed:
        raise RuntimeError(failed)
    write_predictions(score(_as_csv(spark, sf, folder, labelled=False), load_model(f"{folder}/model")), f"{folder}/predictions")
    back = spark.read.csv(f"{folder}/predictions", header=True, schema="id bigint, y_predict int, y_prob double")
    return back.select("id", "y_predict", r6(F.col("y_prob")).alias("y_prob"))


ROUND_TRIPS: dict[str, Callable[[SparkSession, str], DataFrame]] = {"csv_scan": q_csv_scan, "score_files": q_score_files}
