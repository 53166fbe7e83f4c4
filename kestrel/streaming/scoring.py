"""J3 over a stream: the saved scoring pipeline is a narrow, stateless projection (derive, impute with training
statistics, encode, predict), so the same model scores rows arriving as files in a folder.

No watermark or state is involved; the query's progress is kept in ``progress_dir`` (by default a folder of the query's
name in ``spark.checkpoint.dir``), so a restarted driver resumes without rescoring or skipping files. ``impute_scope='batch'`` is not offered
here: medians of an unbounded input are not defined.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from kestrel.plans.score import score
from kestrel.session import shared_dir
from kestrel.sources.sinks import load_model


def start_scoring_stream(
    spark: SparkSession,
    model_dir: str,
    source_dir: str,
    schema: StructType,
    sink_dir: str,
    fmt: str = "parquet",
    query_name: str = "kestrel_scoring",
    max_files_per_trigger: int | None = None,
    progress_dir: str | None = None,
) -> StreamingQuery:
    model = load_model(model_dir)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.option("header", True).csv(source_dir) if fmt == "csv" else reader.parquet(source_dir)
    progress = progress_dir or f"{shared_dir(spark).rstrip('/')}/{query_name}"
    return (
        score(rows, model)
        .writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", progress)
        .outputMode("append")
        .queryName(query_name)
        .start()
    )
