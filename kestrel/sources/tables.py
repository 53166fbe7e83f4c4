"""Scans (S1-S4) and the schema that the data dictionary drives.

The labelled and unlabelled CSVs are read with a fixed ``StructType`` built from the dictionary (no inference
pass over the data): names trimmed, ``id``/``shares`` long, ``y`` int, the two categoricals string, every other
feature double. Blank fields read as NULL. A missing path raises ``FileNotFoundError`` with a clear message.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

# Roles of the named columns in the news-popularity dictionary.
ID_COL = "id"
OUTCOME_COL = "shares"
TARGET_COL = "y"
CATEGORICAL_COLS = ("data_channel", "weekday")
DICTIONARY_SCHEMA = StructType(
    [StructField("No", IntegerType()), StructField("Variable", StringType()), StructField("Description", StringType())]
)


def _guard(read, path: str, what: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"no {what} at {path}") from e
        raise


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``No, Variable, Description`` with names trimmed (the file has trailing spaces on two names)."""
    df = _guard(lambda: spark.read.csv(path, header=True, schema=DICTIONARY_SCHEMA), path, "data dictionary")
    return df.withColumn("Variable", F.trim("Variable"))


def schema_from_dictionary(names: list[str], labelled: bool = True) -> StructType:
    fields = []
    for n in names:
        if n == ID_COL or n == OUTCOME_COL:
            t = LongType()
        elif n == TARGET_COL:
            t = IntegerType()
        elif n in CATEGORICAL_COLS:
            t = StringType()
        else:
            t = DoubleType()
        if labelled or n not in (OUTCOME_COL, TARGET_COL):
            fields.append(StructField(n, t, True))
    return StructType(fields)


def dictionary_schema(spark: SparkSession, path: str, labelled: bool = True) -> StructType:
    names = [r.Variable for r in read_dictionary(spark, path).orderBy("No").collect()]  # 49 rows
    return schema_from_dictionary(names, labelled)


def read_labelled(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Labelled table. Without a schema, types are inferred (one extra pass) as the reference does."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return _guard(lambda: reader.csv(path), path, "labelled table")


def read_unlabelled(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Unlabelled table (id + features)."""
    return read_labelled(spark, path, schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return _guard(lambda: spark.read.parquet(path), path, "parquet table")


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Hash-spread an input that has fewer scan splits than the cluster has cores (e.g. a one-row-group file), so
    per-row work (md5 draws, derivations) runs on every core. A large table already has many splits and is returned
    unchanged, so no shuffle is added at scale. Checking the split count plans the scan; it runs no job."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - sessions without RDD access: leave the plan to the optimizer
        return df
    if splits >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)
