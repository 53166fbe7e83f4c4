"""Corpus pipeline: documents through five training-data operators, each stage written and read again by its caller.

1. ``quality``: the quality classifier scores every document; those predicted to be of label 0 go.
2. ``lines``: lines that a source repeats on many of its documents are dropped; documents stay.
3. ``near_duplicates``: of each group of documents linked by n-gram Jaccard similarity the one with the smallest id stays.
4. ``mix``: sources are brought to their target weights; a document stands once for each time it is taken, and the
   document in which a source's budget ends gives its first words.
5. ``encode``: token ids of every text, packed, with their number, and the decoded text's digest.

The first four return the columns of ``documents``, with ``n_chars`` following the text.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import bpe, jaccard, line_dedup, mixing, quality
from kestrel.session import ensure_checkpoint_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, labels).where("predicted = 1").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(docs, host_col="source", length_col="n_chars").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicate(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.materialize(mixing.mix(docs), docs.columns, length_col="n_chars")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    codec = bpe.prepare(docs, TOKENIZER)
    out = bpe.encode(docs, codec, keep=["doc_id", "lang", "source", "n_chars"], decoded=True)
    return out.withColumn("decoded_sha256", F.sha2(F.col("decoded").cast("binary"), 256)).drop("decoded")


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mix", mixing_stage),
    ("encode", encoding_stage),
]

# Neither the trained classifier nor merges by rank can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written to the shared folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
