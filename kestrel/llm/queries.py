"""The registered queries of the training-data operators: thin wrappers with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import (
    bpe, html_extract, importance, jaccard, license_scan, line_dedup, lm, merkle, mixing, nn_descent, piece,
    quality, topk,
)
from kestrel.llm.common import crc_mod, read


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.line_dedup(docs, host_col="source")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(read(spark, sf_dir, "embeddings"))


def op3_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    codec = bpe.prepare(docs, public_tokenizers.path("byte_bpe_50k.json"))
    out = bpe.encode(docs, codec, keep=["doc_id"], decoded=True)
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return license_scan.scan(docs, "text", keep=["doc_id"]).drop("spans")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.classify(docs, read(spark, sf_dir, "labels"), keep=["doc_id"])
    return out.select("doc_id", "held_out", "score", "predicted")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), keep=["doc_id"])


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.join(docs).select("doc_id", "class_id", "n_links", "kept")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return importance.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    hit = F.col("doc_id").isNotNull() & (crc_mod("doc_id", 7) == 0)
    tampered = {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return merkle.manifest(docs, tampered=tampered).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_sentencepiece_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    codec = piece.prepare(docs, public_tokenizers.path("piece_bpe_32k.model"))
    out = piece.encode(docs, codec, keep=["doc_id"], end=True, decoded=True)
    return out.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2(F.array_join(F.col("ends").cast("array<string>"), " ").cast("binary"), 256).alias("spans_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_line_dedup": op1_line_dedup,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_bpe_roundtrip": op3_bpe_roundtrip,
    "op4_license_scan": op4_license_scan,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_html_extraction": op6_html_extraction,
    "op7_exact_topk": op7_exact_topk,
    "op8_source_mixing": op8_source_mixing,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_sentencepiece_roundtrip": op13_sentencepiece_roundtrip,
}

# Where SQL cannot express a query (trained models, merges, graph refinement, parsing), tests hold it against brute force.
ORACLE: dict[str, str] = {
    "op1_line_dedup": line_dedup.oracle_sql(),
    "op4_license_scan": license_scan.oracle_sql(),
    "op7_exact_topk": topk.oracle_sql(),
    "op8_source_mixing": mixing.oracle_sql(),
    "op11_importance_resampling": importance.oracle_sql(),
    "op12_merkle_manifest": merkle.oracle_sql(),
}
