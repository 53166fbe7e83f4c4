"""Quality classifier: held-out accuracy, FTRL against a plain version, awkward rows; labels and ids are no inputs."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import quality
from kestrel.llm.queries import op5_quality_classifier

SF = "/root/testdata/sf0.01"


def test_query_on_whole_table(spark):
    out = {r.doc_id: r for r in op5_quality_classifier(spark, SF).collect()}
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out.values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(out[i].score, q) for i, q in labels.items() if out[i].held_out]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([s >= 0.7 for s in good]) > 0.97


def test_ftrl_equals_a_plain_version():
    rng = np.random.default_rng(2)
    rows = [(np.sort(rng.choice(20, 5, replace=False)), rng.random(5), int(rng.integers(2))) for _ in range(30)]
    z, n = [0.0] * 21, [0.0] * 21

    def w(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(3):
        for s, v, y in rows:
            x = {**dict(zip(s.tolist(), v.tolist())), 20: 1.0}
            p = 1 / (1 + math.exp(-sum(w(i) * t for i, t in x.items())))
            for i, t in x.items():
                g = (p - y) * t
                old = w(i)
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * old
                n[i] += g * g
    assert np.allclose(quality.ftrl(rows, 20, 90), [w(i) for i in range(21)])


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_awkward_rows_and_no_leak(spark):
    rows = [(i, ("good words here " if i % 2 else "JUNK!! !! ") * (1 + i % 9), "en", "s") for i in range(400)]
    rows += [(1000, None, None, None), (1001, "", "x", "y"), (None, "good words", "x", "y"), (1, rows[1][1], "en", "s"), (1002, "é " * 50_000, "fr", "z")]
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(400)] + [(7, 0), (9, None), (None, 1), (9999, 1), (1000, 0)], "doc_id long, quality int")
    docs = _docs(spark, rows)
    out = quality.classify(docs, labels).collect()
    assert len(out) == len(rows)
    by = {(r.doc_id, r.text): r for r in out}
    assert by[1000, None].score == by[1001, ""].score
    assert all(r.predicted == r.doc_id % 2 for r in out if r.doc_id is not None and r.doc_id < 400)
    # other ids, languages and sources; the same texts: the same scores under the same weights
    weights = quality.train(docs, quality.training_labels(labels))
    moved = docs.withColumn("doc_id", F.col("doc_id") + 7).withColumn("lang", F.lit("q")).withColumn("source", F.lit("q"))
    a = sorted((r.text or "", r.score) for r in quality.score(docs, weights).collect())
    b = sorted((r.text or "", r.score) for r in quality.score(moved, weights).collect())
    assert a == b
    # held-out labels play no part
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    c = sorted((r.text or "", r.score) for r in quality.classify(docs, flipped).collect())
    assert sorted((r.text or "", r.score) for r in out) == c


def test_sample_bound_and_shards(spark):
    rows = [(i, "good words" if i % 2 else "JUNK !!", "en", "s") for i in range(3000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, quality int")
    w = quality.train(_docs(spark, rows), labels, max_train=500)
    scores = quality.score(_docs(spark, rows[:2]), w).collect()
    assert {r.doc_id: r.score > 0.5 for r in scores} == {0: False, 1: True}


def test_no_labels_empty_table_and_clash(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = _docs(spark, [(1, "a", "en", "s")])
    assert quality.classify(docs, none).first().score == 0.5
    assert quality.classify(docs.limit(0), none).count() == 0
    with pytest.raises(ValueError):
        quality.classify(docs.withColumn("score", F.lit(1)), none)
