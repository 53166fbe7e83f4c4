"""Importance resampling: equal to plain Python over whole texts (also with n-grams across lines), and to SQL."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import pytest
from pyspark.sql import functions as F

from kestrel.llm import importance, queries


def plain(docs, target, max_n, buckets, min_words, percent, seed):
    def features(text):
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
        return len(words), [crc32(r.encode()) % buckets for r in runs]

    s = Counter(b for _, t in docs for b in features(t)[1])
    t = Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in docs:
        n, fs = features(text)
        w = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in fs)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), n, w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((r for r in out if r[2] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(may[: len(may) * percent // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    pool = ["", "The cat sat", "a", "été 12 x_y", "don't STOP now", "w " * 40, "\t", "z-z z"] + [
        " ".join(rng.choice(["alpha", "Beta", "gamma", "δ", "7"]) for _ in range(rng.randrange(9))) for _ in range(12)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(8)))) for i in range(n)]
    return docs + [(n, None), (n + 1, ""), (n + 2, "\n\n\n"), (n + 3, "long " * 60_000 + "\n" + "x" * 50_000), (None, "b " * 30),
                   (3, "again " * 25), (n + 4, "a\nb\nc\nd\ne" * 9)]


@pytest.mark.parametrize("max_n", [1, 2, 3, 4])
def test_equal_to_plain_python(spark, max_n):
    docs, target = corpus(60, max_n), ["Alpha beta\ngamma alpha", "δ 7 7\nthe cat", None, ""]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"bucket": F.lit(1), "rank": F.lit("x")})
    tg = spark.createDataFrame([(t,) for t in target], "text string")
    out = importance.resample(df.repartition(5), tg, max_n=max_n, buckets=50, min_words=5, percent=40, seed=7)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert out.columns == ["doc_id", "n_features", "n_words", "weight", "score", "rank"]
    assert got == plain(docs, target, max_n, 50, 5, 40, 7)


def test_tables_of_distinct_lines_are_bounded(spark, monkeypatch):
    docs = corpus(80, 9)
    df, tg = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), spark.createDataFrame([("the cat\nsat",)], "text string")
    whole = [tuple(r) for r in importance.resample(df, tg, max_n=2, min_words=3).orderBy("doc_id", "weight").collect()]
    # inside a task: distinct lines are let go again and again
    feature = importance.Features(2, 10)
    feature.known = {b"%d" % i: 0 for i in range(importance.MEMO_WORDS + 1)}
    assert feature.of_line([b"a"]) == [crc32(b"a") % 10] and len(feature.known) == 1
    assert whole == [tuple(r) for r in importance.resample(df.repartition(9), tg, max_n=2, min_words=3).orderBy("doc_id", "weight").collect()]


def test_empty_tables_and_clash(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert importance.resample(none, one).count() == 0
    r = importance.resample(one, none).first()
    assert (r.n_features, r.rank) == (3, None) and r.weight == 3 * math.floor(1000 * math.log(10003 / 20000))
    with pytest.raises(ValueError):
        importance.resample(one.withColumn("rank", F.lit(1)), one, keep=["rank"])
    kept = importance.resample(one.withColumn("extra", F.lit("e")), one, keep=["text", "extra"], min_words=1, percent=100).first()
    assert (kept.text, kept.extra, kept.rank) == ("a b c", "e", 1)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    res = con.execute(queries.ORACLE["op11_importance_resampling"])
    names = [d[0] for d in res.description]
    out = queries.op11_importance_resampling(spark, sf)
    assert out.columns == names
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=str) == sorted(res.fetchall(), key=str) and any(r[-1] == 1 for r in got)
