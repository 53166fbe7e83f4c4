"""LM scoring against a plain in-memory model; weights from the same cells; blocks must not matter."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kestrel.llm import lm
from kestrel.llm.queries import op10_lm_scoring

SF = "/root/testdata/sf0.001"


def _tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


def _crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def brute(rows, deleted):
    """rows: (id, text); deleted: ids whose training counts are held out -> {index: result}"""
    docs = [_tokens(t) for _, t in rows]
    train = [_crc(i) % 5 != 1 for i, _ in rows]

    def count(use):
        uni, bi = Counter(), Counter()
        for d, u in zip(docs, use, strict=True):
            if u:
                uni.update(d)
                bi.update(zip(["\n", *d], d))
        return uni, bi

    uni, bi = count(train)
    n, v = sum(uni.values()), len(uni)
    main_uni, main_bi = count([t and not d for t, d in zip(train, deleted, strict=True)])
    n_main = sum(main_uni.values())
    step = lambda r: 0 if r <= 0 else max(1, round(math.log2(r) * lm.STEP) + 32)
    cells = Counter()
    for d, t, x in zip(docs, train, deleted, strict=True):
        if t and x:
            for h, w in zip(["\n", *d], d):
                f2 = main_bi[h, w] / main_uni[h] if main_uni[h] else 0
                cells[main_uni[h].bit_length(), step(f2 * (v + 1)), step(main_uni[w] / max(n_main, 1) * (v + 1))] += 1
    weights = lm.fit(sorted((*c, k) for c, k in cells.items()))
    out = []
    for d in docs:
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in d)
        score = 0.0
        for h, w in zip(["\n", *d], d):
            l0, l1, l2 = weights[uni[h].bit_length()]
            if not n:
                p = 1 / (v + 1)
            elif uni[h]:
                p = l0 / (v + 1) + l1 * uni[w] / n + l2 * bi[h, w] / uni[h]
            else:
                p = (l0 / (v + 1) + l1 * uni[w] / n) / (l0 + l1)
            score += math.log10(p)
        out.append((len(d), sum(uni[w] > 0 for w in d), n, base, score))
    return out, weights


def _deleted(spark, ids):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(k, i) for k, i in enumerate(ids)], "k long, doc_id long")
    mark = F.pmod(F.xxhash64(F.lit("deleted"), F.col("doc_id")), F.lit(10)) == 0
    return [r.m for r in df.select("k", mark.alias("m")).orderBy("k").collect()]


def _check(got, rows, want):
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score, r.held_out))
    assert sum(map(len, by.values())) == len(rows)
    for (i, _), w in zip(rows, want, strict=True):
        assert any(g[:3] == w[:3] and g[3] == pytest.approx(w[3], rel=1e-9) and g[4] == pytest.approx(w[4], rel=1e-9) for g in by[i]), i
        assert all(g[5] == (_crc(i) % 5 == 1) for g in by[i])


def test_query_equals_plain_model(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want, weights = brute(rows, _deleted(spark, [i for i, _ in rows]))
    _check(op10_lm_scoring(spark, SF).collect(), rows, want)
    assert np.allclose(weights.sum(axis=1), 1)
    held = [k for k, (i, _) in enumerate(rows) if _crc(i) % 5 == 1]
    assert sum(want[k][4] for k in held) > sum(want[k][3] for k in held)  # better than the base on held-out texts


def test_awkward_rows_and_many_blocks(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([None, "", " \t", "A a É", "the cat sat", "THE cat", "the cat sat", "x " * 3000, "été"] * 6)]
    rows += [(None, "no id"), (4, "the cat sat"), (4, "the cat sat")]
    spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score2 string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    want, _ = brute(rows, _deleted(spark, [i for i, _ in rows]))
    for limit in (1, 50, 1 << 21):
        _check(lm.score_documents(docs, block_tokens=limit).collect(), rows, want)


def test_empty_table_no_training_and_clash(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_documents(empty).count() == 0
    ids = [i for i in range(60) if _crc(i) % 5 == 1][:4]
    out = lm.score_documents(spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")).collect()
    assert all(r.score == 0 and r.train_tokens == 0 and r.n_known == 0 and r.n_tokens == 3 for r in out)
    with pytest.raises(ValueError):
        lm.score_documents(spark.createDataFrame([(1, "a", 1.0)], "doc_id long, text string, score double"), keep=["doc_id", "score"])


def test_weights_follow_the_held_out_events():
    at = int(np.log2(1000) * lm.STEP + 32)
    w = lm.fit([(5, at, at - 8, 10_000), (2, 0, at, 10_000)])
    assert w[5, 2] > 0.8 and w[2, 1] > 0.9 and np.allclose(w.sum(axis=1), 1)
    assert (w[9] == w[5]).all() and (w[3] == w[2]).all() and (w[0] == w[2]).all()


def test_any_input_gives_the_scores_of_files(spark, tmp_path):
    """Shuffled, cached, sorted and joined inputs are fixed before they are read again."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert lm.steady(docs) is docs
    want = {r.doc_id: r for r in lm.score_documents(docs).collect()}
    for other in (docs.repartition(7), docs.orderBy(F.desc("text")).cache(), docs.join(docs.select("doc_id").distinct(), "doc_id")):
        got = {r.doc_id: r for r in lm.score_documents(other).collect()}
        assert got.keys() == want.keys()
        for k, r in got.items():
            assert r[:4] == want[k][:4] and r.base_score == pytest.approx(want[k].base_score) and r.score == pytest.approx(want[k].score)
