"""Corpus pipeline: every stage against a plain version of it, on the given documents and on awkward rows."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from kestrel.llm import jaccard
from .test_bpe import LIB
from .test_jaccard import brute
from .test_line_dedup import brute as lines_brute
from .test_mixing import fill, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _stages(spark, sf, tmp):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp}/{name}")
        docs = spark.read.parquet(f"{tmp}/{name}")
        out.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
    return out


def _check(start, good, lined, single, mixed, encoded):
    ids = {(r.doc_id, r.text) for r in start}
    assert all((r.doc_id, r.text) in ids for r in good)
    texts = Counter(str((r.doc_id, r.source, t)) for r, t in zip(good, lines_brute([(r.source, r.text) for r in good], 0.05, 3), strict=True))
    assert texts == Counter(str((r.doc_id, r.source, r.text)) for r in lined)
    groups = brute([(r.doc_id, r.text) for r in lined])
    firsts = {(lined[i].doc_id, lined[i].text) for i, (c, _) in groups.items() if c == lined[i].doc_id}
    assert sorted(map(str, firsts)) == sorted(str((r.doc_id, r.text)) for r in single)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in single:
        sizes[r.source] += words(r.text)
    for r in mixed:
        taken[r.source] += words(r.text)
    for s, want in fill(sizes).items():
        assert abs(taken[s] - want) <= 1
    assert max(Counter(str(r.doc_id) for r in mixed if r.doc_id is not None).values(), default=0) <= 2
    assert Counter((r.doc_id, r.n_chars) for r in mixed) == Counter((r.doc_id, r.n_chars) for r in encoded)
    want = Counter()
    for r in mixed:
        assert r.n_chars == len(r.text)
        got = np.array(LIB.encode(r.text, add_special_tokens=False).ids, "<u4")
        want[r.doc_id, got.tobytes(), len(got), hashlib.sha256(r.text.encode()).hexdigest()] += 1
    assert want == Counter((r.doc_id, bytes(r.ids), r.n_tokens, r.decoded_sha256) for r in encoded)


def test_stages_on_the_given_documents(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    out = _stages(spark, sf, tmp_path)
    _check(*out)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in out[1]}
    assert all(i in kept for i, q in labels.items() if q == 1)


def test_stages_on_awkward_rows(spark, tmp_path):
    rows = [(i, f"the quick words number {i} are good and new {i * 7}", "en", f"s{i % 4}", 0) for i in range(80)]
    rows += [(100 + i, "one and the same text of a large group of copies", "en", "hot", 0) for i in range(60)]
    rows += [(200 + i, "!!! ### " * 9, "en", "junk", 0) for i in range(40)]
    rows += [(300, None, None, None, None), (301, "", "en", None, 0), (None, "a text without an id", "en", "s1", 1), (302, "rep", "en", "s1", 3),
             (302, "rep", "en", "s1", 3), (303, "long " * 40_000, "en", "s2", 7)]
    sf = str(tmp_path / "in")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, int(not 200 <= i < 240)) for i in range(240)], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    out = _stages(spark, sf, tmp_path)
    assert not any(r.doc_id is not None and 200 <= r.doc_id < 240 for r in out[1])
    assert sum(r.doc_id is not None and 100 <= r.doc_id < 160 for r in out[3]) == 1
    assert sum(r.doc_id == 302 for r in out[3]) <= 1
    _check(*out)


def test_run_and_empty_table(spark, tmp_path):
    sf = str(tmp_path / "in")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
    assert jaccard.THRESHOLD == 0.8
    with pytest.raises(Exception):
        corpus_pipeline.run(spark, str(tmp_path / "nowhere"))
