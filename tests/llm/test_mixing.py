"""Mixing: water filling, exact budgets, SQL on awkward rows, rows of the mix."""

import re
from collections import defaultdict

import pytest

from kestrel.llm import mixing
from kestrel.llm.queries import op8_source_mixing


def fill(sizes, weights=(5.0, 2.0, 1.0), share=1.5, cap=2.0):
    """sizes by source -> targets, by repeated resharing"""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, rest = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        if not open_:
            return full
        level = rest / sum(w[s] for s in open_)
        over = [s for s in open_ if w[s] * level > cap * sizes[s] + 1e-9]
        if not over:
            return full | {s: w[s] * level for s in open_}
        for s in over:
            full[s] = cap * sizes[s]
            rest -= full[s]


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


ROWS = [(i, f"w{i} " * (i % 23), "abcdefg"[i % 7]) for i in range(700)]
ROWS += [(1000 + i, "hot " * (1 + i % 5), "hot") for i in range(600)] + [(2000 + i, "\tx\n y\xa0z ", None) for i in range(30)]
ROWS += [(3000, None, "empty"), (3001, "", "empty"), (3002, " long" * 20_000, "z"), (None, "no id", "a"), (None, "no id", "a"), (5, ROWS[5][1], "f"), (3003, "é", "")]


def check(rows, got):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    want, taken = fill(sizes), defaultdict(int)
    for r in got:
        assert r.size == words(r.text) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= 2.5, s  # rounding, and a cut among equal rows


@pytest.mark.parametrize("range_rows", [50, 1_000_000])
def test_targets_are_met(spark, range_rows):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(df, range_rows=range_rows).collect()
    assert len(got) == len(ROWS)
    check(ROWS, got)
    again = mixing.mix(df.repartition(3), range_rows=range_rows).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_ranges_do_not_change_the_mix(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    a, b = (sorted(str(r) for r in mixing.mix(df, range_rows=n).collect()) for n in (37, 10_000))
    assert a == b


def test_sql_and_query_agree_on_awkward_rows(spark, tmp_path, oracle):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    want = oracle(mixing.oracle_sql(), tmp_path, documents=df)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = op8_source_mixing(spark, str(tmp_path)).collect()
    key = lambda r: str((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_rows_of_the_mix(spark):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, source string, size2 string")
    mixed = mixing.mix(df)
    rows = mixing.materialize(mixed, ["doc_id", "text", "source"]).collect()
    per, got = defaultdict(int), defaultdict(int)
    for r in mixed.collect():
        per[r.doc_id, r.source] += r.taken
    originals = {(i, s): t for i, t, s in ROWS}
    for r in rows:
        got[r.doc_id, r.source] += words(r.text)
        assert originals[r.doc_id, r.source].startswith(r.text)
    assert {k: v for k, v in per.items() if v} == got


def test_other_weights_empty_and_zero(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, "", "y")], "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in mixing.mix(df, share=5.0, max_epochs=3).collect()}
    assert rows[1].taken == 6 and rows[2].taken == 0
    assert mixing.mix(df.limit(0)).count() == 0
    zero = mixing.mix(df.where("doc_id = 2")).collect()
    assert [(r.size, r.target, r.taken) for r in zero] == [(0, 0.0, 0)]
    with pytest.raises(ValueError):
        mixing.mix(df.withColumnRenamed("source", "size"), source_col="size")
