"""Line dedup: against its SQL and a plain version on awkward rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kestrel.llm import line_dedup
from kestrel.llm.queries import op1_line_dedup

SF = "/root/testdata/sf0.001"


def brute(rows, ratio, least):
    """rows: (source, text) -> texts"""
    pages = defaultdict(set)
    for s, t in rows:
        if t is not None:
            pages[s].add(t)
    bad = {}
    for s, texts in pages.items():
        n = Counter(x for t in texts for x in {y.strip(" ") for y in t.split("\n")} if x)
        bad[s] = {x for x, c in n.items() if c >= least and c > ratio * len(texts)}
    return [None if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in bad[s]) for s, t in rows]


ROWS = (
    [(i, "a", f"own {i}\nboiler plate \n\nlast {i % 7}") for i in range(60)]
    + [(100 + i, "b", "same page\nagain") for i in range(50)]  # copies of a page count once
    + [(200, None, "x\ny"), (201, None, "x\nz"), (202, None, "x"), (203, None, None), (204, "a", ""), (205, "a", "\n\n"), (206, "c", "boiler plate")]
    + [(207, "a", "boiler plate"), (207, "a", "boiler plate"), (None, "a", "boiler plate\n" * 500 + "end"), (208, "", "x"), (209, "a", "é\r\nboiler plate\t")]
)


@pytest.mark.parametrize("ratio,least", [(0.05, 3), (0.0, 1), (0.6, 2), (1.0, 1)])
def test_equals_plain_version(spark, ratio, least):
    df = spark.createDataFrame([(k, *r, "x") for k, r in enumerate(ROWS)], "k long, doc_id long, source string, text string, host_key string").repartition(6)
    got = line_dedup.line_dedup(df, max_ratio=ratio, min_pages=least).orderBy("k").collect()
    want = brute([(s, t) for _, s, t in ROWS], ratio, least)
    assert [r.text for r in got] == want
    for r, (_, _, t) in zip(got, ROWS, strict=True):
        assert r.n_lines == (0 if t is None else t.count("\n") + 1) and r.host_key == "x"
        assert r.n_dropped >= 0 and (t is None or (r.n_dropped == 0) == (r.text == t))


def test_sql_and_query_agree_on_awkward_rows(spark, tmp_path, oracle):
    df = spark.createDataFrame(ROWS, "doc_id long, source string, text string")
    want = oracle(line_dedup.oracle_sql(), tmp_path, documents=df)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = op1_line_dedup(spark, str(tmp_path)).collect()
    key = lambda r: str((r["doc_id"], r["source"], r["text"], r["n_lines"], r["n_dropped"]))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_length_column_empty_table_and_clash(spark):
    df = spark.createDataFrame([("s", "é\né", 9)] * 3 + [("s", "é\nu", 9), ("s", "é\nv", 9)], "source string, text string, n_chars long")
    out = line_dedup.line_dedup(df, max_ratio=0.9, length_col="n_chars").collect()
    assert all(r.n_chars == len(r.text) and "é\n" not in r.text for r in out)
    assert line_dedup.line_dedup(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        line_dedup.line_dedup(df.withColumn("n_lines", F.lit(1)))


def test_site_lines_below_five_percent_go_and_rare_lines_stay(spark, tmp_path, oracle):
    # host a: 400 pages with a footer on 3 %, a legitimate line on 9 pages; host b: 60 pages with a line on 3 (5 %)
    rows = [(i, "a", f"own {i}" + "\nfooter" * (i < 12) + "\nlegitimate" * (i % 45 == 7)) for i in range(400)]
    rows += [(1000 + i, "b", f"own {i}" + "\nlegitimate" * (i < 3) + "\nmenu" * (i < 4)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.text for r in op1_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {i: t.replace("\nfooter", "").replace("\nmenu", "") for i, _, t in rows}
    assert got == {r["doc_id"]: r["text"] for r in oracle(line_dedup.oracle_sql(), tmp_path, documents=df)}
