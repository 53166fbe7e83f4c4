"""Merkle manifest: equal to a plain recursive version and to SQL, for binary and wider trees, NULLs, ties, one leaf, none."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from kestrel.llm import merkle, queries
from kestrel.llm.ranks import numbered

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, extra=0):
    n = None if r["n_chars"] is None else r["n_chars"] + extra
    return h(*map(enc, (r["doc_id"], r["source"], r["lang"], n, r["text"])))


def plain_tree(hashes, k):
    """(root, siblings of every leaf from left to right, level by level)"""
    level, places, proofs = list(hashes), list(range(len(hashes))), [[] for _ in hashes]
    while len(level) > 1:
        for j, p in enumerate(places):
            run = p // k * k
            proofs[j] += [(q - p, level[q]) for q in range(run, min(run + k, len(level))) if q != p]
            places[j] = p // k
        level = [h(*level[i : i + k]) for i in range(0, len(level), k)]
    return level[0], [[s for _, s in p] for p in proofs]


def plain_fold(start, place, n, proof, k):
    at = 0
    while n > 1:
        run = place // k * k
        others = min(k, n - run) - 1
        beside, slot = proof[at : at + others], place - run
        start, at = h(*beside[:slot], start, *beside[slot:]), at + others
        place, n = place // k, -(-n // k)
    return start


def plain_manifest(rows, k, hit):
    out, subroots, langs = [], [], {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    order = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    trees = []
    for lang in order:
        own = sorted(langs[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        root, proofs = plain_tree([leaf(r) for r in own], k)
        subroots.append(root)
        trees.append((own, proofs))
    root, upper = plain_tree(subroots, k) if subroots else (None, [])
    for g, (own, proofs) in enumerate(trees):
        for i, (r, proof) in enumerate(zip(own, proofs)):
            given = leaf(r, 1 if hit(r) else 0)
            folded = plain_fold(plain_fold(given, i, len(own), proof, k), g, len(trees), upper[g], k)
            out.append((r["doc_id"], leaf(r), subroots[g], root, h(*proof, *upper[g]), folded, folded == root))
    return sorted(out, key=str)


def rows_of(n, langs, seed):
    rng = random.Random(seed)
    rows = [dict(doc_id=i, text=rng.choice([None, "", "Grüße\n東京", "x" * 3000, f"text {i}"]), lang=rng.choice(langs),
                 source=rng.choice([None, "a", "b"]), n_chars=rng.choice([None, 0, i])) for i in range(n)]
    return rows + [dict(rows[0]), dict(rows[0], text="other")] if rows else rows


@pytest.mark.parametrize("n,langs,arity", [
    (0, ["en"], 2), (1, ["en"], 2), (2, [None], 2), (37, ["en", "de", None, "é", "zz"], 2), (64, ["en"] * 9 + ["de"], 2),
    (40, ["en", "de", None], 3), (50, ["en"] * 5 + ["fr"], 4), (33, ["en", "de", "fr", "x", "y", None], 5),
])
def test_equal_to_the_plain_version(spark, n, langs, arity):
    rows = rows_of(n, langs, n)
    df = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    hit = F.col("doc_id") % 3 == 1
    out = merkle.manifest(df.withColumns({"root": F.lit(1), "g": F.lit("x")}), arity=arity, tampered={
        "n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})
    got = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in out.collect()]
    assert sorted(got, key=str) == plain_manifest(rows, arity, lambda r: r["doc_id"] % 3 == 1)


def test_a_single_row_is_its_own_root(spark):
    df = spark.createDataFrame([(None, None, None, None, None)], SCHEMA)
    r = merkle.manifest(df).first()
    assert r.leaf == r.subroot == r.root == r.folded_root == h("-" * 5)
    assert r.proof_sha256 == h("") and r.verified and len(r.path) == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    res = con.execute(queries.ORACLE["op12_merkle_manifest"])
    names = [d[0] for d in res.description]
    out = queries.op12_merkle_manifest(spark, sf)
    assert out.columns == names
    got = [tuple(r) for r in out.collect()]
    assert sorted(got) == sorted(res.fetchall()) and len({r[3] for r in got}) == 1
    assert {r[-1] for r in got} == {True, False}


def test_places_over_many_ranges(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"))
    out = numbered(df, [F.col("v").desc()], range_rows=300)
    got = {r.v: r.place for r in out.collect()}
    assert got == {v: i for i, v in enumerate(sorted(got, reverse=True))} and len(got) == 5000
