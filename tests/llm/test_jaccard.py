"""N-gram Jaccard join against brute force over all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest

from kestrel.llm import jaccard
from kestrel.llm.queries import op9_ngram_jaccard

SF = "/root/testdata/sf0.001"


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _grams(text, n=5):
    words = _lower(text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    n = min(n, len(words))
    return frozenset((n, *words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute(rows):
    """rows: (doc_id, text) -> {index: (class_id, n_links)}; blocks the pairs by shared grams."""
    sets = [_grams(t) for _, t in rows]
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            index[g].append(i)
    links = defaultdict(set)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in index[g]:
                common[j] += 1
        for j, c in common.items():
            if j != i and c >= 0.8 * (len(s) + len(sets[j]) - c):
                links[i].add(j)
    out, seen = {}, set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - group:
                group.add(j)
                todo.append(j)
        seen |= group
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        for j in group:
            out[j] = (min(ids) if ids else None, len(links[j]))
    return out


def _check(got, rows):
    want = brute(rows)
    assert sorted(str((r.doc_id, r.class_id, r.n_links)) for r in got) == sorted(str((rows[i][0], *want[i])) for i in want)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op9_ngram_jaccard(spark, SF).collect()
    _check(got, rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    rows, n = [], 0
    for size, copies in ((60, 150), (400, 30), (30, 12), (9, 9)):
        base = [word() for _ in range(size)]
        for k in range(copies):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                text[rnd.randrange(size)] = word()
            rows.append((n, " ".join(text)))
            n += 1
    passage = " ".join(word() for _ in range(40))
    for _ in range(60):  # a shared passage alone is no link
        rows.append((n, passage + " " + " ".join(word() for _ in range(rnd.randrange(5, 120)))))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (n + 3, "one two"), (n + 4, "One  TWO"), (n + 5, "one two three"), (n + 6, "é É"), (n + 7, "É é")]
    rows += [(None, rows[0][1]), (None, "alone here"), (3, rows[3][1]), (3, rows[3][1]), (n + 8, "x " * 9000 + "y")]
    return rows


def test_planted_groups_equal_brute_force(spark, planted):
    df = spark.createDataFrame(planted, "doc_id long, text string").repartition(7)
    for block in (512, 20):  # small blocks: many meetings per cluster
        _check(jaccard.join(df, block=block).collect(), planted)


def test_deduplicate_keeps_one_row_of_each_group(spark, planted):
    df = spark.createDataFrame([(i, t, "rep", 1) for i, t in planted], "doc_id long, text string, rep string, kept int")
    got = jaccard.deduplicate(df)
    assert got.columns == df.columns
    rows = got.collect()
    want = brute(planted)
    firsts = {(c, planted[i][1]) for i, (c, _) in want.items() if planted[i][0] == c}
    assert len(rows) == len({(r.doc_id, r.text) for r in rows})
    assert {(r.doc_id, r.text) for r in rows} == firsts


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.join(df).count() == 0
    assert jaccard.deduplicate(df).count() == 0


def test_bands_reach_the_target_recall():
    for rows in (3, 5, 7):
        b = jaccard.choose_bands(0.8, rows, 0.9999)
        assert 1 - (1 - 0.8**rows) ** b >= 0.9999 > 1 - (1 - 0.8**rows) ** (b - 1)
    rng = np.random.default_rng(1)
    hit = 0
    for _ in range(200):
        common = rng.integers(0, 1 << 62, 160, dtype=np.uint64)
        x, y = (np.unique(np.append(common, rng.integers(0, 1 << 62, 20, dtype=np.uint64))) for _ in range(2))
        hit += bool((jaccard.band_hashes(x, 24) == jaccard.band_hashes(y, 24)).any())
    assert hit >= 199
