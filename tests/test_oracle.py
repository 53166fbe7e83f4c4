"""The correctness gate locally: every exact query equals its DuckDB oracle (sf0.001 for speed)."""

import math

import duckdb
import pytest

from kestrel.plans.catalog import EXACT
from kestrel.plans.jobs import JOBS
from kestrel.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "customer", "documents", "labels"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


ALL = {**EXACT, **JOBS}


def test_every_exact_query_has_an_oracle():
    assert set(EXACT) <= set(ORACLE) <= set(ALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = ALL[name](spark, SF)
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    drows = res.fetchall()
    order = [dcols.index(c) for c in sdf.columns]
    drows = [tuple(r[i] for i in order) for r in drows]
    assert _norm([tuple(r) for r in sdf.collect()]) == _norm(drows)
