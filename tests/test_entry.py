"""Driver contract: entry() runs on sf0.001; queries() and oracle_sql() line up."""

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 7  # 5 folds + cv_mean + holdout
    assert df.columns == ["experiment", "scope", "fold", "accuracy", "f1", "roc_auc", "composite"]
    assert all(0.0 <= r.roc_auc <= 1.0 for r in rows)


def test_registry_lines_up():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 30
