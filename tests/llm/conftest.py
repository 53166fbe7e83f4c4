import duckdb
import pytest


@pytest.fixture
def oracle():
    """oracle(sql, **tables): rows of DuckDB SQL as dicts; tables are Spark data frames or folders of parquet."""

    def run(sql, tmp, **frames):
        con = duckdb.connect()
        for name, df in frames.items():
            df.write.parquet(f"{tmp}/{name}")
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp}/{name}/*.parquet')")
        res = con.execute(sql)
        names = [d[0] for d in res.description]
        return [dict(zip(names, r, strict=True)) for r in res.fetchall()]

    return run
