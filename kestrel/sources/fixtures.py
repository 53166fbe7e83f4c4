"""Planted test views over the driver tables.

``art``  : orders joined to customer; NULLs and the label are planted from md5 draws so that Spark and DuckDB
           build identical rows. Columns: id, x1, x2, cat1, cat2, t0..t4, shares, y, score, p1, p2, p3.
``docs`` : documents joined to labels (skewed classes, no planted signal).

The join is expressed declaratively; Catalyst/AQE pick broadcast only when the customer side is measured small,
otherwise a sort-merge join on the customer key (AQE splits a hot key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.columns import md5_uniform

# Fixed values of the planted view (test fixture definition): the id moduli that plant NULLs per column.
ART_NULL_MODULI = {"x1": 11, "x2": 13, "cat1": 17, "cat2": 19}
ART_T_MODULUS = 7
ART_NUM = ("x1", "x2", "t0", "t1", "t2", "t3", "t4")
ART_CAT = ("cat1", "cat2")


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    from kestrel.sources.tables import spread

    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"), key)


def _null_when(col, cond):
    return F.when(cond, F.lit(None)).otherwise(col)


def art(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    j = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    i = F.col("o_orderkey")
    signal = (
        (F.col("o_totalprice") - F.lit(250000.0)) / F.lit(125000.0)
        + (F.col("c_acctbal") - F.lit(4500.0)) / F.lit(9000.0)
        + F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(0.5)).otherwise(F.lit(-0.125))
        + F.lit(2.0) * (md5_uniform(i, "y") - F.lit(0.5))
    )
    shares = F.floor(F.lit(1400.0) + F.lit(1000.0) * signal).cast("bigint")
    cols = {
        "id": i,
        "x1": _null_when(F.col("o_totalprice"), i % ART_NULL_MODULI["x1"] == 0),
        "x2": _null_when(F.col("c_acctbal"), i % ART_NULL_MODULI["x2"] == 0),
        "cat1": _null_when(F.col("o_orderpriority"), i % ART_NULL_MODULI["cat1"] == 0),
        "cat2": _null_when(F.col("c_mktsegment"), i % ART_NULL_MODULI["cat2"] == 0),
    }
    for k in range(5):
        cols[f"t{k}"] = _null_when(md5_uniform(i, f"t{k}"), i % ART_T_MODULUS == k)
    cols["shares"] = shares
    out = j.select(*[c.alias(n) for n, c in cols.items()])
    out = out.withColumn("y", F.when(F.col("shares") > 1400, F.lit(1)).otherwise(F.lit(0)))
    # Fixed score columns for metric and voting checks (no model needed): ties on purpose.
    out = out.withColumns(
        {
            "score": F.floor(F.lit(100.0) * (F.lit(0.35) * F.col("y") + F.lit(0.65) * md5_uniform("id", "s")))
            / F.lit(100.0),
            "p1": md5_uniform("id", "p1"),
            "p2": md5_uniform("id", "p2"),
            "p3": md5_uniform("id", "p3"),
        }
    )
    return out


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "inner").select(
        F.col("doc_id").alias("id"),
        "lang",
        "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.col("quality").cast("int").alias("y"),
    )


# DuckDB text of the same views, used by the oracle SQL.
U_SQL = "(cast(('0x' || substr(md5(concat(cast({id} as varchar), ':{seed}')), 1, 8)) as bigint) / 4294967296e0)"


def u_sql(seed: str, id_expr: str = "o_orderkey") -> str:
    return U_SQL.format(id=id_expr, seed=seed)


ART_SQL = f"""
art0 AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS x1,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE c_acctbal END AS x2,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS cat1,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE c_mktsegment END AS cat2,
    {", ".join(f"CASE WHEN o_orderkey % 7 = {k} THEN NULL ELSE {u_sql(f't{k}')} END AS t{k}" for k in range(5))},
    cast(floor(1400e0 + 1000e0*((o_totalprice-250000e0)/125000e0 + (c_acctbal-4500e0)/9000e0
      + CASE WHEN o_orderpriority='1-URGENT' THEN 0.5e0 ELSE -0.125e0 END
      + 2e0*({u_sql('y')}-0.5e0))) as bigint) AS shares
  FROM orders JOIN customer ON o_custkey = c_custkey
),
art AS (
  SELECT *, CASE WHEN shares > 1400 THEN 1 ELSE 0 END AS y,
    floor(100e0 * (0.35e0 * (CASE WHEN shares > 1400 THEN 1 ELSE 0 END) + 0.65e0 * {u_sql('s', 'id')})) / 100e0 AS score,
    {u_sql('p1', 'id')} AS p1, {u_sql('p2', 'id')} AS p2, {u_sql('p3', 'id')} AS p3
  FROM art0
)"""

DOCS_SQL = """
docs AS (
  SELECT d.doc_id AS id, d.lang, d.source, cast(d.n_chars as double) AS n_chars, cast(l.quality as integer) AS y
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""
