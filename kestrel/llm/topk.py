"""Exact top-k search (operator 7): MaxScore over integer vectors.

Every component x becomes floor(scale * x); a vector's score for a query is the integer inner product. A query term is a
component with the sign it favours: its postings are the candidates whose value there has that sign, and its bound is
the largest contribution any of the shard's candidates can make. With terms by falling bound, the non-essential ones are
the longest tail whose bounds together stay below the score that a candidate must reach; a candidate outside all
essential postings cannot reach it and is never looked at. The others take the essential terms' contributions first and
then the rest, term by term (in slices), only as long as their score so far plus the bounds still to come is competitive.
The bar is the k-th best score so far, carried from shard to shard within a task.

Candidates lie in shards of at most ``SHARD`` vectors inside the partitions; each task searches its shards for every
query of a block of queries (broadcast; a block holds about ``QUERY_BYTES`` of vectors, so its size is bounded) and hands
on each query's best k. Best lists are merged by a window that keeps k rows a query, before and after the shuffle.
A task holds one block of queries at a time; the driver holds the vectors of all queries and the plan a step per block, so
queries are meant to be a stated, small part of the table (the registered query's are one in a hundred). Dense vectors whose
components differ little leave no term non-essential: there the saving comes from the bounds still to come, not from postings.

Ties go to the smaller id. Vectors that are NULL or empty or hold NULL or non-finite components take no part, nor do
those with a scaled component beyond 2**53; a score beyond 64 bits counts as the nearest 64-bit value. Only vectors of equal length are compared. Rows repeated in id and vector
count once; if an id has several vectors, the one that sorts first counts. An empty table, or one without queries, gives
an empty result. Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import checkpointed

SCALE = 1024
K = 10
SHARD = 4096
QUERY_BYTES = 16 << 20  # of one block of queries
SLICE = 8  # terms that are probed together

_LIMIT = float(1 << 53)
RESULT = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<bigint>) of the vectors that take part, one row per id."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    usable = F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & F.forall(x, lambda c: c.isNotNull() & (F.abs(c) * scale < _LIMIT))
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    return df.where(usable).groupBy(F.col(id_col).cast("bigint").alias("vec_id")).agg(F.min(v).alias("v"))


class Shard:
    """Candidates column by column, with the bounds of each column."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids)
        self.ids = ids[order]
        self.columns = np.ascontiguousarray(vectors[order].T)
        self.high, self.low = self.columns.max(axis=1), self.columns.min(axis=1)


def max_score(shard: Shard, query: np.ndarray, own_id: int, k: int, bar: float, stats: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the shard's candidates that may belong to the best ``k`` with a score of ``bar`` or more."""
    bounds = np.maximum(np.maximum(query * shard.high, query * shard.low), 0)
    terms = np.argsort(-bounds, kind="stable")
    tail = np.append(np.cumsum(bounds[terms][::-1])[::-1], 0)  # tail[i]: bounds of terms i and after
    essential = int(np.searchsorted(-tail, -bar, side="right")) if bar > -np.inf else len(terms)
    if bar <= 0:  # a candidate in no posting scores at most 0
        essential = len(terms)
        live = np.arange(len(shard.ids))
    else:
        signs = np.sign(query)
        posted = np.zeros(len(shard.ids), bool)
        for t in terms[:essential]:
            if posted.all():
                break
            posted |= np.sign(shard.columns[t]) == signs[t] if signs[t] else False
        live = np.flatnonzero(posted)
    live = live[shard.ids[live] != own_id]
    score = np.zeros(len(live))
    done = 0
    while done < len(terms) and len(live):
        now = terms[done : done + SLICE]
        cols = shard.columns[now]
        score += query[now] @ (cols if len(live) == cols.shape[1] else cols[:, live])
        if stats is not None:
            stats["products"] = stats.get("products", 0) + len(now) * len(live)
        done += len(now)
        if len(live) > k:  # what cannot reach the bar any more is probed no further
            keep = score + tail[done] >= bar
            if not keep.all():
                live, score = live[keep], score[keep]
    if len(live) > k:
        order = np.lexsort((shard.ids[live], -score))[:k]
        live, score = live[order], score[order]
    return shard.ids[live], score


def _search(query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Best k of a partition's candidates for each query. Products and sums stay below 2**53 in double precision where
    the bound below says so, and go through Python integers where it does not."""
    big = float(np.abs(queries).max(initial=0)) * queries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0, np.int64), np.empty(0)) for _ in query_ids]
        for batch in batches:
            for lo in range(0, batch.num_rows, SHARD):
                part = batch.slice(lo, SHARD)
                ids = part.column("vec_id").to_numpy()
                flat = part.column("v").flatten().to_numpy().reshape(len(ids), -1)
                exact = big * float(np.abs(flat).max(initial=0)) < _LIMIT
                shard = Shard(ids, flat.astype(np.float64 if exact else object))
                for i, own in enumerate(query_ids):
                    old_ids, old = best[i]
                    bar = old[-1] if len(old) == k else -np.inf
                    q = queries[i] if exact else queries[i].astype(np.int64).astype(object)
                    new_ids, new = (max_score if exact else _plain)(shard, q, own, k, bar)
                    if len(new):
                        all_ids, all_ = np.concatenate([old_ids, new_ids]), np.concatenate([old.astype(new.dtype), new])
                        order = sorted(range(len(all_)), key=lambda j: (-all_[j], all_ids[j]))[:k] if not exact else np.lexsort((all_ids, -all_))[:k]
                        best[i] = (all_ids[order], all_[order])
        rows = [(int(q), int(i), int(s)) for q, (ids, scores) in zip(query_ids, best, strict=True) for i, s in zip(ids, scores, strict=True)]
        cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    return run


def _plain(shard: Shard, query: np.ndarray, own_id: int, k: int, bar: float):
    """All scores in Python integers, for values too large for exact doubles; beyond 64 bits the nearest 64-bit value."""
    score = np.clip(sum(query[t] * shard.columns[t] for t in range(len(query))), -(1 << 63), (1 << 63) - 1)
    live = [i for i in range(len(shard.ids)) if shard.ids[i] != own_id and score[i] >= bar]
    live.sort(key=lambda i: (-score[i], shard.ids[i]))
    return shard.ids[live[:k]], score[live[:k]]


def _best(df: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best rows other than itself. ``is_query`` is a condition on the
    column ``vec_id``."""
    vectors = checkpointed(integer_vectors(df, id_col, vector_col, scale).withColumn("width", F.size("v")))
    queries = vectors.where(is_query)
    found = None
    for width, n in sorted((r["width"], r["count"]) for r in queries.groupBy("width").count().collect()):
        same = vectors.where(F.col("width") == width).select("vec_id", "v")
        blocks = -(-n * width * 8 // query_bytes)
        for b in range(blocks):
            own = queries.where((F.col("width") == width) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b))
            rows = own.select("vec_id", "v").orderBy("vec_id").toArrow()
            if not rows.num_rows:
                continue
            ids = rows.column("vec_id").to_numpy()
            matrix = rows.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1).astype(np.float64)
            part = same.mapInArrow(_search(ids, matrix, k), RESULT)
            part = _best(part, k)
            found = part if found is None else found.union(part)
    if found is None:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return found.select("query_id", "rank", "vec_id", "score")


def oracle_sql() -> str:
    """DuckDB SQL for the query over ``embeddings``: every query against every row."""
    return """
with x as (
  select vec_id, list_transform(embedding, lambda c: c::double) as e from embeddings where vec_id is not null and len(embedding) > 0),
v as (
  select vec_id, min(list_transform(e, lambda c: floor(c * 1024)::bigint)) as v from x
  where len(list_filter(e, lambda c: c is not null and isfinite(c))) = len(e) group by vec_id),
s as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10"""
