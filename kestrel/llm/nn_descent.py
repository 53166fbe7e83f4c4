"""Embedding near-dedup (operator 2): a neighbour graph refined by NN-descent, its edges above a threshold kept.

Two vectors are linked when their labels are equal and not NULL and their cosine, in double precision, is at least 0.98.

1. Vectors equal in label and components become one class with a count; only classes go on.
2. Start: for each of the random trees (``TREES``, or more where the table has more cells, see ``start_trees``), vectors are ranged by (label, side of a few random hyperplanes, position
   along another direction); a range partition compares neighbours in overlapping windows of ``WINDOW`` vectors.
3. Rounds: a vector's neighbours and those that have it as neighbour are joined at that vector, and all their pairs with
   a new edge are compared there (neighbours of neighbours). Pairs better than the worst neighbour of either side enter
   its list of ``K``. A vector that many have as neighbour is split into parts of ``PART`` of them. Rounds end when
   no more than ``LEAST_CHANGE`` of all list entries are new, or after ``ROUNDS``.
4. A list whose every entry is a link is saturated: it is enlarged (doubled, at most to ``K_MAX``) and refined further.
5. Links give connected components. Within a component all pairs are compared in blocks of ``BLOCK`` (no pair is
   emitted, each block hands on a count per vector), so link counts are exact also where groups exceed any list.
6. Audit: of the vectors with 0, 1, 2-3, 4-7, ... links found, about ``AUDIT`` each (taken by hash; ``AUDIT_ALONE`` of those
   with 0) are compared with all vectors. Recall is the mean per vector, taken apart for vectors with 1, 2-3, 4-7, ... true
   links; the least of these counts. While it is below ``TARGET_RECALL``, the graph starts again with twice the list length
   and more trees, and links found before are kept; after ``TRIES`` a ``RuntimeError`` is raised.

Defined results: vectors that are NULL, empty, zero, or hold NULL or non-finite components, and those without label, have
no links and are their own component. Vectors of different length are never linked. Rows are named by vec_id: repeated
rows count once, and of several vectors under one id the smallest (label, vector) counts. Rows with NULL id are left out.
An empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import checkpointed
from kestrel.llm.graph import components

THRESHOLD = 0.98
K, K_MAX = 10, 40
TREES = 4
START_MISS = 0.02  # chance that two vectors at the threshold share no cell of any tree, at most
MAX_BITS = 30
CELL = 512  # vectors per cell of hyperplane sides, about
WINDOW = 256
ROUNDS = 6
PART = 64
LEAST_CHANGE = 0.002
BLOCK = 1024
AUDIT = 512
AUDIT_ALONE = 8192
AUDIT_BLOCK = 512  # audited vectors compared at once with a batch
TARGET_RECALL = 0.99
TRIES = 3

_EDGE = "u bigint, v bigint, sim double"


def classes(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """All vectors (vec_id, rep; rep NULL if it links with nothing) and their classes (rep, members, grp, x)."""
    rows = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.struct(F.col(label_col).cast("string").alias("label"), F.transform(vector_col, lambda c: c.cast("double")).alias("x")).alias("row"),
    )
    one = rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.x")
    good = (
        F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)
        & F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < float("inf"))) & F.exists("x", lambda c: c != 0)
    )
    marked = one.withColumn("good", F.coalesce(good, F.lit(False)))
    # A class is named by the digest of its label and components; its representative is its smallest id.
    text = F.concat_ws(",", F.transform("x", lambda c: (c + F.lit(0.0)).cast("string")))
    marked = marked.withColumn("class", F.when(F.col("good"), F.sha2(F.concat_ws(";", F.col("label"), text), 256)))
    marked = checkpointed(marked)
    found = marked.where("good").groupBy("class").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("members"), F.first("label").alias("label"), F.first("x").alias("x"))
    found = found.withColumn("grp", F.concat_ws(";", F.size("x").cast("string"), "label"))
    return marked.select("vec_id", "class"), checkpointed(found.select("class", "rep", "members", "grp", "x"))


def _units(column: pa.Array) -> np.ndarray:
    """Rows scaled to length 1 (first by their largest component, so that no square overflows or vanishes)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def prepare(found: DataFrame, trees: int, seed: int, bits: int) -> DataFrame:
    """(rep, grp, x: packed unit vector, keys: per tree the hyperplane sides and the position)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("x").value_lengths().to_numpy()
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                units = _units(part.column("x"))
                rng = np.random.default_rng([seed, int(width)])
                cols = []
                for _ in range(trees):
                    planes = rng.normal(size=(width, bits + 1))
                    side = units @ planes
                    cols.append(pa.array((side[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64)), pa.int64()))
                    cols.append(pa.array(side[:, bits], pa.float64()))
                packed = pa.array([u.tobytes() for u in units], pa.binary())
                names = [f"{n}{t}" for t in range(trees) for n in ("code", "spot")]
                yield pa.RecordBatch.from_arrays([part.column("rep"), part.column("grp"), packed, *cols], names=["rep", "grp", "x", *names])

    ddl = "rep bigint, grp string, x binary, " + ", ".join(f"code{t} bigint, spot{t} double" for t in range(trees))
    return found.select("rep", "grp", "x").mapInArrow(run, ddl)


def _best_of(sims: np.ndarray, k: int) -> np.ndarray:
    k = min(k, sims.shape[1])
    return np.argpartition(-sims, k - 1, axis=1)[:, :k] if k else np.empty((len(sims), 0), int)


def _windows(k: int, window: int):
    """Best k neighbours of every vector within overlapping windows of a sorted partition."""

    def edges(rows: list[tuple]) -> pa.RecordBatch:
        us, vs, sims = [], [], []
        ids, groups = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], object)
        for g in set(groups.tolist()):
            at = np.flatnonzero(groups == g)
            if len(at) < 2:
                continue
            x = np.frombuffer(b"".join(rows[i][2] for i in at)).reshape(len(at), -1)
            s = x @ x.T
            np.fill_diagonal(s, -2)
            best = _best_of(s, min(k, len(at) - 1))
            us.append(np.repeat(ids[at], best.shape[1]))
            vs.append(ids[at][best].ravel())
            sims.append(np.take_along_axis(s, best, axis=1).ravel())
        cat = lambda parts, t: np.concatenate(parts).astype(t) if parts else np.empty(0, t)
        return _edges(cat(us, np.int64), cat(vs, np.int64), cat(sims, np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        done = False
        for batch in batches:
            rows += zip(*(batch.column(c).to_pylist() for c in ("rep", "grp", "x")), strict=True)
            while len(rows) >= window:
                yield edges(rows[:window])
                rows, done = rows[window // 2 :], True
        if len(rows) > (window // 2 if done else 1):  # the overlap alone has been compared before
            yield edges(rows)

    return run


def _edges(u, v, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sim, pa.float64())], names=["u", "v", "sim"])


def start_trees(bits: int, trees: int, threshold: float) -> int:
    """At least ``trees``, and so many that a pair at the threshold shares a cell of some tree but for ``START_MISS``."""
    same = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return trees if same >= 1 else max(trees, math.ceil(math.log(START_MISS) / math.log1p(-same)))


def start(points: DataFrame, trees: int, k: int, window: int) -> DataFrame:
    parts = []
    for t in range(trees):
        order = ["grp", f"code{t}", f"spot{t}", "rep"]
        ranged = points.select("rep", "grp", "x", f"code{t}", f"spot{t}").repartitionByRange(*order).sortWithinPartitions(*order)
        parts.append(ranged.select("rep", "grp", "x").mapInArrow(_windows(k, window), _EDGE))
    return reduce(DataFrame.union, parts)


def shortlist(edges: DataFrame) -> DataFrame:
    """Each vector's best entries, as many as its list is long. ``edges`` has u, v, sim, new, k."""
    one = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("new").alias("new"), F.max("k").alias("k"))
    k = F.max("k").over(Window.partitionBy("u"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    return one.withColumn("k", k).withColumn("rank", rank).where("rank <= k").drop("rank")


def _local_joins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At every centre compare all pairs of its members that have a new edge; keep those that improve either list."""

    def compare(members, new, bounds, xs):
        ids, at = np.unique(members, return_index=True)
        fresh = np.zeros(len(ids), bool)
        np.logical_or.at(fresh, np.searchsorted(ids, members), new)
        if len(ids) < 2 or not fresh.any():
            return None
        x = np.frombuffer(b"".join(xs[i] for i in at)).reshape(len(ids), -1)
        s = x @ x.T
        better = (s > bounds[at][:, None]) & (fresh[:, None] | fresh[None, :])
        np.fill_diagonal(better, False)
        i, j = np.nonzero(better)
        return ids[i], ids[j], s[i, j]

    rest = None
    out: list[tuple] = []
    size = 0
    for batch in batches:
        rest = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        key, salt = rest.column("center").to_numpy(), rest.column("salt").to_numpy()
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1])) + 1
        if not len(cuts):
            continue
        for found in _groups(rest, np.append(0, cuts), compare):
            out.append(found)
            size += len(found[0])
            if size > 100_000:
                yield _edges(*(np.concatenate(c) for c in zip(*out, strict=True)))
                out, size = [], 0
        rest = rest.slice(int(cuts[-1]))
    if rest is not None:
        out += _groups(rest, np.array([0, rest.num_rows]), compare)
    if out:
        yield _edges(*(np.concatenate(c) for c in zip(*out, strict=True)))


def _groups(rows: pa.RecordBatch, cuts: np.ndarray, compare):
    members, new, bounds = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("member", "new", "bound"))
    xs = rows.column("x").to_pylist()
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        found = compare(members[i:j], new[i:j], bounds[i:j], xs[i:j])
        if found is not None:
            yield found


def refine(graph: DataFrame, points: DataFrame) -> DataFrame:
    """One round: (u, v, sim) of pairs met at a common neighbour that are better than the end of u's list."""
    ends = graph.groupBy("u").agg(F.count("*").alias("n"), F.min("sim").alias("least"), F.max("k").alias("k"))
    ends = ends.select(F.col("u").alias("member"), F.when(F.col("n") < F.col("k"), F.lit(-2.0)).otherwise(F.col("least")).alias("bound"))
    forward = graph.select(F.col("u").alias("center"), F.col("v").alias("member"), "new")
    backward = graph.select(F.col("v").alias("center"), F.col("u").alias("member"), "new")
    active = forward.union(backward).where("new").select("center").distinct()
    parts = backward.groupBy("center").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
    active = active.join(parts, "center", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    far = backward.join(active, "center").withColumn("salt", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int"))
    near = forward.join(active, "center").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = far.unionByName(near).select("center", "salt", "member", "new")
    data = points.select(F.col("rep").alias("member"), "x").join(ends, "member", "left").withColumn("bound", F.coalesce("bound", F.lit(-2.0)))
    met = rows.join(data, "member").select("center", "salt", "member", "new", "bound", "x")
    n = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return met.repartition(n, "center", "salt").sortWithinPartitions("center", "salt").mapInArrow(_local_joins, _EDGE)


def neighbour_graph(points: DataFrame, trees: int, k: int, k_max: int, threshold: float, rounds: int = ROUNDS, window: int = WINDOW) -> DataFrame:
    first = start(points, trees, k, window).withColumn("new", F.lit(True)).withColumn("k", F.lit(k))
    graph = checkpointed(shortlist(first))
    for _ in range(rounds):
        better = refine(graph, points).select("u", "v", "sim", F.lit(True).alias("new"), F.lit(k).alias("k"))
        graph = checkpointed(shortlist(graph.withColumn("new", F.lit(False)).unionByName(better)))
        own = Window.partitionBy("u")
        stuck = (F.count("*").over(own) >= F.col("k")) & (F.min("sim").over(own) >= threshold) & (F.col("k") < k_max)
        marked = graph.withColumn("stuck", stuck)
        # All entries count: links are reached through neighbours that are none.
        n, changed, saturated = marked.select(F.count("*"), F.count_if("new"), F.count_if("stuck")).first()
        if saturated:  # longer lists, whose entries count as new again
            longer = F.when(F.col("stuck"), F.least(F.col("k") * 2, F.lit(k_max))).otherwise(F.col("k"))
            graph = checkpointed(marked.select("u", "v", "sim", (F.col("new") | F.col("stuck")).alias("new"), longer.cast("int").alias("k")))
        elif changed <= LEAST_CHANGE * n:
            break
    return graph


def _count_links(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of one block with another (or itself): per class how many classes and how many vectors it links to."""
    block, rep, weight = pdf["block"].to_numpy(), pdf["rep"].to_numpy(), pdf["members"].to_numpy()
    x = np.frombuffer(b"".join(pdf["x"])).reshape(len(pdf), -1)
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    if len(np.unique(block)) > 1:
        linked &= block[:, None] != block[None, :]
    return pd.DataFrame({"rep": rep, "near": linked.sum(axis=1), "n": (linked * weight[None, :]).sum(axis=1)})


def count_links(graph: DataFrame, points: DataFrame, found: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(rep, component, near: linked classes, n: linked vectors of other classes) of the classes that have links."""
    member = components(graph.where(F.col("sim") >= threshold), "u", "v").select(F.col("node").alias("rep"), "component")
    member = checkpointed(member)
    blocks = member.groupBy("component").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    rows = member.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.join(points.select("rep", "x"), "rep").join(found.select("rep", "members"), "rep")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    counts = rows.select("component", "lo", "hi", "block", "rep", "members", "x").groupBy("component", "lo", "hi").applyInPandas(
        lambda pdf: _count_links(pdf, threshold), "rep bigint, near bigint, n bigint")
    return member.join(counts.groupBy("rep").agg(F.sum("near").alias("near"), F.sum("n").alias("n")), "rep")


def audit(points: DataFrame, counts: DataFrame, threshold: float, size: int = AUDIT, alone: int = AUDIT_ALONE) -> float:
    """Least recall of any size class of links, see the module's step 6. Sampled vectors weigh as many as they stand for."""
    log = lambda c: F.when(c == 0, 0).otherwise(F.length(F.bin(c)))  # noqa: E731 - 0, 1, 2-3, 4-7, ... -> 0, 1, 2, 3, ...
    near = points.join(counts.select("rep", "near"), "rep", "left").withColumn("near", F.coalesce("near", F.lit(0)))
    near = near.select("rep", "grp", "x", "near", log(F.col("near")).alias("found"))
    totals = {r["found"]: r["count"] for r in near.groupBy("found").count().collect()}  # at most 64 rows
    spot = F.pmod(F.xxhash64(F.lit("audit"), "rep"), F.lit(1 << 30))
    share = {c: min(1.0, (size if c else alone) / n) for c, n in totals.items()}
    picked = [(F.col("found") == c) & (spot < int((1 << 30) * p) + 1) for c, p in share.items()]
    asked, told = {}, {}
    for r in near.where(reduce(lambda a, b: a | b, picked)).collect() if picked else []:  # about ``size`` rows a class
        asked.setdefault(r.grp, []).append((r.rep, bytes(r.x)))
        told[r.rep] = r.near, r.found
    if not asked:
        return 1.0
    tables = {g: (np.array([i for i, _ in rows]), np.frombuffer(b"".join(x for _, x in rows)).reshape(len(rows), -1)) for g, rows in asked.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {g: np.zeros(len(own), np.int64) for g, (own, _) in tables.items()}
        for batch in batches:
            groups = np.array(batch.column("grp").to_pylist(), object)
            ids, xs = batch.column("rep").to_numpy(), batch.column("x").to_pylist()
            for g in set(groups.tolist()) & tables.keys():
                at = np.flatnonzero(groups == g)
                own, queries = tables[g]
                x = np.frombuffer(b"".join(xs[i] for i in at)).reshape(len(at), -1).T
                for i in range(0, len(own), AUDIT_BLOCK):
                    linked = queries[i : i + AUDIT_BLOCK] @ x >= threshold
                    linked &= own[i : i + AUDIT_BLOCK, None] != ids[at][None, :]
                    sums[g][i : i + AUDIT_BLOCK] += linked.sum(axis=1)
        for g, (own, _) in tables.items():
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[g])], names=["rep", "true"])

    true = points.select("rep", "grp", "x").mapInArrow(run, "rep bigint, true bigint").groupBy("rep").agg(F.sum("true").alias("true"))
    drawn: dict[int, int] = {}
    for _, c in told.values():
        drawn[c] = drawn.get(c, 0) + 1
    weight, got = {}, {}
    for r in true.where(F.col("true") > 0).collect():  # at most the rows asked
        n, c = told[r.rep]
        w, kind = totals[c] / drawn[c], r.true.bit_length()
        weight[kind] = weight.get(kind, 0.0) + w
        got[kind] = got.get(kind, 0.0) + w * min(1.0, n / r.true)
    return min((got[c] / weight[c] for c in weight), default=1.0)


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD,
    k: int = K, k_max: int = K_MAX, trees: int = TREES, target_recall: float = TARGET_RECALL, tries: int = TRIES,
    block: int = BLOCK, window: int = WINDOW, cell: int = CELL,
) -> DataFrame:
    """One row per vec_id: vec_id, n_links, component_id, kept (vec_id = component_id)."""
    everyone, found = classes(df, id_col, vector_col, label_col)
    bits = min(MAX_BITS, max(0, (found.count() // cell).bit_length()))
    trees = start_trees(bits, trees, threshold)
    links = None
    for attempt in range(tries):
        points = checkpointed(prepare(found, trees << attempt, attempt, bits))
        graph = neighbour_graph(points, trees << attempt, k << attempt, k_max << attempt, threshold, window=window)
        new = graph.where(F.col("sim") >= threshold).select("u", "v", "sim")
        links = new if links is None else links.union(new)
        counts = checkpointed(count_links(links, points, found, threshold, block))
        recall = audit(points, counts, threshold)
        if recall >= target_recall:
            break
    else:
        raise RuntimeError(f"recall of links is {recall:.4f} after {tries} tries, below {target_recall}")
    per_class = found.select("class", "rep", "members").join(counts, "rep", "left").select(
        "class", F.coalesce("component", "rep").alias("component_id"), (F.col("members") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    out = everyone.where("class is not null").join(per_class, "class").select("vec_id", "n_links", "component_id")
    alone = everyone.where("class is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
