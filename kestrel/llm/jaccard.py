"""N-gram Jaccard join (operator 9): MinHash banding, a shuffle on band hashes, verification on full n-gram sets.

Two documents are linked when the Jaccard similarity of their sets of word 5-grams is at least 0.8. Words are runs of
anything but ASCII white space, A-Z lower-cased; a text of one to four words has one gram, its whole word list; a text
without words has no grams and is linked to nothing.

1. ``signatures``: per text a digest of its gram set and ``bands`` hashes over ``rows`` minima each; the numbers are
   chosen so that a pair at the threshold meets in a band with probability ``target_recall`` (``choose_bands``).
2. Texts with equal gram sets (all copies) become one class; only classes go on.
3. Classes are shuffled on band hashes. In a bucket every class is tied to the bucket's smallest one (a partial
   aggregate and a join), not to each other; connected ties give clusters. A candidate pair is always in one cluster.
4. Clusters are verified on full gram sets, read again from the texts. A cluster is dealt into blocks of about
   ``BLOCK`` classes and every two blocks meet in one task, which intersects all its pairs by matrix products over the
   shared grams and hands on a count of links per class and one edge per class to the class's linked group. No row is made
   per pair and no link inside a cluster is lost, but a cluster of m classes copies each gram set to m / ``BLOCK`` meetings, and
   pairs of a cluster that share no band are intersected too: on text with many chance collisions clusters, and this
   work, grow faster than the links.
5. Connected links give the groups; a group's id is its smallest doc_id.

Defined results: a NULL text has no words. A NULL doc_id sorts after every other id; if all of a group's are NULL its
id is NULL. Rows equal in doc_id and text are members like any other copy; ``deduplicate`` keeps one of them. An empty
table gives an empty result. Extra columns do not matter to ``join`` and pass through ``deduplicate``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import broadcast_if_small, checkpointed, lean_memory, pieces, release_memory
from kestrel.llm.graph import components

GRAM = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.9999
ROWS = 5
BLOCK = 512
MEMO_WORDS = 1 << 17
COLUMNS = 4096  # shared grams per matrix product

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def choose_bands(threshold: float = THRESHOLD, rows: int = ROWS, recall: float = TARGET_RECALL) -> int:
    """Fewest bands of ``rows`` minima with which a pair at the threshold shares a band with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def gram_set(text: str | None, words: _Words, n: int = GRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    width = min(n, len(h))
    grams = np.full(len(h) - width + 1, np.uint64(width))
    for i in range(width):
        grams = _mix(grams * _ODD + h[i : len(h) - width + 1 + i])
    return np.unique(grams)


@lru_cache(maxsize=4)
def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def band_hashes(grams: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    a, b = _multipliers(bands * rows)
    low = np.full(bands * rows, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(grams), 2048):
        part = grams[i : i + 2048]
        np.minimum(low, (a[:, None] * part[None, :] + b[:, None]).min(axis=1), out=low)
    out = np.arange(bands, dtype=np.uint64)
    table = low.reshape(bands, rows)
    for r in range(rows):
        out = _mix(out * _ODD + table[:, r])
    return out


def row_key(id_col: str, text_col: str) -> Column:
    """Names a row by id and text: rows equal in both share it."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(id_col).isNull(), F.col(text_col))


def signatures(df: DataFrame, id_col: str, text_col: str, bands: int, n: int = GRAM) -> DataFrame:
    """(row_key, doc_id, digest, bands array): digest is NULL for a text without words."""
    rows = df.select(row_key(id_col, text_col).alias("row_key"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        words = _Words()
        for batch in batches:
            for part in pieces(batch, ["text"]):
                digests, hashes = [], []
                for text in part.column("text").to_pylist():
                    grams = gram_set(text, words, n)
                    if len(grams):
                        digests.append(xxhash.xxh3_128_digest(grams.tobytes()))
                        hashes.append(band_hashes(grams, bands).view(np.int64))
                    else:
                        digests.append(None)
                        hashes.append(None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_key"), part.column("doc_id"), pa.array(digests, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))],
                    names=["row_key", "doc_id", "digest", "bands"],
                )
        words.clear()
        release_memory()

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"row_key bigint, doc_id {kind}, digest binary, bands array<bigint>")


# ---- verification of one pair of blocks ----------------------------------------------------------------------------
def _intersections(left: list[np.ndarray], right: list[np.ndarray], least: int) -> np.ndarray:
    """Sizes of the intersections of left sets with right sets, by matrix products over slices of the shared grams
    (those that stand in ``least`` sets or more, both sides counted)."""
    sets = [*left, *right]
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    ends = np.append(starts[1:], len(grams))
    shared = (owner[starts] < len(left)) & (owner[ends - 1] >= len(left))  # owners are in order within a gram
    lengths = ends - starts
    shared &= lengths >= least
    column = np.repeat(np.cumsum(shared) - 1, lengths)[np.repeat(shared, lengths)]
    owner = owner[np.repeat(shared, lengths)]
    total = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        i, j = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[i:j], column[i:j] - lo] = 1.0
        total += part[: len(left)] @ part[len(left) :].T
    return total


def _verify(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links within one meeting of two blocks (or of one block with itself): per class the number of linked documents,
    and the class's group here."""
    lean_memory()
    pdf = pdf.sort_values(["block", "rep"]).reset_index(drop=True)
    sets = [np.frombuffer(g, "<u8") for g in pdf["grams"]]
    block, weight, rep = pdf["block"].to_numpy(), pdf["members"].to_numpy(), pdf["rep"].to_numpy()
    m = len(sets)
    cut = int((block == block[0]).sum()) % m if block[0] != block[-1] else 0
    rows, cols = (slice(0, cut), slice(cut, m)) if cut else (slice(0, m), slice(0, m))
    sizes = np.array([len(s) for s in sets], np.float64)
    same = _intersections(sets[rows], sets[cols], 2 if cut else 3)  # a block that meets itself has each set twice
    near = same >= threshold * (sizes[rows, None] + sizes[None, cols] - same)
    linked = np.zeros((m, m), bool)
    linked[rows, cols] = near
    linked |= linked.T
    np.fill_diagonal(linked, False)
    group = np.arange(m)
    while True:
        new = np.minimum(group, np.where(linked, group[None, :], m).min(axis=1, initial=m))
        new = new[new]
        if (new == group).all():
            break
        group = new
    links = (linked * weight[None, :]).sum(axis=1).astype(np.int64)
    # "to" by smallest rep of the group, so that every meeting names groups alike
    first = pd.Series(rep).groupby(group).transform("min").to_numpy()
    return pd.DataFrame({"rep": rep, "n": links, "to": first})


def clusters(reps: DataFrame) -> DataFrame:
    """(rep, cluster) of the classes that share a band hash with another class, directly or by way of others."""
    banded = reps.select("rep", F.posexplode("bands").alias("band", "hash"))
    hubs = banded.groupBy("band", "hash").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    ties = banded.join(hubs, ["band", "hash"]).where("rep <> hub").select("rep", "hub").distinct()
    return components(ties, "rep", "hub").select(F.col("node").alias("rep"), F.col("component").alias("cluster"))


def join(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, n: int = GRAM,
    target_recall: float = TARGET_RECALL, block: int = BLOCK,
) -> DataFrame:
    """One row per input row: row_key, doc_id, class_id (its group's smallest doc_id), n_links (other documents linked
    to it, copies included), kept (the group's first row by doc_id)."""
    bands = choose_bands(threshold, ROWS, target_recall)
    sig = checkpointed(signatures(df, id_col, text_col, bands, n))
    reps = checkpointed(
        sig.where("digest is not null").groupBy("digest").agg(
            F.min("row_key").alias("rep"), F.count("*").alias("members"),
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first_row"),
            F.first("bands").alias("bands"))
    )

    cluster = checkpointed(clusters(reps))
    sizes = cluster.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    placed = cluster.join(sizes, "cluster").join(reps.select("rep", "members"), "rep")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    texts = df.select(row_key(id_col, text_col).alias("rep"), F.col(text_col).alias("text"))
    found = texts.join(broadcast_if_small(checkpointed(placed)), "rep").dropDuplicates(["rep"])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        words = _Words()
        for batch in batches:
            for part in pieces(batch, ["text"]):
                g = [gram_set(t, words, n).astype("<u8").tobytes() for t in part.column("text").to_pylist()]
                keep = ["rep", "cluster", "blocks", "members", "block"]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(g, pa.binary())], names=[*keep, "grams"])

    sets = found.select("rep", "cluster", "blocks", "members", "block", "text").mapInArrow(
        grams, "rep bigint, cluster bigint, blocks int, members bigint, block int, grams binary"
    )
    # Every block meets every block of its cluster once; a row goes to as many meetings as its cluster has blocks.
    meet = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meet = meet.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    verified = checkpointed(
        meet.select("cluster", "lo", "hi", "rep", "block", "members", "grams")
        .groupBy("cluster", "lo", "hi")
        .applyInPandas(lambda pdf: _verify(pdf, threshold), "rep bigint, n bigint, to bigint")
    )
    counts = verified.groupBy("rep").agg(F.sum("n").alias("others"))
    groups = components(verified.where("rep <> to").select("rep", "to").distinct(), "rep", "to")
    grouped = (
        reps.select("digest", "rep", "members", "first_row")
        .join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .join(counts, "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    firsts = grouped.groupBy("component").agg(F.min("first_row").alias("class_row"))
    classes = grouped.join(firsts, "component").select(
        "digest", "class_row", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    linked = sig.where("digest is not null").select("digest", "row_key", "doc_id").join(classes, "digest").select(
        "row_key", "doc_id", F.col("class_row.doc_id").alias("class_id"), "n_links",
        (F.col("row_key") == F.col("class_row.row_key")).alias("kept"))
    alone = sig.where("digest is null").select(
        "row_key", "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"), F.lit(True).alias("kept"))
    return linked.union(alone)


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group: the one with the smallest doc_id. All columns pass through."""
    kept = join(df, id_col, text_col, **options).where("kept").groupBy("row_key").agg(F.count("*").alias("copies"))
    kept = checkpointed(kept)
    own = [F.col(c).alias(f"_in_{c}") for c in df.columns]
    out = df.select(*own, row_key(id_col, text_col).alias("row_key")).join(kept.select("row_key"), "row_key")
    if kept.where("copies > 1").limit(1).count():  # rows equal in id and text
        out = out.dropDuplicates(["row_key"])
    return out.select(*[F.col(f"_in_{c}").alias(c) for c in df.columns])
