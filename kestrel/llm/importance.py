"""Target-distribution importance resampling (operator 11): hashed n-gram features, segment deduplication, Gumbel draw.

Documents are drawn so that the drawn ones resemble a target corpus. Features are all runs of 1 to ``max_n`` consecutive
words, hashed to ``buckets`` numbers; a bucket's gain is its log ratio between target and documents; a document's weight is
the sum of gains over its features; weight plus Gumbel noise orders the documents, and the highest are drawn without
replacement.

Segment deduplication: line feeds separate words, so a text is the sequence of its lines, and lines repeat. A task gathers
the distinct lines of its texts with their occurrences (up to ``LINES_BYTES`` of them at a time), finds the features of each
distinct line once and multiplies them by the occurrences. N-grams that reach over line ends are added on their own, from
the last words before and the first words after each line end. What leaves a task is one count per bucket. The second
reading sums a document's weight from the weights of its lines in the same way. So no text is shuffled, and a line that a
third of all documents hold costs a task one look-up each.

Places in the draw come from ``ranks.numbered`` (narrow rows shuffled by ranges of the score). Everything but the two gain
inputs (``buckets`` numbers each) stays distributed, and the noise is a hash of the id, so reruns agree.

Defined results: NULL texts are empty, have no features and weight 0; documents under ``min_words`` words are never drawn, and
their rank is NULL. Ties go to the smaller id, a NULL id (hashed as the empty text) comes last; rows with equal ids are
numbered one after the other. Empty tables give no rows; an empty target gives every bucket its gain against zero counts.
Columns that are not kept take no part; a kept column named like a result column raises ``ValueError``.
"""

from __future__ import annotations

import math
from collections import Counter, deque
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import checkpointed, crc32_sql, lean_memory, map_arrays, pieces, refuse_clash, release_memory
from kestrel.llm.ranks import numbered

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
LINES_BYTES = 32 << 20  # distinct lines that a task gathers before it finds their features
MEMO_WORDS = 1 << 17  # words whose bucket a task remembers
RESULT = "n_features bigint, n_words bigint, weight bigint, score bigint, rank bigint"

# Every byte that is no part of a word becomes a space; A-Z become a-z. Bytes from 0x80 on are parts of words.
_WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in set(_WORD) else 0x20 for b in range(256))


class Features:
    """Buckets of the n-grams of lines and across line ends."""

    def __init__(self, max_n: int, buckets: int):
        self.max_n, self.buckets = max_n, buckets
        self.known: dict[bytes, int] = {}

    def words(self, line: bytes) -> list[bytes]:
        return line.translate(PLAIN).split()

    def of_line(self, words: list[bytes]) -> list[int]:
        known, n = self.known, self.buckets
        if len(known) > MEMO_WORDS:
            known.clear()
        try:
            out = [known[w] for w in words]
        except KeyError:
            for w in words:
                known[w] = crc32(w) % n
            out = [known[w] for w in words]
        for size in range(2, self.max_n + 1):
            out += [crc32(b" ".join(words[i : i + size])) % n for i in range(len(words) - size + 1)]
        return out

    def edges(self, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """The words of a line that n-grams across its ends can hold: the first and the last ``max_n - 1``."""
        k = self.max_n - 1
        return (words[:k], words[-k:]) if k else ([], [])

    def across(self, edges: Sequence[tuple[list[bytes], list[bytes]]]) -> list[int]:
        """Buckets of the n-grams that begin in one line and end in a later one, given the lines' edges in order."""
        out, before = [], []
        for first, last in edges:
            run = before + first
            for end in range(len(before) + 1, len(run) + 1):
                for size in range(2, min(self.max_n, end) + 1):
                    if end - size < len(before):
                        out.append(crc32(b" ".join(run[end - size : end])) % self.buckets)
            # a line shorter than max_n - 1 words leaves room for words of the lines before it
            before = last if len(last) == self.max_n - 1 else (before + last)[-(self.max_n - 1) :] if self.max_n > 1 else []
        return out


def lines_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(lines of all texts, where those of each text start)"""
    lists = pc.split_pattern(pc.fill_null(texts, "").cast(pa.binary()), b"\n")
    starts = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), starts - starts[0]


def bucket_counts(df: DataFrame, text_col: str = "text", max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        features, total = Features(max_n, buckets), np.zeros(buckets, np.int64)
        lines, size, edges = Counter(), 0, {}

        def finish() -> None:
            for line, n in lines.items():
                np.add.at(total, features.of_line(features.words(line)), n)
            lines.clear()
            edges.clear()

        for batch in batches:
            for part in pieces(batch, [text_col]):
                flat, starts = lines_of(part.column(0))
                codes = flat.dictionary_encode()
                distinct, number = codes.dictionary.to_pylist(), codes.indices.to_numpy()
                for line, n in zip(distinct, np.bincount(number, minlength=len(distinct)).tolist()):
                    if line not in lines:
                        size += len(line)
                    lines[line] += n
                if max_n > 1:
                    for line in distinct:
                        if line not in edges:
                            edges[line] = features.edges(features.words(line))
                    own = [edges[line] for line in distinct]
                    for a, b in pairwise(starts.tolist()):
                        if b - a > 1:
                            np.add.at(total, features.across([own[i] for i in number[a:b]]), 1)
                if size > LINES_BYTES:
                    finish()
                    size = 0
        finish()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])
        release_memory()

    return df.select(text_col).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's smoothed shares in target and documents, in thousandths, rounded down."""
    n, s, t = len(docs), float(docs.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n)))) for a, b in zip(docs.tolist(), target.tolist())
    ], np.int64)


def collected(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def weighted(df: DataFrame, gain: np.ndarray, text_col: str, max_n: int, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns plus n_features, n_words and weight of every text."""

    def make() -> Callable[[pa.Array], list[pa.Array]]:
        features = Features(max_n, len(gain))
        known: dict[bytes, tuple] = {}  # line -> features, words, weight, edges
        held: deque[int] = deque([0])

        def measure(line: bytes) -> tuple:
            words = features.words(line)
            found = features.of_line(words)
            return len(found), len(words), int(gain[found].sum()), features.edges(words)

        def call(texts: pa.Array) -> list[pa.Array]:
            if held[0] > LINES_BYTES:
                known.clear()
                held[0] = 0
            flat, starts = lines_of(texts)
            codes = flat.dictionary_encode()
            distinct, number = codes.dictionary.to_pylist(), codes.indices.to_numpy()
            again = np.bincount(number, minlength=len(distinct)) > 1
            own = []
            for line, repeated in zip(distinct, again.tolist()):
                one = known.get(line)
                if one is None:
                    one = measure(line)
                    if repeated:  # a line met once is not worth its memory
                        known[line] = one
                        held[0] += len(line)
                own.append(one)
            table = np.array([o[:3] for o in own], np.int64).reshape(-1, 3)[number]
            sums = np.add.reduceat(table, starts[:-1]) if len(starts) > 1 else np.zeros((0, 3), np.int64)
            if max_n > 1:
                for i, (a, b) in enumerate(pairwise(starts.tolist())):
                    if b - a > 1:
                        more = features.across([own[j][3] for j in number[a:b]])
                        sums[i, 0] += len(more)
                        sums[i, 2] += int(gain[more].sum())
            return [pa.array(sums[:, j]) for j in range(3)]

        return call

    return map_arrays(df, [text_col], keep, "n_features bigint, n_words bigint, weight bigint", make)


def gumbel(id_col: str, seed: int) -> Column:
    """Gumbel noise from the first 32 bits of SHA-256 of seed and id, in thousandths, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def resample(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", max_n: int = 1,
    buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The ``keep`` columns (default: the id; they travel through one shuffle) plus n_features, n_words, weight, score and
    rank: 1, 2, ... in descending order of score for the drawn documents, NULL for the others."""
    keep = [id_col] if keep is None else list(dict.fromkeys([id_col, *keep]))
    refuse_clash(keep, RESULT)
    gain = gains(collected(bucket_counts(df, text_col, max_n, buckets), buckets),
                 collected(bucket_counts(target, target_col, max_n, buckets), buckets))
    scored = weighted(df, gain, text_col, max_n, keep).withColumn("score", F.col("weight") + gumbel(id_col, seed))
    scored = checkpointed(scored.withColumn("_may", F.col("n_words") >= min_words))
    drawn = scored.where("_may").count() * percent // 100
    order = [F.col("_may").desc(), F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("weight"), F.col("n_features")]
    out = numbered(scored, order, "_place")
    rank = F.when(F.col("_may") & (F.col("_place") < drawn), F.col("_place") + 1)
    return out.withColumn("rank", rank).drop("_may", "_place")


def oracle_sql(buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> str:
    """DuckDB SQL for the query (single words) over ``documents`` and ``benchmark``; every distinct word is hashed once."""

    def words(table: str, key: str) -> str:
        low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return (f"select {key} as id, unnest(regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as w from {table}")

    return f"""
with dw as (select id, w, count(*) as n from ({words('documents', 'doc_id')}) group by id, w),
bw as (select w, count(*) as n from ({words('benchmark', 'item_id')}) group by w),
vocabulary as materialized (select w, {crc32_sql('w')} % {buckets} as bucket from (select w from dw union select w from bw)),
s as (select bucket, sum(n) as s from dw join vocabulary using (w) group by bucket),
t as (select bucket, sum(n) as t from bw join vocabulary using (w) group by bucket),
gain as (
  select s.bucket, floor(1000e0 * ln((coalesce(t, 0) + 1)::double * ((select sum(s) from s) + {buckets})::double
         / ((s + 1)::double * ((select coalesce(sum(t), 0) from t) + {buckets})::double)))::bigint as gain
  from s left join t on s.bucket = t.bucket),
per_doc as (
  select id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight
  from dw join vocabulary using (w) join gain using (bucket) group by id),
d as (
  select doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
         ('0x' || substr(sha256('{seed}:' || doc_id::varchar), 1, 8))::bigint as h
  from documents left join per_doc on id = doc_id),
scored as (
  select doc_id, n_features, weight, weight + floor(-1000e0 * ln(-ln((h + 0.5e0) / 4294967296e0)))::bigint as score from d),
placed as (
  select *, row_number() over (partition by n_features >= {min_words} order by score desc, doc_id) as place,
         (select count(*) from scored where n_features >= {min_words}) * {percent} // 100 as drawn from scored)
select doc_id, n_features, weight, score,
       case when n_features >= {min_words} and place <= drawn then place end::bigint as rank from placed"""
