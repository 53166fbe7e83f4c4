"""LM scoring (operator 10): a word bigram model by deleted interpolation.

P(w | h) = l2(b) c(h w)/c(h) + l1(b) c(w)/N + l0(b) 1/(V+1), with b the frequency bucket of the context h (the bit length
of c(h); 0 for an unseen context). Maximum-likelihood counts are of the training documents. The mixture weights of each
bucket are learned by expectation-maximisation on held-out counts: a tenth of the training documents (by hash of the id)
is deleted from the counts, and the weights are fitted to the events of that part under the counts of the rest.

Words are runs of anything but ASCII white space, A-Z lower-cased; every text ends with one end token, which is also the
context of its first word, so a NULL or empty text is the end token alone.

How it runs. Tasks read texts in blocks of about ``BLOCK_TOKENS`` tokens. A block numbers its words and sends one request
per range of key hashes: the 64-bit keys of its distinct words (or bigrams) with their training counts inside the block.
Requests are grouped by key range; a range sums the counts of its keys over all blocks and answers every block in the
order of its request. Requests are pre-aggregated and hash ranges are even, so a frequent word or bigram is one entry per
block and no task grows hot. A second reading of the texts builds the same blocks, meets the answers and scores whole
documents. Nothing but N, V and a bounded table of held-out events (``cells``) reaches the driver.

Blocks must be the same in every reading. They follow the order of rows in the input's partitions, which files repeat
exactly; an input that is not read straight from files (shuffled, cached, sorted) is written to the shared folder first.
Each block carries a digest of its keys, and a reading that differs all the same (files that change meanwhile) raises an
error rather than score wrongly.

Defined results: as above for NULL and empty texts. Without training documents every probability is uniform, 1/(V+1) with
V = 0. A NULL id hashes as the empty text. Repeated rows repeat their result (and count as often in training); an empty
table gives an empty result; extra columns pass through, and one named like a result column raises ``ValueError``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import checkpointed, crc_mod, pieces, refuse_clash, written

BLOCK_TOKENS = 1 << 21
RANGE_BYTES = 8 << 20  # bytes of text per key range of bigrams
WORD_RANGES = 8  # ranges of bigrams per range of words
ROUNDS = 50
STEP = 2.0  # cells per doubling of a ratio
END = b"\n"  # no word contains white space

_ODD, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_REQUEST = "block bigint, part int, n bigint, digest bigint, payload binary"
_CELLS = "bucket int, q2 int, q1 int, n bigint"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class _Numbers(dict):
    """word -> number in order of first sight; the end token is 0."""

    def __init__(self):
        super().__init__({END: 0})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Block:
    """Texts of one block as word numbers: every document is its words and the end token."""

    def __init__(self):
        self.numbers, self.docs, self.kinds, self.tokens = _Numbers(), [], [], 0

    def add(self, text: str | None, kind: int) -> None:
        words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        self.docs.append(np.append(ids, np.int32(0)))
        self.kinds.append(kind)
        self.tokens += len(ids) + 1

    def hashes(self) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.numbers), np.uint64, len(self.numbers))


class Events:
    """Tokens of a block with their contexts, its distinct words and bigrams in key order, and where each token is."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray, tokens: np.ndarray):
        self.lengths = lengths
        self.starts = np.append(0, np.cumsum(lengths)[:-1]).astype(np.int64)
        context = np.empty_like(tokens)
        context[1:] = tokens[:-1]  # a document's first context is the end token before it
        context[self.starts] = 0
        self.context = context
        pairs, at = np.unique(context.astype(np.int64) << 32 | tokens, return_inverse=True)
        keys = _mix(hashes[pairs >> 32] * _ODD + _mix(hashes[pairs & 0xFFFFFFFF]))
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.pair_keys, self.pair = keys[order], place[at]
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.word_keys, self.word, self.context_word = hashes[order], place[tokens], place[context]

    def counts(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of words and of bigrams over the documents marked in ``docs``."""
        mark = np.repeat(docs, self.lengths)
        return (np.bincount(self.word[mark], minlength=len(self.word_keys)), np.bincount(self.pair[mark], minlength=len(self.pair_keys)))


def _digest(*arrays: np.ndarray) -> int:
    h = xxhash.xxh3_64()
    for a in arrays:
        h.update(np.ascontiguousarray(a).tobytes())
    return h.intdigest() >> 1


def _blocks(batches: Iterator[pa.RecordBatch], limit: int, keep: Sequence[str] = ()):
    """(block number, Block, rows to keep) of a partition. Held-out training texts and all others go to blocks of their
    own, so that the held-out ones can be read alone."""
    base = TaskContext.get().partitionId() << 24
    open_: dict[int, tuple[Block, list]] = {}
    seq = {0: 0, 1: 0}

    def close(side: int):
        block, rows = open_.pop(side)
        number = base | seq[side] << 1 | side
        seq[side] += 1
        return number, block, rows

    for batch in batches:
        for part in pieces(batch, ["text"]):
            kinds = part.column("kind").to_pylist()
            for i, (text, kind) in enumerate(zip(part.column("text").to_pylist(), kinds, strict=True)):
                side = int(kind == 2)
                block, rows = open_.setdefault(side, (Block(), []))
                block.add(text, kind)
                if keep:
                    rows.append(part.select(keep).slice(i, 1))
                if block.tokens >= limit:
                    yield close(side)
    for side in sorted(open_):
        yield close(side)


def _events(block: Block) -> Events:
    return Events(block.hashes(), np.array([len(d) for d in block.docs], np.int64), np.concatenate(block.docs))


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _requests(pair_ranges: int, word_ranges: int, limit: int):
    """Every block's keys and training counts (of the main part and of the held-out part), cut by key range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block, _ in _blocks(batches, limit):
            ev = _events(block)
            kinds = np.array(block.kinds)
            main, held = ev.counts(kinds == 1), ev.counts(kinds == 2)
            digest = _digest(ev.word_keys, ev.pair_keys)
            rows = []
            for first, ranges, keys, m, h in (
                (0, pair_ranges, ev.pair_keys, main[1], held[1]), (pair_ranges, word_ranges, ev.word_keys, main[0], held[0])):
                cuts = np.searchsorted(_range_of(keys, ranges), np.arange(ranges + 1))
                for p in np.flatnonzero(cuts[1:] > cuts[:-1]):
                    i, j = cuts[p], cuts[p + 1]
                    payload = keys[i:j].tobytes() + _pack(m[i:j].astype("<u4"), h[i:j].astype("<u4"))
                    rows.append((number, first + int(p), int(j - i), digest, payload))
            for i in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays(_typed(rows[i : i + 64]), names=["block", "part", "n", "digest", "payload"])

    return run


def _typed(rows: list[tuple]) -> list[pa.Array]:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    return [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum the counts of one key range over all blocks; answer each block, and add one row (block -1) of totals."""
    keys = np.concatenate([np.frombuffer(p, "<u8", n) for p, n in zip(pdf["payload"], pdf["n"], strict=True)])
    counts = [np.frombuffer(_unpack(p[8 * n :]), "<u4").reshape(2, n) for p, n in zip(pdf["payload"], pdf["n"], strict=True)]
    main, held = (np.concatenate([c[k] for c in counts]).astype(np.float64) for k in (0, 1))
    distinct, at = np.unique(keys, return_inverse=True)
    del keys
    main, held = (np.bincount(at, x, len(distinct)).astype(np.int64) for x in (main, held))
    totals = np.array([(main + held > 0).sum(), (main + held).sum(), main.sum()], "<i8")
    out, lo = [], 0
    for block, n, digest in zip(pdf["block"], pdf["n"], pdf["digest"], strict=True):
        mine = at[lo : lo + n]
        out.append((block, n, digest, _pack((main + held)[mine].astype("<u8"), held[mine].astype("<u8"))))
        lo += n
    out.append((-1, 0, 0, totals.tobytes()))
    part = int(pdf["part"].iloc[0])
    return pd.DataFrame([(b, part, n, d, p) for b, n, d, p in out], columns=["block", "part", "n", "digest", "payload"])


def _bodies(keep: Sequence[str], limit: int):
    """The blocks of a reading, to meet their answers: word hashes, documents, and the rows to keep (Arrow stream)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block, rows in _blocks(batches, limit, keep):
            lengths = np.array([len(d) for d in block.docs], "<i8")
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(rows).combine_chunks()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            hashes = block.hashes().astype("<u8").tobytes()
            packed = _pack(lengths, np.concatenate(block.docs).astype("<i4"))
            payload = b"".join((len(hashes).to_bytes(8, "little"), len(packed).to_bytes(8, "little"), hashes, packed, sink.getvalue().to_pybytes()))
            yield pa.RecordBatch.from_arrays(_typed([(number, -1, len(lengths), 0, payload)]), names=["block", "part", "n", "digest", "payload"])

    return run


def _meet(pdf: pd.DataFrame):
    """Events of one block with its answers: counts (all training, held-out part) of its words and bigrams."""
    body = pdf[pdf["part"] == -1]
    if len(body) != 1:
        raise RuntimeError("the texts were read in other blocks than before; write the input to files first")
    payload, docs = body["payload"].iloc[0], int(body["n"].iloc[0])
    a, b = (int.from_bytes(payload[i : i + 8], "little") for i in (0, 8))
    hashes = np.frombuffer(payload, "<u8", a // 8, 16)
    packed = _unpack(payload[16 + a : 16 + a + b])
    ev = Events(hashes, np.frombuffer(packed, "<i8", docs), np.frombuffer(packed, "<i4", offset=8 * docs))
    rows = pa.ipc.open_stream(payload[16 + a + b :]).read_all()
    answers = pdf[pdf["part"] >= 0].sort_values("part")
    digest = _digest(ev.word_keys, ev.pair_keys)
    if answers["n"].sum() != len(ev.word_keys) + len(ev.pair_keys) or (answers["digest"] != digest).any():
        raise RuntimeError("the texts were read in other blocks than before; write the input to files first")
    both = [np.frombuffer(_unpack(p), "<u8").reshape(2, n) for p, n in zip(answers["payload"], answers["n"], strict=True)]
    counts = np.concatenate(both, axis=1).astype(np.int64)
    pairs, words = counts[:, : len(ev.pair_keys)], counts[:, len(ev.pair_keys) :]
    return ev, rows, words, pairs


def bucket_of(count: np.ndarray) -> np.ndarray:
    """Bit length of a context's count."""
    return np.frexp(count.astype(np.float64))[1].astype(np.int64)


def _cells(pdf: pd.DataFrame, total: int, types: int) -> pd.DataFrame:
    """Held-out events of one block under the counts of the rest, by bucket and by the two ratios to the uniform
    probability, in steps of 1 / STEP doublings (0: the ratio is zero)."""
    ev, _, words, pairs = _meet(pdf)
    words, pairs = words[0] - words[1], pairs[0] - pairs[1]
    c_context, c_word, c_pair = words[ev.context_word], words[ev.word], pairs[ev.pair]

    def step(ratio):
        with np.errstate(divide="ignore"):
            return np.where(ratio > 0, np.maximum(1, np.round(np.log2(ratio) * STEP) + 32), 0).astype(np.int64)

    f2 = np.where(c_context > 0, c_pair / np.maximum(c_context, 1), 0.0)
    cells = np.stack([bucket_of(c_context), step(f2 * (types + 1)), step(c_word / max(total, 1) * (types + 1))], axis=1)
    cells, n = np.unique(cells, axis=0, return_counts=True)
    return pd.DataFrame({"bucket": cells[:, 0], "q2": cells[:, 1], "q1": cells[:, 2], "n": n})


def fit(cells: Sequence[tuple[int, int, int, int]], rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights by bucket, [65, 3] (uniform, unigram, bigram), by EM over (bucket, q2, q1, n) cells. A bucket
    without held-out events takes those of the nearest bucket below it that has some, else above."""
    out = np.full((65, 3), np.nan)
    table = np.array(cells, np.float64).reshape(-1, 4)
    for b in np.unique(table[:, 0]).astype(int):
        part = table[table[:, 0] == b]

        def ratio(q):
            return np.where(q > 0, np.exp2((q - 32) / STEP), 0.0)

        p = np.stack([np.ones(len(part)), ratio(part[:, 2]), ratio(part[:, 1])], axis=1)
        weight = np.array([0.2, 0.3, 0.5]) if p[:, 2].any() else np.array([0.4, 0.6, 0.0])
        for _ in range(rounds):
            share = p * weight
            share /= share.sum(axis=1, keepdims=True)
            weight = (share * part[:, 3:4]).sum(axis=0) + np.array([0.5, 0.5, 0.5 * (weight[2] > 0)])
            weight /= weight.sum()
        out[b] = weight
    known = np.flatnonzero(~np.isnan(out[:, 0]))
    for b in range(65):
        if np.isnan(out[b, 0]):
            below = known[known < b]
            out[b] = out[below[-1]] if len(below) else out[known[0]] if len(known) else (0.5, 0.5, 0.0)
    return out


def _scores(pdf: pd.DataFrame, weights: np.ndarray, total: int, types: int) -> pa.Table:
    ev, rows, words, pairs = _meet(pdf)
    words, pairs = words[0], pairs[0]
    c_context, c_word, c_pair = words[ev.context_word], words[ev.word], pairs[ev.pair]
    known = np.add.reduceat((c_word > 0).astype(np.int64), ev.starts)
    base = np.add.reduceat(np.log10((c_word + 0.5) / (total + 0.5 * (types + 1))), ev.starts)
    w = weights[bucket_of(c_context)]
    if total:
        p = w[:, 0] / (types + 1) + w[:, 1] * c_word / total + w[:, 2] * c_pair / np.maximum(c_context, 1)
        # the share of an unseen context's bigram part goes to the other two, so that probabilities sum to 1
        p = np.where(c_context > 0, p, p / (w[:, 0] + w[:, 1]))
    else:
        p = np.full(len(c_word), 1.0 / (types + 1))
    score = np.add.reduceat(np.log10(p), ev.starts)
    for name, values in (("n_tokens", ev.lengths), ("n_known", known), ("train_tokens", np.full(len(known), total)),
                         ("base_score", base), ("score", score)):
        rows = rows.append_column(name, pa.array(values))
    return rows


RESULT = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
# Plan nodes that give the same rows in the same partitions whenever files are read.
STEADY = {"FileScan", "Scan", "BatchScan", "Project", "Filter", "ColumnarToRow", "WholeStageCodegen", "InputAdapter", "Union", "Coalesce"}


def steady(df: DataFrame) -> DataFrame:
    """``df`` if it only reads files row by row; anything else (a shuffle, a cache, a sort) is written to files first, so that
    every reading meets the same rows in the same partitions."""
    plan = df._jdf.queryExecution().sparkPlan().toString()  # noqa: SLF001 - no public view of the plan's nodes
    nodes = re.findall(r"^[\s:+|-]*(?:\*\(\d+\)\s*)?(\w+)(.*)$", plan, re.M)
    from_files = all(n in STEADY and not (n == "Scan" and "ExistingRDD" in rest) for n, rest in nodes)
    return df if from_files else written(df)


def score(
    df: DataFrame, train, deleted, text_col: str = "text", keep: Sequence[str] | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The ``keep`` columns (default: all) plus the columns of ``RESULT`` for every row. ``train`` marks training rows,
    ``deleted`` those whose counts are held out for the mixture weights (both boolean columns of ``df``)."""
    keep = df.columns if keep is None else list(keep)
    refuse_clash(keep, RESULT)
    df = steady(df.select(*dict.fromkeys([*keep, text_col]), train.alias("_train"), deleted.alias("_deleted")))
    train, deleted = F.col("_train"), F.col("_deleted")
    kind = F.when(train & deleted, F.lit(2)).when(train, F.lit(1)).otherwise(F.lit(0))
    own = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    names = [f"k{i}" for i in range(len(keep))]
    texts = df.select(*own, F.col(text_col).alias("text"), kind.alias("kind"))

    size = df.select(F.sum(F.octet_length(text_col))).first()[0] or 0
    pair_ranges = max(4, -(-size // RANGE_BYTES))
    word_ranges = max(1, pair_ranges // WORD_RANGES)
    asked = texts.select("text", "kind").mapInArrow(_requests(pair_ranges, word_ranges, block_tokens), _REQUEST)
    answers = checkpointed(asked.groupBy("part").applyInPandas(_answer, _REQUEST))

    totals = answers.where((F.col("block") == -1) & (F.col("part") >= pair_ranges)).select("payload")
    types, total, main = (int(x) for x in _sum_totals(totals))
    replies = answers.where("block >= 0")
    held = texts.where("kind = 2").select("text", "kind").mapInArrow(_bodies(["kind"], block_tokens), _REQUEST)
    met = held.union(replies.where("block % 2 = 1")).groupBy("block")
    cells = met.applyInPandas(lambda pdf: _cells(pdf, main, types), _CELLS).groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n"))
    weights = fit(sorted(tuple(r) for r in cells.collect()))  # at most a cell per bucket and pair of steps

    schema = ", ".join([*[f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)], RESULT])
    bodies = texts.mapInArrow(_bodies(names, block_tokens), _REQUEST)

    def final(table: pa.Table) -> pa.Table:
        return _scores(table.to_pandas(), weights, total, types)

    out = bodies.union(replies).groupBy("block").applyInArrow(final, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *RESULT_NAMES)


RESULT_NAMES = [c.split(" ")[0] for c in RESULT.split(", ")]


def _sum_totals(totals: DataFrame) -> np.ndarray:
    """Add up the totals rows (one per range) in Spark: 24 bytes each, three numbers in all."""

    def add(batches):
        out = np.zeros(3, np.int64)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                out += np.frombuffer(p, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array([int(x)]) for x in out], names=["a", "b", "c"])

    r = totals.mapInArrow(add, "a bigint, b bigint, c bigint").agg(F.sum("a"), F.sum("b"), F.sum("c")).first()
    return np.array([x or 0 for x in r])


def score_documents(docs: DataFrame, keep: Sequence[str] = ("doc_id",), block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents scored by a model of those whose crc32 of the id modulo 5 is not 1 (``held_out`` marks the others)."""
    train = crc_mod("doc_id", 5) != 1
    deleted = F.pmod(F.xxhash64(F.lit("deleted"), F.col("doc_id")), F.lit(10)) == 0
    with_mark = docs.withColumn("held_out", ~train)
    return score(with_mark, train, deleted, keep=[*keep, "held_out"], block_tokens=block_tokens)
