"""Quality classifier (operator 5): hashed word n-gram logistic regression, trained with follow-the-regularised-leader
(FTRL-proximal) updates and scored as sparse dot products.

Features of a text: its tokens (runs of word characters, runs of other visible characters) and pairs of neighbours,
hashed to ``DIM`` slots; a token that repeats the one before it is read as one mark, so that repetition itself is a
feature. A slot's value is log(1 + count), and the vector has length 1.

Training: at most about ``MAX_TRAIN`` labelled rows (a documented bound; beyond it an even hash sample by id is taken).
The rows are dealt to learners of about ``SHARD_ROWS`` rows by hash of the id; each runs FTRL over its rows in hash order,
again and again until it has made ``MIN_UPDATES`` updates, and the learners' weights are averaged. What reaches the
driver is at most MAX_TRAIN / SHARD_ROWS vectors of DIM floats, whatever the input; the model is one vector of DIM floats
(1 MB), so its broadcast has a fixed size.

Defined results: NULL and empty texts score the bias alone. Labels that are NULL or belong to no row are ignored; if an
id has several labels their mean, rounded half up, counts. Without any usable label every score is 0.5. Repeated rows
repeat their result (and count as often in training); an empty table gives an empty result; extra columns pass
through, and one named like a result column raises ``ValueError``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import crc_mod, lean_memory, map_rows, pieces, refuse_clash, release_memory

DIM = 1 << 18
MAX_TRAIN = 40_000
SHARD_ROWS = 5_000
MIN_UPDATES = 15_000
THRESHOLD = 0.7
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-3
MEMO_WORDS = 1 << 17

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_PAIR, _MIX, _SAME = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        h = self[token] = xxhash.xxh3_64_intdigest(token)
        return h


class Featurizer:
    """text -> (sorted slots, values)."""

    def __init__(self, dim: int = DIM):
        self.dim, self.hashes = dim, _Hashes()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        tokens = _TOKEN.findall(text or "")
        if not tokens:
            return np.empty(0, np.int64), np.empty(0)
        h = np.fromiter(map(self.hashes.__getitem__, tokens), np.uint64, len(tokens))
        h[1:][h[1:] == h[:-1]] = _SAME
        both = np.concatenate([h, h[:-1] * _PAIR + h[1:]])
        both = (both ^ (both >> np.uint64(31))) * _MIX
        slots, counts = np.unique((both >> np.uint64(24)) % np.uint64(self.dim), return_counts=True)
        values = np.log1p(counts)
        return slots.astype(np.int64), values / math.sqrt(float(values @ values))


def ftrl(rows: Sequence[tuple[np.ndarray, np.ndarray, int]], dim: int = DIM, updates: int = MIN_UPDATES) -> np.ndarray:
    """Weights after whole FTRL-proximal passes over (slots, values, label) that make at least ``updates`` updates;
    slot ``dim`` is the bias."""
    z, n = np.zeros(dim + 1), np.zeros(dim + 1)

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    extended = [(np.append(s, dim), np.append(v, 1.0), y) for s, v, y in rows]
    for _ in range(-(-updates // max(1, len(rows)))):
        for at, x, y in extended:
            w = weights(at)
            g = (_sigmoid(float(w @ x)) - y) * x
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return weights(slice(None))


def _sigmoid(t: float) -> float:
    return 1.0 / (1.0 + math.exp(-t)) if t >= 0 else math.exp(t) / (1.0 + math.exp(t))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_train: int = MAX_TRAIN,
) -> np.ndarray:
    """Averaged weights (DIM slots and the bias). ``labels`` holds the rows that may be used, by id."""
    one = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    one = one.groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    spot = F.pmod(F.xxhash64(F.lit("quality"), id_col), F.lit(1 << 32))
    total = one.count()
    if total > max_train:
        one = one.where(spot < int((1 << 32) * (max_train / total)))
    shards = max(1, -(-min(total, max_train) // SHARD_ROWS))
    # At most about max_train rows of two numbers, so a broadcast of known size: texts of other rows stay unread.
    sample = (
        docs.select(id_col, text_col).join(F.broadcast(one), id_col)
        .select(F.pmod(spot, F.lit(shards)).alias("shard"), spot.alias("spot"), F.col(id_col).alias("id"), "label", F.col(text_col).alias("text"))
    )
    dealt = sample.repartition(shards, "shard").sortWithinPartitions("shard", "spot", "id", F.xxhash64("text"))

    def fit(batches):
        lean_memory()
        make, learners = Featurizer(), {}
        for batch in batches:
            for part in pieces(batch, ["text"]):
                cols = (part.column(c).to_pylist() for c in ("shard", "text", "label"))
                for shard, text, label in zip(*cols, strict=True):
                    slots, values = make(text)
                    learners.setdefault(shard, []).append((slots.astype(np.int32), values.astype(np.float32), label))
        for shard, rows in learners.items():
            w = ftrl(rows).astype("<f4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([w], pa.binary())], names=["shard", "w"])
        learners.clear()
        release_memory()

    fitted = sorted((r.shard, bytes(r.w)) for r in dealt.mapInArrow(fit, "shard bigint, w binary").collect())
    if not fitted:
        return np.zeros(DIM + 1, dtype=np.float32)
    return np.mean([np.frombuffer(w, "<f4") for _, w in fitted], axis=0, dtype=np.float64).astype(np.float32)


def score(df: DataFrame, weights: np.ndarray, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) plus ``score``, the probability that the text is of label 1."""
    keep = df.columns if keep is None else list(keep)
    refuse_clash(keep, "score double")
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def make():
        w, features = shared.value, Featurizer()

        def call(texts):
            out = []
            for t in texts:
                slots, values = features(t)
                out.append(_sigmoid(float(w[slots] @ values) + float(w[-1])))
            return (out,)

        return call

    return map_rows(df, [text_col], keep, "score double", make)


def training_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labels of rows that are not held out."""
    return labels.where(crc_mod(id_col, 4) != 2)


def classify(docs: DataFrame, labels: DataFrame, keep: Sequence[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Scores of all documents by a model of the labels that are not held out: keep, score, held_out, predicted."""
    keep = docs.columns if keep is None else list(keep)
    refuse_clash(keep, "score double, held_out boolean, predicted int")
    model = train(docs, training_labels(labels))
    out = score(docs, model, keep=[*dict.fromkeys([*keep, "doc_id"])])
    return out.select(*keep, (crc_mod("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
