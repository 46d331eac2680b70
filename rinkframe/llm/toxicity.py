"""Toxicity: FTRL-proximal logistic regression over hashed word features.

Features are words, their stems (first characters), pairs of stems and pairs with
one or two words left out, hashed into a fixed space and present or absent in a
text. FTRL-proximal gives every coordinate its own rate and an L1 penalty that
leaves most weights at zero, so what is broadcast for scoring is small.

Defined cases: a null or empty text has no features and scores by the intercept
alone; a label that is null is left out, several labels of one document count as
their largest; repeated rows are scored each for itself; a training set without
both labels gives its own share of toxic texts as every score (0.5 if it is
empty). A column ``score`` of the input is replaced; other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkframe.llm.store import keep
from rinkframe.llm.words import Remembered, hashed, lean, mix, odd_numbers, utf8

BITS = 20
# Documented bound of the training sample: the labelled rows with the smallest
# hashes, of those that have a document. Joined as ids; their texts stay on the executors.
MAX_ROWS = 24_000
# A feature takes part from this many texts of the sample on.
LEAST_TEXTS = 10
STEMS = (4, 5)

_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
                 for c in range(256))
_SALT = odd_numbers(8, 77)


def _stem(length: int):
    return lambda w: xxhash.xxh3_64_intdigest(w.decode()[:length])


class Features:
    """Hashed features of texts; one per task, as it remembers words."""

    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.words = Remembered(xxhash.xxh3_64_intdigest)
        self.stems = [Remembered(_stem(n)) for n in STEMS]

    def of(self, text: bytes) -> np.ndarray:
        """Features with repetitions, as places in the hashed space."""
        words = text.decode().lower().encode().translate(_LETTERS).split()
        if not words:
            return np.empty(0, np.uint32)
        stems = [hashed(words, t) for t in self.stems]
        found = [hashed(words, self.words) * _SALT[0]]
        found += [s * _SALT[1 + k] for k, s in enumerate(stems)]
        s = stems[-1]
        found += [s[:-gap] * _SALT[3] + s[gap:] * _SALT[3 + gap] for gap in (1, 2, 3)]
        return (mix(np.concatenate(found)) >> self.shift).astype(np.uint32)


@dataclass
class Ftrl:
    """State of FTRL-proximal for binary features with value 1."""

    bits: int = BITS
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.1
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)
    toxic_weight: float = 3.0  # toxic texts are few
    bias: float = 0.0
    bias_n: float = 0.0

    def __post_init__(self):
        self.z, self.n = np.zeros(1 << self.bits), np.zeros(1 << self.bits)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum() + self.bias, -35, 35)))
        g = (p - label) * (self.toxic_weight if label else 1.0)
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = grown
        self.bias_n += g * g
        self.bias -= self.alpha * g / (self.beta + np.sqrt(self.bias_n))


@dataclass(frozen=True)
class Model:
    """Non-zero weights by place, and the intercept. Places and weights are what is
    broadcast: at most ``2**bits`` pairs, in practice a few thousand."""

    places: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def scorer(self):
        dense = np.zeros(1 << self.bits)
        dense[self.places] = self.weights
        features = Features(self.bits)

        def score(text: bytes) -> float:
            at = features.of(text)
            at = np.unique(at[dense[at] != 0])
            return float(1 / (1 + np.exp(-np.clip(dense[at].sum() + self.bias, -35, 35))))
        return score


def fit(documents: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", max_rows: int = MAX_ROWS, epochs: int = 6, bits: int = BITS) -> Model:
    """Fit on the labelled rows, at most ``max_rows`` of them, whatever their number.

    Features are made and counted where the texts are. The sample, without the features
    that are too rare, is learnt in one task, in an order that hashes of the ids give.
    """
    chosen = (labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
              .groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
              .join(documents.select(F.col(doc_id).alias("_id")), "_id", "left_semi")
              .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    rows = (documents.select(F.col(doc_id).alias("_key"), F.col(text).alias("_text"))
            .join(F.broadcast(chosen), F.col("_key") == F.col("_id"))
            .select(F.xxhash64("_id", F.lit(1)).alias("turn"), F.col("_label").alias("label"),
                    _feature_column(bits)("_text").alias("at")))
    rows = keep(rows, "toxic-sample")
    common = np.zeros(1 << bits, bool)
    common[_frequent(rows, bits)] = True

    def thinned(batches):
        for batch in batches:
            at = [np.frombuffer(b, np.uint32) for b in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a[common[a]].tobytes() for a in at], pa.binary())],
                ["turn", "label", "at"])

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("turn", "ascending"), ("at", "ascending")])
        model = Ftrl(bits)
        at = [np.frombuffer(b, np.uint32) for b in table.column("at").to_pylist()]
        y = table.column("label").to_pylist()
        if y:
            share = min(max(float(np.mean(y)), 1e-3), 1 - 1e-3)
            model.bias = float(np.log(share / (1 - share)))
        if 0 < sum(y) < len(y):
            for _ in range(epochs):
                for a, b in zip(at, y):
                    model.learn(a, b)
        w = model.weights(slice(None))
        places = np.flatnonzero(w)
        return pa.table({
            "place": pa.array(np.append(places, -1), pa.int64()),
            "weight": pa.array(np.append(w[places], model.bias))})

    learnt = (rows.mapInArrow(lean(thinned), "turn bigint, label int, at binary")
              .groupBy(F.lit(0).alias("all")).applyInArrow(learn, "place bigint, weight double").toArrow())
    if not learnt.num_rows:
        return Model(np.empty(0, np.int64), np.empty(0), 0.0, bits)
    places, weights = (learnt.column(c).to_numpy() for c in ("place", "weight"))
    kept = places >= 0
    return Model(places[kept], weights[kept], float(weights[~kept][0]), bits)


def _frequent(rows: DataFrame, bits: int) -> np.ndarray:
    """Places of the features that enough texts have: at most ``2**bits`` numbers."""
    def count(batches):
        seen = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for b in batch.column(0).to_pylist():
                seen[np.frombuffer(b, np.uint32)] += 1
        places = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(seen[places])], ["place", "n"])

    counted = (rows.select("at").mapInArrow(lean(count), "place bigint, n bigint")
               .groupBy("place").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_TEXTS))
    return counted.select("place").toArrow().column("place").to_numpy()


def _feature_column(bits: int):
    @F.arrow_udf("binary")
    def column(texts: pa.Array) -> pa.Array:
        features = Features(bits)
        return pa.array([np.unique(features.of(b)).tobytes() for b in utf8(texts)], pa.binary())
    return column


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score``, the probability that the text is toxic. One pass, no shuffle."""
    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rate = model.scorer()
        for texts in batches:
            yield pa.array([rate(b) for b in utf8(texts)], pa.float64())

    return documents.withColumn("score", scores(F.col(text)))
