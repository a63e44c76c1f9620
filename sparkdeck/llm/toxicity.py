"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashed words, word pairs and skip-grams (a word and the one
after next) of the whole text, A-Z in lower case.  FTRL-proximal keeps a learning rate
per coordinate and an L1 term that leaves most weights exactly zero; the non-zero ones
are broadcast (at most ``2 ** bits`` floats, whatever the data).

Training uses a bounded, documented sample: at most ``train_rows`` labelled documents
whose ids hash lowest among those outside the held-out fifth.  Tasks turn them into
features; one task runs the online learner over them in hash order, ``epochs`` times.
Features of fewer than ``min_docs`` training documents are left out of the training:
with them the learner recalls single documents instead of words.  Errors on toxic
documents, the rarer class, weigh ``positive_weight`` times.

Edge cases: NULL and empty texts have only the bias; rows are scored one for one;
without labels of both classes every score is the bias of an untrained model (0.5 with
no label at all).
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .decontam import words_of
from .hashing import WordHash, mix
from .labels import fold, hashed_sample, training_labels
from .util import arrow_map, raw

_HASH: dict[int, WordHash] = {}


def features(text: bytes | None, bits: int) -> np.ndarray:
    """Feature numbers of a text, repeats included."""
    h = _HASH.setdefault(os.getpid(), WordHash()).of(words_of(text))
    pairs = mix(h[:-1] * np.uint64(3) + h[1:]) if len(h) > 1 else h[:0]
    skips = mix(h[:-2] * np.uint64(5) + h[2:] + np.uint64(1)) if len(h) > 2 else h[:0]
    return (np.concatenate([h, pairs, skips]) >> np.uint64(64 - bits)).astype(np.int32)


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss; the last coordinate is the bias."""

    def __init__(self, bits: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 3.0, l2: float = 1.0,
                 positive_weight: float = 2.0):
        self.alpha, self.beta, self.l1, self.l2, self.positive_weight = alpha, beta, l1, l2, positive_weight
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        rate = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / rate)

    def step(self, at: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y) * (self.positive_weight if y else 1.0)
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = grown


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", bits: int = 22, train_rows: int = 12_000,
        epochs: int = 6, l1: float = 3.0, min_docs: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights, bias) of the non-zero weights."""
    spark = docs.sparkSession
    known = hashed_sample(training_labels(labels, label_col), train_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def featurise(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([np.unique(features(t, bits)) for t in raw(b.column(2))], pa.list_(pa.int32()))],
                ["doc_id", "y", "f"])
    # the ids of the sample are at most train_rows longs
    rows = arrow_map(texts.join(F.broadcast(known), "doc_id").select("doc_id", "y", "text"), featurise, "doc_id long, y int, f array<int>")
    # repeated ids: one text each, so the sample keeps its bound
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("y", "f")).alias("r")).select("doc_id", "r.y", "r.f")

    def learn(batches):
        model, held = Ftrl(bits, l1=l1), []
        for b in batches:
            f = b.column(2)
            held += [(y, f[i].values.to_numpy()) for i, y in enumerate(b.column(1).to_pylist())]
        docs_with = np.zeros(1 << bits, np.int32)
        for _, at in held:
            docs_with[at] += 1
        held = [(y, np.append(at[docs_with[at] >= min_docs], 1 << bits)) for y, at in held]
        for _ in range(epochs):
            for y, at in held:
                model.step(at, y)
        w = model.weights()
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w[at])], ["at", "w"])
    one = rows.orderBy(F.xxhash64("doc_id"), "doc_id").coalesce(1)
    got = arrow_map(one, learn, "at long, w double").collect()
    at, w = np.array([r[0] for r in got], np.int64), np.array([r[1] for r in got], np.float64)
    bias = float(w[at == 1 << bits].sum())
    return at[at < 1 << bits].astype(np.int32), w[at < 1 << bits].astype(np.float32), bias


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], bits: int = 22, threshold: float = 0.5) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        at, w, bias = sent.value
        dense = np.zeros(1 << bits, np.float32)
        dense[at] = w
        for b in batches:
            scores = []
            for text in raw(b.column(2)):
                f = features(text, bits)
                f = np.unique(f[dense[f] != 0])
                scores.append(1 / (1 + np.exp(-np.clip(bias + dense[f].sum(dtype=np.float64), -30, 30))))
            s = np.array(scores, np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", 5) == 0).alias("held_out"), "text")
    return arrow_map(rows, judge, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, bits: int = 22, threshold: float = 0.5, **fitting) -> DataFrame:
    return score(docs, fit(docs, labels, bits=bits, **fitting), bits, threshold)
