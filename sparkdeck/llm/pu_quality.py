"""Quality classifier by positive-unlabelled learning.

Trusted positives are training documents labelled 1 (at most ``train_rows``, lowest id
hashes); the unlabelled side is every document outside the held-out fifth, whatever
its label.  The class prior p is the share of label 1 among all labelled training rows.
A logistic model over text statistics minimises the non-negative unbiased risk

    p * R_pos(+1)  +  max(0, R_unl(-1) - p * R_pos(-1))

with logistic loss.  Mean, spread, gradient and curvature of the unlabelled side are
sums that Spark takes over all its rows, one pass for a Newton step and one that tries
shorter steps and steps along the edge of the bracket; the least risk among those with
a bracket of zero or more wins, so no step drives the estimated negative risk below
zero.  The driver holds the positives and a few hundred sums.

Statistics and scores cover every whole text.

Edge cases: NULL and empty texts have all-zero statistics and a score like any other;
rows are scored one for one; without positives (or unlabelled rows) every score is the prior, 0.5
if there is no label.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import fold, hashed_sample, training_labels
from .util import arrow_map, raw, stored


def _class_table() -> np.ndarray:
    """256 x classes: which bytes count for which share."""
    groups = [range(65, 91), range(97, 123), range(48, 58), b" ", b"\n", b"\t\r", b".", b",", b"!", b"?", b"|",
              b"*%$&#@^~", b"<>{}[]\\=", b"-_+/:;", b"\"'()`", range(128, 256), range(0, 9)]
    table = np.zeros((256, len(groups)))
    for k, g in enumerate(groups):
        table[list(g), k] = 1
    return table


_CLASSES = _class_table()
WIDTH = _CLASSES.shape[1] + 9


def statistics(text: bytes | None) -> np.ndarray:
    """Shares of byte classes (square roots, so small shares count) and of repeated words and lines."""
    out = np.zeros(WIDTH)
    if not text:
        return out
    n = len(text)
    k = _CLASSES.shape[1]
    out[:k] = np.sqrt(np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES / n)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x]
    if words:
        counts = Counter(words)
        top = max(counts.values())
        m = len(words)
        out[k:] = (np.log1p(n), np.log1p(m), len(counts) / m, np.sqrt(top / m), n / m / 10, len(set(lines)) / max(len(lines), 1),
                   np.log1p(len(lines)), np.log1p(n / max(len(lines), 1)), sum(c * c for c in counts.values()) ** 0.5 / m)
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, row, f): the statistics of every text, stored; row hashes id and text."""
    def measure(batches):
        for b in batches:
            f = np.array([statistics(t) for t in raw(b.column(2))], np.float32).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(3), pa.ListArray.from_arrays(pa.array(np.arange(len(f) + 1) * WIDTH, pa.int32()), pa.array(f.ravel()))],
                ["doc_id", "held_out", "row", "f"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", 5) == 0).alias("held_out"), "text",
                       F.xxhash64("doc_id", "text").alias("row"))
    return stored(docs.sparkSession, arrow_map(rows, measure, "doc_id long, held_out boolean, row long, f array<float>"), "statistics")


def sums(stats: DataFrame, of, width: int) -> np.ndarray:
    """The sum over all unlabelled rows of ``of`` (a matrix of statistics -> a vector of ``width`` sums)."""
    def add(batches):
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                total += of(_matrix(b.column(0)))
        yield pa.RecordBatch.from_pydict({"place": np.arange(width), "v": total})
    rows = arrow_map(stats.where("not held_out").select("f"), add, "place long, v double").groupBy("place").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(width)
    for r in rows:                                   # one row a sum
        out[r["place"]] = r["v"]
    return out


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH).astype(float)


def _sig(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def nn_pu(pos: np.ndarray, sums_of, n: float, prior: float, steps: int = 25, l2: float = 1e-4) -> np.ndarray:
    """The weights (bias last) with the least non-negative PU risk, by damped Newton steps.

    ``pos``: positives, with a last column of ones; ``sums_of(of, width)``: sums over the ``n`` unlabelled rows."""
    k = pos.shape[1]
    w, lengths = np.zeros(k), 0.5 ** np.arange(8)
    ridge = np.diag(np.append(np.full(k - 1, l2), 0.0))

    def bracket(w, unl):
        return unl - prior * np.logaddexp(0, pos @ w).mean()

    def risk(w, unl):
        return prior * np.logaddexp(0, -(pos @ w)).mean() + max(0.0, bracket(w, unl)) + w @ ridge @ w / 2

    def newton_sums(w):
        def of(x):
            g = x @ w
            s = _sig(g)
            return np.concatenate([[np.logaddexp(0, g).sum()], x.T @ s, ((x * (s * (1 - s))[:, None]).T @ x).ravel()])
        total = sums_of(of, 1 + k + k * k) / n
        return total[0], total[1:1 + k], total[1 + k:].reshape(k, k)

    for _ in range(steps):
        unl, slope, bend = newton_sums(w)
        curve = bend + ridge + 1e-6 * np.eye(k)
        whole = slope - prior * pos.mean(0) + ridge @ w                # the losses of label +1 and -1 differ by the score itself
        rise = slope - prior * (pos.T @ _sig(pos @ w)) / len(pos)      # of the bracket
        down, across = np.linalg.solve(curve, np.column_stack([whole, rise])).T
        # the Newton step, and the part of it that leaves the bracket as it is
        ways = [-down, rise @ down / max(rise @ across, 1e-12) * across - down]
        tries = np.concatenate([w + lengths[:, None] * way for way in ways])
        found = sums_of(lambda x: np.logaddexp(0, x @ tries.T).sum(0), len(tries)) / n
        risks = [risk(t, u) if bracket(t, u) >= 0 else np.inf for t, u in zip(tries, found)]
        best = int(np.argmin(risks))
        if not risks[best] < risk(w, unl) - 1e-7:
            break
        w = tries[best]
    return w


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.3,
             train_rows: int = 20_000, with_row: bool = False) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted (and row, a hash of id and text)."""
    spark = docs.sparkSession
    stats = with_statistics(docs)
    known = training_labels(labels, label_col)
    prior = known.agg(F.avg("y")).first()[0]
    prior = 0.5 if prior is None else float(min(max(prior, 0.01), 0.99))
    trusted = hashed_sample(known.where("y = 1"), train_rows)
    pos = stats.join(F.broadcast(trusted), "doc_id").groupBy("doc_id").agg(F.min("f").alias("f")).select("f").toArrow()
    pos = np.array(pos.column(0).to_pylist(), float).reshape(-1, WIDTH)
    first = sums(stats, lambda x: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]), 1 + 2 * WIDTH)
    n = first[0]
    mean, spread, w, bias = np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), float(np.log(prior / (1 - prior)))
    if len(pos) and n:
        mean = first[1:1 + WIDTH] / n
        spread = np.sqrt(np.maximum(first[1 + WIDTH:] / n - mean ** 2, 0)) + 1e-3
        scaled = lambda x: np.column_stack([(x - mean) / spread, np.ones(len(x))])
        fitted = nn_pu(scaled(pos), lambda of, width: sums(stats, lambda x: of(scaled(x)), width), n, prior)
        w, bias = fitted[:-1], fitted[-1]

    def judge(batches):
        for b in batches:
            s = _sig(((_matrix(b.column(3)) - mean) / spread) @ w + bias)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             ["doc_id", "held_out", "row", "score", "predicted"])
    out = arrow_map(stats, judge, "doc_id long, held_out boolean, row long, score double, predicted int")
    return out if with_row else out.drop("row")
