"""Feed-forward regression network (L-17) trained by parameter averaging.

``MultilayerPerceptronClassifier`` only classifies.  Training here is data
parallel: per epoch the weights are broadcast, every partition runs mini-batch SGD
over its own rows (``mapInPandas``, numpy), and returns one row — its weights and
row count; the driver averages them by rows.  The driver holds the weight vector
and one row per partition, never data rows.  Inputs and the response are
standardised from one aggregate; input dropout and ReLU hidden layers as H2O's
``Rectifier`` network.  Shuffling and dropout are seeded by epoch and partition, so
a run repeats for one partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _shapes(d: int, hidden: Sequence[int]) -> list[tuple[int, int]]:
    dims = [d] + list(hidden) + [1]
    return [(dims[i], dims[i + 1]) for i in range(len(dims) - 1)]


def _unpack(w: np.ndarray, shapes):
    out, i = [], 0
    for a, b in shapes:
        W = w[i:i + a * b].reshape(a, b)
        i += a * b
        bb = w[i:i + b]
        i += b
        out.append((W, bb))
    return out


def _pack(layers) -> np.ndarray:
    return np.concatenate([np.concatenate([W.ravel(), b]) for W, b in layers])


def _matrix(b: pd.DataFrame, xs) -> np.ndarray:
    """Feature matrix from numeric columns, or from one array column (``xs`` a str)."""
    if isinstance(xs, str):
        return np.stack([np.asarray(v, dtype=float) for v in b[xs]]) if len(b) else np.zeros((0, 0))
    return b[xs].to_numpy(dtype=float)


def _forward(X, layers):
    acts = [X]
    h = X
    for li, (W, b) in enumerate(layers):
        z = h @ W + b
        h = z if li == len(layers) - 1 else np.maximum(z, 0.0)
        acts.append(h)
    return acts


@dataclass
class NetworkModel:
    xs: list[str] | str
    hidden: list[int]
    weights: list[float]
    x_mean: list[float]
    x_std: list[float]
    y_mean: float
    y_std: float

    def transform(self, df: DataFrame, prediction: str = "predict") -> DataFrame:
        shapes = _shapes(len(self.x_mean), self.hidden)
        w = np.array(self.weights)
        xm, xsd = np.array(self.x_mean), np.array(self.x_std)
        ym, ysd = self.y_mean, self.y_std
        xs = self.xs

        def fn(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            layers = _unpack(w, shapes)
            for b in it:
                X = (_matrix(b, xs) - xm) / xsd
                p = _forward(np.nan_to_num(X), layers)[-1][:, 0] * ysd + ym
                b[prediction] = p
                yield b

        schema = T.StructType(df.schema.fields + [T.StructField(prediction, T.DoubleType())])
        return df.mapInPandas(fn, schema)


def _epoch_fn(w0: np.ndarray, shapes, xs, y, xm, xsd, ym, ysd, lr, batch, dropout, seed, epoch):
    def fn(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId() if TaskContext.get() else 0
        rng = np.random.default_rng(seed * 1_000_003 + epoch * 7919 + pid)
        layers = _unpack(w0.copy(), shapes)
        n, loss = 0, 0.0
        for b in it:
            b = b.dropna(subset=([xs] if isinstance(xs, str) else list(xs)) + [y])
            if not len(b):
                continue
            X = (_matrix(b, xs) - xm) / xsd
            Y = ((b[y].to_numpy(dtype=float) - ym) / ysd)[:, None]
            idx = rng.permutation(len(X))
            for s in range(0, len(X), batch):
                j = idx[s:s + batch]
                xb, yb = X[j], Y[j]
                if dropout > 0:
                    keep = rng.random(xb.shape) >= dropout
                    xb = xb * keep / (1.0 - dropout)
                acts = _forward(xb, layers)
                g = (acts[-1] - yb) * (2.0 / len(j))
                loss += float(np.sum((acts[-1] - yb) ** 2))
                for li in range(len(layers) - 1, -1, -1):
                    W, bb = layers[li]
                    gW = acts[li].T @ g
                    gb = g.sum(axis=0)
                    if li > 0:
                        g = (g @ W.T) * (acts[li] > 0)
                    layers[li] = (W - lr * gW, bb - lr * gb)
            n += len(X)
        if n:
            yield pd.DataFrame({"n": [n], "loss": [loss], "w": [_pack(layers).tolist()]})
    return fn


def fit_network(train: DataFrame, y: str, xs: Sequence[str], hidden: Sequence[int] = (10, 5, 10),
                epochs: int = 15, input_dropout: float = 0.7, learn_rate: float = 0.01, batch: int = 32,
                seed: int = 1) -> tuple[NetworkModel, list[float]]:
    """Returns the model and the mean training loss per epoch (standardised units).

    ``xs`` is a list of numeric columns or the name of one array<double> column."""
    if isinstance(xs, str):
        from pyspark.ml.functions import array_to_vector
        from pyspark.ml.stat import Summarizer
        sm = train.select(Summarizer.metrics("mean", "std").summary(array_to_vector(F.col(xs))).alias("s")).first()["s"]
        xm, xsd = sm["mean"].toArray(), sm["std"].toArray().copy()
        sy = train.agg(F.avg(y).alias("my"), F.stddev_pop(y).alias("sy")).first()
        ym, ysd = float(sy["my"]), float(sy["sy"] or 1.0)
    else:
        xs = list(xs)
        st = train.agg(*[F.avg(c).alias(f"m_{c}") for c in xs], *[F.stddev_pop(c).alias(f"s_{c}") for c in xs],
                       F.avg(y).alias("my"), F.stddev_pop(y).alias("sy")).first()
        xm = np.array([st[f"m_{c}"] for c in xs], dtype=float)
        xsd = np.array([st[f"s_{c}"] or 1.0 for c in xs], dtype=float)
        ym, ysd = float(st["my"]), float(st["sy"] or 1.0)
    xsd[xsd == 0] = 1.0
    shapes = _shapes(len(xm), hidden)
    rng = np.random.default_rng(seed)
    layers = [(rng.normal(0, np.sqrt(2.0 / a), (a, b)), np.zeros(b)) for a, b in shapes]
    w = _pack(layers)
    # cached: every epoch reads it again (lost blocks are recomputed from lineage)
    data = train.select(*([xs] if isinstance(xs, str) else xs), y).persist(StorageLevel.MEMORY_AND_DISK)
    out_schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("loss", T.DoubleType()),
                               T.StructField("w", T.ArrayType(T.DoubleType()))])
    history = []
    for ep in range(epochs):
        fn = _epoch_fn(w, shapes, xs, y, xm, xsd, ym, ysd, learn_rate, batch, input_dropout, seed, ep)
        # partitions' weights are averaged by Spark: the driver gets one vector an epoch
        each = data.mapInPandas(fn, out_schema).select("n", "loss", F.posexplode("w"))
        got = each.groupBy("pos").agg(F.sum(F.col("n") * F.col("col")).alias("w"), F.sum("n").alias("n"), F.sum("loss").alias("loss")).orderBy("pos").collect()
        w = np.array([r["w"] / r["n"] for r in got])
        history.append(got[0]["loss"] / got[0]["n"])
    data.unpersist()
    model = NetworkModel(xs, list(hidden), [float(v) for v in w], xm.tolist(), xsd.tolist(), ym, ysd)
    return model, history
