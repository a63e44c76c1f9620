"""Gradient boosting for classes (L-15) and numbers (L-16) on the shared binned matrix of ``trees``.

* Classes: K trees a round on softmax residuals, started from the log class priors; a leaf's step is Friedman's
  ``(K-1)/K * sum(r) / sum(|r|(1-|r|))``.
* Numbers: starts at the mean, a leaf's step is its mean residual, every tree is shrunk.

Both score every row: a NULL or NaN feature has a bin of its own.  A row with a NULL response (or, for classes, none of
the training labels) is left out of the fit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .trees import Ensemble, Matrix, Spec, cells, fit_boosters

#: Classes that a label column may have.
MAX_CLASSES = 1000


@dataclass
class MultinomialBoostModel:
    ensemble: Ensemble

    @property
    def labels(self) -> list[str]:
        return self.ensemble.labels

    def transform(self, df: DataFrame, prediction: str = "predict") -> DataFrame:
        """Adds p_<label> for each label and the most probable label (ties: the first)."""
        k = len(self.labels)
        d = df.withColumn("_F", self.ensemble.column())
        top = F.array_max("_F")
        d = d.withColumn("_e", F.transform("_F", lambda x: F.exp(x - top)))
        whole = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
        d = d.withColumn("_p", F.transform("_e", lambda x: x / whole))
        d = d.select("*", *[F.col("_p")[c].alias(f"p_{self.labels[c]}") for c in range(k)])
        best = F.array_position("_F", F.array_max("_F")).cast("int")
        return d.withColumn(prediction, F.element_at(F.array(*[F.lit(x) for x in self.labels]), best)).drop("_F", "_e", "_p")

    def importance(self, df: DataFrame) -> DataFrame:
        return self.ensemble.importance(df.sparkSession)

    def log_loss(self, df: DataFrame, label: str) -> DataFrame:
        """(round, rows, log_loss) on ``df`` after every round, 0 being the priors; one pass, a row a round and task is shuffled."""
        e = self.ensemble
        cls = F.array_position(F.array(*[F.lit(x) for x in e.labels]), F.col(label).cast("string")) - 1
        table = cells(df.where(F.col(label).cast("string").isin(e.labels)), e.xs, F.lit(0.0), cls, e.edges, 1.0)
        sent, d = df.sparkSession.sparkContext.broadcast(e), len(e.xs)

        def run(batches):
            for b in batches:
                e, m = sent.value, Matrix.of(b, d)
                scores = [np.tile(np.array(e.start), (len(m.n), 1)), *e.scores(m.bins, every_round=True)]
                lost = []
                for s in scores:
                    s = s - s.max(axis=1, keepdims=True)
                    p = s[np.arange(len(s)), m.cls] - np.log(np.exp(s).sum(axis=1))
                    lost.append(-float((m.n * p).sum()))
                yield pa.RecordBatch.from_pydict({"round": pa.array(range(len(lost)), pa.int32()), "rows": [int(m.n.sum())] * len(lost), "lost": lost})
        return table.mapInArrow(run, "round int, rows long, lost double").groupBy("round") \
            .agg(F.sum("rows").alias("rows"), (F.sum("lost") / F.sum("rows")).alias("log_loss")).orderBy("round")


def fit_multinomial_boost(df: DataFrame, label: str, xs: Sequence[str], ntrees: int = 20, max_depth: int = 3, learn_rate: float = 0.01,
                          col_sample_rate: float = 0.7, seed: int = 1, sample_rate: float = 1.0, **rest) -> MultinomialBoostModel:
    """A booster over the label's values in ascending order."""
    labels = [r[0] for r in df.where(F.col(label).isNotNull()).select(F.col(label).cast("string")).distinct().limit(MAX_CLASSES + 1).collect()]
    if len(labels) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    spec = Spec(ntrees, max_depth, learn_rate, sample_rate, col_sample_rate, seed=seed)
    return MultinomialBoostModel(fit_boosters(df, label, xs, [spec], labels=sorted(labels), **rest)[0])


@dataclass
class RegressionBoostModel:
    ensemble: Ensemble

    def transform(self, df: DataFrame, prediction: str = "predict") -> DataFrame:
        return df.withColumn(prediction, self.ensemble.column()[0])

    def importance(self, df: DataFrame) -> DataFrame:
        return self.ensemble.importance(df.sparkSession)


def fit_regression_boost(df: DataFrame, y: str, xs: Sequence[str], ntrees: int = 50, max_depth: int = 5, learn_rate: float = 0.1,
                         sample_rate: float = 1.0, col_sample_rate: float = 1.0, seed: int = 1, **rest) -> RegressionBoostModel:
    """Start from the mean; each tree is grown on the residuals of a sample of the rows and added shrunk by ``learn_rate``.
    Spark's ``GBTRegressor`` instead gives the first tree weight 1, which differs strongly at small rates."""
    return RegressionBoostModel(fit_boosters(df, y, xs, [Spec(ntrees, max_depth, learn_rate, sample_rate, col_sample_rate, seed=seed)], **rest)[0])
