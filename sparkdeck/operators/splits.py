"""Sampling and train / test splits (X-01..X-07)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import OrderSpec, segmented_positions, with_row_index

_HASH_BUCKETS = 1_000_000


def sample_n(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` random rows (fewer only if the table is smaller).

    A Bernoulli pre-sample sized for ``n`` plus a five-sigma margin keeps about ``n``
    candidates; each gets a seeded random key and the first ``n`` by that key are
    kept through a global row index (X-07), so no task or driver merges per-partition
    candidate lists.  A short pre-sample falls back to the whole table: always exact.
    """
    total = df.count()
    if n >= total:
        return df
    frac = min(1.0, (n + 5 * math.sqrt(n) + 20) / total)
    pre = df.sample(False, frac, seed) if frac < 1.0 else df
    if frac < 1.0 and pre.count() < n:
        pre = df
    cand = pre.withColumn("_r", F.rand(seed))
    return with_row_index(cand, ["_r"], name="_i").filter(F.col("_i") < n).drop("_r", "_i")


def sample_frac(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(False, fraction, seed)


def _hash_unit(key_cols: Sequence[str], seed: int) -> Column:
    """A uniform number in [0, 1) from the row key — stable under any repartitioning."""
    h = F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed))
    return F.pmod(h, F.lit(_HASH_BUCKETS)) / F.lit(float(_HASH_BUCKETS))


def tag_partitions(df: DataFrame, weights: dict[str, float], seed: int = 1099,
                   key: Sequence[str] | None = None, name: str = "split") -> DataFrame:
    """One frame with a ``split`` column naming each row's part (weights are expected shares)."""
    total = float(sum(weights.values()))
    u = _hash_unit(key, seed) if key else F.rand(seed)
    expr, acc = None, 0.0
    items = list(weights.items())
    for i, (nm, w) in enumerate(items):
        acc += w / total
        cond = u < F.lit(acc) if i < len(items) - 1 else F.lit(True)
        expr = F.when(cond, F.lit(nm)) if expr is None else expr.when(cond, F.lit(nm))
    return df.withColumn(name, expr)


def partition(df: DataFrame, weights: dict[str, float], seed: int = 1099,
              key: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """``sdf_partition(training=0.5, test=0.5, seed=...)``: named, disjoint, complete parts.

    With ``key`` the part is a hash of the key (same rows whatever the partitioning);
    without it Spark's ``randomSplit`` is used (sorts each partition so the split is
    repeatable for one input layout).
    """
    if key:
        tagged = tag_partitions(df, weights, seed, key, name="_part")
        return {nm: tagged.filter(F.col("_part") == nm).drop("_part") for nm in weights}
    parts = df.randomSplit(list(weights.values()), seed)
    return dict(zip(weights.keys(), parts))


def split_frame(df: DataFrame, ratios: Sequence[float] = (0.75,), seed: int = 1,
                key: Sequence[str] | None = None) -> list[DataFrame]:
    """H2O-style split: ``ratios`` for all but the last part, which takes the rest."""
    ws = list(ratios) + [max(0.0, 1.0 - sum(ratios))]
    parts = partition(df, {f"p{i}": w for i, w in enumerate(ws)}, seed, key)
    return [parts[f"p{i}"] for i in range(len(ws))]


def block_kfold(df: DataFrame, k: int, order: Sequence[OrderSpec], name: str = "fold") -> DataFrame:
    """Fold id 1..k of each row: fold i holds the i-th contiguous block of ``order``.

    The row index is global (X-07) but never passes through one task; ``n`` enters as
    a scalar subquery.  ``fold_split`` picks the test block and the training rest.
    """
    idx = with_row_index(df, order, name="row_idx")
    n = df.select(F.count(F.lit(1))).scalar()
    return idx.withColumn(name, (F.floor(F.col("row_idx") * F.lit(k) / n) + 1).cast("long"))


def fold_split(folded: DataFrame, i: int, name: str = "fold") -> tuple[DataFrame, DataFrame]:
    return folded.filter(F.col(name) != i), folded.filter(F.col(name) == i)


def holdout_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[OrderSpec],
                    start: int, stop: int, max_test: int = 0, name: str = "split",
                    position: str = "pos", strategy: str = "range") -> DataFrame:
    """Per-key hold-out: a row is ``test`` when its position within its key (by ``order``,
    1-based) is in ``[start, stop]`` and fewer than ``max_test`` rows (in ``order``) are
    already in test; ``max_test <= 0`` means no cap.  All other rows are ``base``.

    Positions come from the skew-safe segmented scan; the cap numbers all rows
    globally with the qualifying ones first (again without a single-task window for
    large inputs) and keeps the first ``max_test`` of them.  Output: input columns + ``position`` + ``name``.
    """
    for c in (name, position):
        if c in df.columns:
            raise ValueError(f"output column {c!r} already exists in the input")
    keys = [key] if isinstance(key, str) else list(key)
    pos = segmented_positions(df, keys, order, row_number=position, strategy=strategy)
    qual = (F.col(position) >= start) & (F.col(position) <= stop)
    if max_test <= 0:
        return pos.withColumn(name, F.when(qual, "test").otherwise("base"))
    # one global numbering with the qualifying rows first (in ``order``): they get
    # indices 0..Q-1, and the numbered frame is read once instead of per branch
    ranked = with_row_index(pos.withColumn("_nq", (~qual).cast("int")), [("_nq", True)] + list(order),
                            name="_qidx", strategy=strategy)
    return ranked.withColumn(name, F.when(qual & (F.col("_qidx") < max_test), "test").otherwise("base")) \
        .drop("_nq", "_qidx")
