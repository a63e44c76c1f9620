"""Hyper-parameter search for boosted regression trees (R-01..R-05).

Cartesian or random-discrete grids over learning rate, depth, row and column sample rates.  The features are binned
once and all models of a wave are grown together over that matrix (``trees``); a wave is scored on a *given*
validation frame in one pass.  Stop rules: model count, run time and no improvement.  The no-improvement rule looks
at the models in the order of their numbers and discards what comes behind the stop, so the board is the same
at any parallelism.  The leaderboard is a DataFrame sorted by validation MSE.
"""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import RegressionBoostModel
from .trees import Spec, fit_boosters, squared_errors

#: H2O-style names of the searched parameters.
PARAMS = ("learn_rate", "max_depth", "sample_rate", "col_sample_rate")


def combination(hyper: dict[str, Sequence], index: int) -> dict:
    """Decode a mixed-radix index into one combination (no full product is built)."""
    out = {}
    for name in reversed(list(hyper)):
        vals = list(hyper[name])
        index, r = divmod(index, len(vals))
        out[name] = vals[r]
    return {k: out[k] for k in hyper}


def combinations(hyper: dict[str, Sequence], strategy: str = "Cartesian", max_models: int | None = None,
                 seed: int = 1) -> list[dict]:
    total = 1
    for v in hyper.values():
        total *= len(v)
    if strategy == "Cartesian":
        combos = [dict(zip(hyper, vals)) for vals in itertools.product(*hyper.values())]
        return combos[:max_models] if max_models else combos
    if strategy == "RandomDiscrete":
        n = min(total, max_models or total)
        return [combination(hyper, i) for i in random.Random(seed).sample(range(total), n)]
    raise ValueError(strategy)


def stop_after(errors: Sequence[float], rounds: int | None, tolerance: float) -> int | None:
    """The number of models up to the first that brings ``rounds`` models without an improvement of the best error by more
    than ``tolerance`` (a share); None while none does."""
    best: list[float] = []
    for e in errors:
        best.append(min(e, best[-1]) if best else e)
        if rounds and len(best) > rounds and best[-rounds - 1] - best[-1] <= tolerance * abs(best[-rounds - 1]):
            return len(best)
    return None


def grid_search(train: DataFrame, valid: DataFrame, y: str, xs: Sequence[str], hyper: dict[str, Sequence],
                strategy: str = "Cartesian", ntrees: int = 100, seed: int = 1, max_models: int | None = None,
                max_runtime_secs: float | None = None, stopping_rounds: int | None = None,
                stopping_tolerance: float = 1e-3, parallelism: int | None = None, decreasing: bool = False, **rest):
    """Returns (leaderboard DataFrame, {model_id: fitted model}).

    ``parallelism`` is the size of a wave: all models together, or 16 where a stop rule may end the search.  The
    run time is looked at between waves."""
    spark = train.sparkSession
    todo = combinations(hyper, strategy, max_models, seed)
    wave = parallelism or (16 if stopping_rounds or max_runtime_secs is not None else max(1, len(todo)))
    specs = [Spec(ntrees, int(c.get("max_depth", 5)), float(c.get("learn_rate", 0.1)), float(c.get("sample_rate", 1.0)),
                  float(c.get("col_sample_rate", 1.0)), seed=seed) for c in todo]
    start, models, errors = time.time(), [], []
    train, valid = train.select(*xs, y), valid.select(*xs, y)
    for at in range(0, len(todo), wave):
        if max_runtime_secs is not None and time.time() - start >= max_runtime_secs:
            break
        new = fit_boosters(train, y, xs, specs[at:at + wave], **rest)
        models += new
        errors += squared_errors(valid, y, new)
        last = stop_after([e for e in errors if e is not None], stopping_rounds, stopping_tolerance)
        if last is not None:
            models, errors = models[:last], errors[:last]
            break
    results = [(f"model_{i + 1}", *[_num(c.get(p)) for p in PARAMS], e) for i, (c, e) in enumerate(zip(todo, errors))]
    schema = "model_id string, " + ", ".join(f"{p} double" for p in PARAMS) + ", mse double"
    board = spark.createDataFrame(results, schema)
    board = board.orderBy(F.desc("mse") if decreasing else F.asc("mse"), "model_id")
    return board, {f"model_{i + 1}": RegressionBoostModel(m) for i, m in enumerate(models)}


def _num(v):
    return None if v is None else float(v)


def best_model(board: DataFrame, models: dict):
    """The row of the lowest error and its model (R-05)."""
    top = board.orderBy(F.asc_nulls_last("mse"), "model_id").first()
    return top, models[top["model_id"]]
