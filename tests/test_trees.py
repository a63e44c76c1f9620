"""The shared-matrix boosters: both ways of growing, a plain reference, missing values, importance, stop rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdeck.ml import search, trees
from sparkdeck.ml.boosting import fit_multinomial_boost, fit_regression_boost

SPECS = [trees.Spec(4, 3, 0.3, 0.8, 0.5, seed=3), trees.Spec(2, 5, 0.1), trees.Spec(3, 1, 1.0, 0.5)]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        a, b = float(rng.integers(0, 40)), float(rng.normal())
        y = 3.0 * (a > 20) + b + rng.normal() * 0.1
        rows.append((None if i % 13 == 0 else a, float("nan") if i % 17 == 0 else b, 1.0, None if i % 50 == 0 else float(y), "hi" if y > 2 else "lo" if y < 0 else "mid"))
    return spark.createDataFrame(rows, "a double, b double, c double, y double, k string").repartition(3)


def _same(one, two):
    return all(np.array_equal(getattr(one, c), getattr(two, c)) for c in trees._ARRAYS)


@pytest.mark.parametrize("labels", [None, ["hi", "lo", "mid"]])
def test_both_ways_and_any_partitioning_grow_the_same_trees(table, labels):
    y = "k" if labels else "y"
    few = trees.fit_boosters(table, y, ["a", "b", "c"], SPECS, labels=labels)
    many = trees.fit_boosters(table.repartition(5), y, ["a", "b", "c"], SPECS, labels=labels, few_cells=-1, block_cells=100)
    assert [len(e.roots) for e in few] == [4, 2, 3] and all(map(_same, few, many))


def test_one_full_tree_is_the_best_split_by_hand(table):
    model = fit_regression_boost(table, "y", ["a", "b"], ntrees=1, max_depth=1, learn_rate=1.0, bins=200)
    got = model.transform(table).collect()
    rows = [r for r in got if r.y is not None]
    y, best = np.array([r.y for r in rows]), None
    for x in (np.array([-1.0 if r.a is None else r.a for r in rows]), np.array([-99.0 if np.isnan(r.b) else r.b for r in rows])):
        for cut in np.unique(x)[:-1]:
            left = x <= cut
            sse = y[left].var() * left.sum() + y[~left].var() * (~left).sum()
            best = min(best or sse, sse)
    fitted = np.array([r.predict for r in rows])
    assert len(got) == 600 and ((y - fitted) ** 2).sum() <= best * 1.02      # at most the bins' width away from the best cut
    assert len(set(np.round(fitted, 6))) == 2 and abs(fitted.mean() - y.mean()) < 1e-6


def test_every_row_is_scored_and_more_trees_fit_better(table):
    model = fit_multinomial_boost(table, "k", ["a", "b", "c"], ntrees=12, learn_rate=0.3)
    out = model.transform(table)
    assert out.count() == 600 and out.where("predict is null").count() == 0
    assert out.where(F.abs(F.col("p_hi") + F.col("p_lo") + F.col("p_mid") - 1) > 1e-9).count() == 0
    assert out.where("predict = k").count() > 480
    loss = [r.log_loss for r in model.log_loss(table, "k").collect()]
    assert len(loss) == 13 and all(x > y for x, y in zip(loss, loss[1:]))
    rows = {r.variable: r for r in model.importance(table).collect()}
    assert rows["c"].relative_importance == 0 and sum(r.percentage for r in rows.values()) == pytest.approx(1)
    assert max(r.scaled_importance for r in rows.values()) == 1


def test_squared_errors_equal_the_predictions(table):
    models = trees.fit_boosters(table, "y", ["a", "b", "c"], SPECS)
    for m, e in zip(models, trees.squared_errors(table, "y", models)):
        assert table.withColumn("p", m.column()[0]).agg(F.avg((F.col("y") - F.col("p")) ** 2)).first()[0] == pytest.approx(e, rel=1e-6)
    assert trees.squared_errors(table.limit(0), "y", models) == [None] * 3


def test_stop_rule_by_model_number(table):
    assert search.stop_after([5, 4, 4, 4, 1], 2, 1e-3) == 4 and search.stop_after([5, 4, 3, 2], 2, 1e-3) is None and search.stop_after([3, 3], None, 0.1) is None
    hyper = {"learn_rate": [0.3, 0.2, 0.1, 0.05], "max_depth": [1, 2]}
    boards = [[tuple(r) for r in search.grid_search(table, table, "y", ["a", "b"], hyper, ntrees=3, stopping_rounds=2, parallelism=p)[0].collect()] for p in (1, 8)]
    assert boards[0] == boards[1] and 3 <= len(boards[0]) < 8


def test_empty_training(table):
    model = fit_regression_boost(table.limit(0), "y", ["a", "b"], ntrees=2)
    assert [r.predict for r in model.transform(table.limit(3)).collect()] == [0.0] * 3


def test_levels_run_on_every_core(spark):
    """Few bytes of cells are much work: by size Spark would put them all into one task."""
    sc = spark.sparkContext
    table = spark.range(400).select((F.col("id") % 20).cast("double").alias("a"), F.floor(F.col("id") / 20).cast("double").alias("b"),
                                    F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("k")).coalesce(1)
    sc.setJobGroup("levels", "levels")
    try:
        many = trees.fit_boosters(table, "k", ["a", "b"], [trees.Spec(ntrees=3, max_depth=2)], labels=["x", "y"], few_cells=-1)
        status = sc.statusTracker()
        tasks = [i.numTasks for j in status.getJobIdsForGroup("levels") for k in status.getJobInfo(j).stageIds if (i := status.getStageInfo(k))]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert max(tasks) >= sc.defaultParallelism
    few = trees.fit_boosters(table, "k", ["a", "b"], [trees.Spec(ntrees=3, max_depth=2)], labels=["x", "y"])
    assert all((getattr(many[0], c) == getattr(few[0], c)).all() for c in ("roots", "feature", "cut", "left", "step"))
