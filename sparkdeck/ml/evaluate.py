"""Evaluation aggregates over prediction columns (L-04, L-13, L-18, L-22): one Spark
aggregate each, so they work on stored predictions of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.verbs import paired


def regression_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """MSE, RMSE, MAE and R² in one pass (R² from the sums, no second scan)."""
    r = F.col(y) - F.col(pred)
    a = df.filter(F.col(y).isNotNull() & F.col(pred).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg(r * r).alias("mse"), F.avg(F.abs(r)).alias("mae"),
        F.var_pop(y).alias("_vy"))
    return a.select("n", "mse", F.sqrt("mse").alias("rmse"), "mae",
                    (F.lit(1.0) - F.col("mse") / F.col("_vy")).alias("r2"))


def metrics_by_split(parts: dict[str, DataFrame], y: str, pred: str, name: str = "split") -> DataFrame:
    """One metric row per named part in a single job: tag, union, one ``groupBy``."""
    tagged = None
    for nm, d in parts.items():
        t = d.select(F.lit(nm).alias(name), F.col(y).alias("_y"), F.col(pred).alias("_p"))
        tagged = t if tagged is None else tagged.unionByName(t)
    r = F.col("_y") - F.col("_p")
    return tagged.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.avg(r * r).alias("mse"))


def metrics_by_tag(df: DataFrame, tag: str, y: str, pred: str, name: str = "split") -> DataFrame:
    """One metric row for each value of the column ``tag``: one scan for all parts of a frame tagged by ``tag_partitions``."""
    r = F.col(y) - F.col(pred)
    return df.where(F.col(tag).isNotNull()).groupBy(F.col(tag).alias(name)).agg(F.count(F.lit(1)).alias("n"), F.avg(r * r).alias("mse"))


def confusion_long(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Confusion matrix in long form (actual, predicted, n).

    Both sides list every class that occurs on either, so a class never predicted keeps its
    zero cells; NULL counts as a class.  One scan: the cells hold one row per pair of classes.
    """
    cells = df.groupBy(F.col(actual).alias("_a"), F.col(predicted).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    classes = cells.select(F.explode(F.array("_a", "_p")).alias("_c")).distinct()
    grid = paired(classes, classes.select(F.col("_c").alias("_d")))
    found = grid.join(cells, F.col("_c").eqNullSafe(F.col("_a")) & F.col("_d").eqNullSafe(F.col("_p")), "left")
    return found.select(F.col("_c").alias(actual), F.col("_d").alias(predicted), F.coalesce("_n", F.lit(0)).alias("n"))


def class_error(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per-class and total error rate, as printed under an H2O confusion matrix; one scan, no row for an empty table."""
    rows = df.select(F.col(actual).cast("string").alias("_class"), (F.col(actual) != F.col(predicted)).cast("long").alias("_wrong"))
    both = rows.rollup("_class").agg(F.grouping("_class").alias("_all"), F.count(F.lit(1)).alias("n"), F.sum("_wrong").alias("n_wrong"))
    return both.select(F.when(F.col("_all") == 1, "Total").otherwise(F.col("_class")).alias("class"), "n", "n_wrong",
                       (F.col("n_wrong") / F.col("n")).alias("error"))


def cluster_stats(df: DataFrame, cols: Sequence[str], prediction: str = "prediction",
                  centers: DataFrame | None = None) -> DataFrame:
    """Per-cluster size and within-cluster sum of squares.

    Centres default to the cluster means, whose sum of squares is count times variance: one
    aggregate (NULL values count nowhere).  Given centres hold one row per cluster and are joined.
    """
    cols = list(cols)
    if centers is None:
        ss = sum(F.count(c) * F.var_pop(c) for c in cols)
        return df.groupBy(prediction).agg(F.count(F.lit(1)).alias("size"), ss.alias("within_ss"))
    centers = centers.select(prediction, *[F.col(c).alias(f"_c_{c}") for c in cols])
    j = df.select(prediction, *cols).join(centers, prediction)
    d2 = sum((F.col(c) - F.col(f"_c_{c}")) * (F.col(c) - F.col(f"_c_{c}")) for c in cols)
    return j.groupBy(prediction).agg(F.count(F.lit(1)).alias("size"), F.sum(d2).alias("within_ss"))


def cluster_stats_array(df: DataFrame, arr: str, centers: DataFrame, prediction: str = "prediction") -> DataFrame:
    """``cluster_stats`` for an array column: squared distance with built-in higher-order
    functions (JVM side); ``centers`` holds (prediction, center array) — k rows."""
    j = df.select(prediction, arr).join(centers, prediction)
    d2 = F.aggregate(F.zip_with(arr, "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
    return j.groupBy(prediction).agg(F.count(F.lit(1)).alias("size"), F.sum(d2).alias("within_ss"))
