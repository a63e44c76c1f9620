"""Evaluation aggregates on classes never predicted, NULL classes and one-scan plans."""

from sparkdeck.ml.evaluate import class_error, cluster_stats, confusion_long


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_confusion_lists_every_class_on_both_sides(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("b", "a"), (None, "c")], "y string, p string")
    want = {("a", "a"): 1, ("b", "a"): 2, (None, "c"): 1}
    names = ["a", "b", "c", None]
    assert _rows(confusion_long(df, "y", "p")) == sorted(((y, p, want.get((y, p), 0)) for y in names for p in names), key=repr)


def test_confusion_of_doubles(spark):
    df = spark.createDataFrame([(1.5, 1.5), (2.0, 1.5)], "y double, p double")
    assert _rows(confusion_long(df, "y", "p")) == [(1.5, 1.5, 1), (1.5, 2.0, 0), (2.0, 1.5, 1), (2.0, 2.0, 0)]


def test_class_error_keeps_null_class_apart_from_the_total(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "a")], "y string, p string")
    assert _rows(class_error(df, "y", "p")) == sorted([("a", 2, 1, 0.5), (None, 1, None, None), ("Total", 3, 1, 1 / 3)], key=repr)


def test_cluster_stats_equal_given_means(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (0, 3.0, 2.5), (1, 7.0, 1.0)], "prediction int, x double, z double")
    means = df.groupBy("prediction").avg("x", "z").toDF("prediction", "x", "z")
    one, two = _rows(cluster_stats(df, ["x", "z"])), _rows(cluster_stats(df, ["x", "z"], centers=means))
    assert [r[:2] for r in one] == [r[:2] for r in two]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(one, two))
