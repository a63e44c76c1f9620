"""NULL group keys are groups; ties, late values and odd column names keep their meaning."""

import pytest
from pyspark.sql import functions as F

from sparkdeck.operators.features import interpolate_linear
from sparkdeck.operators.ordered import exact_quantiles, segmented_positions
from sparkdeck.operators.stats import boxplot_stats, crosstab_long
from sparkdeck.operators.verbs import group_extremes
from sparkdeck.sources.files import read_csv


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 9.0), (None, 7.0)], "k string, v double")


def test_null_group_stays(df):
    assert sorted((r.k or "", r.v) for r in group_extremes(df, ["k"], "v").collect()) == [("", 5.0), ("", 9.0), ("a", 1.0), ("a", 3.0)]
    for strategy in ("window", "scan"):
        assert {r.k: r.q50 for r in exact_quantiles(df, ["k"], "v", [0.5], strategy=strategy).collect()} == {"a": 2.0, None: 7.0}
        assert {r.k: r.n for r in boxplot_stats(df, "v", "k", strategy=strategy).collect()} == {"a": 2, None: 3}


def test_ties_do_not_depend_on_the_strategy(spark):
    d = spark.range(60).select("id", F.lit(1).alias("o"), (F.col("id") % 2).alias("k"))
    runs = [{r.id: r.row_number for r in segmented_positions(d.repartition(n), ["k"], ["o"], strategy=s, num_partitions=p).collect()}
            for n, s, p in ((1, "window", None), (7, "window", None), (3, "scan", 1), (3, "scan", 16))]
    assert all(r == runs[0] for r in runs)


def test_crosstab_of_any_values(spark):
    d = spark.createDataFrame([("b", 1.5), ("x.y", None), (None, 1.5)], "b string, a double")
    got = {(r.b, r.a): r.n for r in crosstab_long(d, "b", "a").collect()}
    assert got == {("b", 1.5): 1, ("b", None): 0, ("x.y", 1.5): 0, ("x.y", None): 1, (None, 1.5): 1, (None, None): 0}


def test_late_decimal_keeps_its_value(spark, tmp_path):
    (tmp_path / "x.csv").write_text("v\n" + "\n".join("12.5" if i == 1500 else "3" for i in range(2000)))
    assert read_csv(spark, str(tmp_path / "x.csv")).agg(F.sum("v")).first()[0] == 3 * 1999 + 12.5


def test_interpolation_of_a_long_series(spark):
    d = spark.range(50_000).select("id", F.lit("a").alias("k"), F.timestamp_seconds("id").alias("t"),
                                   F.when(F.col("id") % 1000 == 0, F.col("id").cast("double")).alias("v"))
    got = interpolate_linear(d, ["k"], "t", "v", "f", strategy="window")
    assert got.where((F.col("id") <= 49_000) & (F.abs(F.col("f") - F.col("id")) > 1e-6)).count() == 0
