"""Semantics on seeded stand-ins (FIXTURES.md §3), checked against brute force in Python."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sparkdeck.functions.scalars import year_from_text
from sparkdeck.operators.ordered import rank_within
from sparkdeck.operators.splits import holdout_per_key
from sparkdeck.operators.verbs import group_extremes, join_by


def _flights(spark, seed=11):
    rng = np.random.default_rng(seed)
    n = 500
    day = rng.integers(1, 30, n)
    day[0] = 31                                  # a day with one row
    dep = rng.integers(-10, 60, n).astype(float)
    dep[rng.random(n) < 0.08] = np.nan           # missing delays
    dep[1:4] = 100.0
    day[1:4] = 5                                 # tie for a day's maximum
    carrier = rng.choice(["AA", "UA", "WN", "ZZ"], n)   # ZZ is missing from airlines
    pdf = pd.DataFrame({"id": np.arange(n), "day": day, "dep_delay": dep, "carrier": carrier})
    df = spark.createDataFrame(pdf).withColumn(
        "dep_delay", F.when(F.isnan("dep_delay"), None).otherwise(F.col("dep_delay")))
    return pdf, df


def test_group_extremes_ties_and_nulls(spark):
    pdf, df = _flights(spark)
    got = sorted(r.id for r in group_extremes(df, ["day"], "dep_delay").collect())
    g = pdf.groupby("day").dep_delay
    mn, mx = g.transform("min"), g.transform("max")
    exp = sorted(pdf[(pdf.dep_delay == mn) | (pdf.dep_delay == mx)].id.tolist())
    assert got == exp
    assert {1, 2, 3} <= set(got)


def test_three_join_spellings_agree(spark):
    _, df = _flights(spark)
    airlines = spark.createDataFrame([("AA", "American"), ("UA", "United"), ("WN", "Southwest")],
                                     "carrier string, name string")
    a = join_by(df, airlines)
    b = join_by(df, airlines, "carrier")
    c = join_by(df, airlines, ["carrier", "carrier"])
    rows = [sorted(map(tuple, x.select("id", "carrier", "name").collect())) for x in (a, b, c)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 500
    assert all(r[2] is None for r in rows[0] if r[1] == "ZZ")
    assert a.columns.count("carrier") == 1


def test_top2_rank_then_filter(spark):
    rng = np.random.default_rng(3)
    n = 200
    pdf = pd.DataFrame({"row": np.arange(n), "player": rng.integers(0, 25, n), "H": rng.integers(0, 6, n).astype(float)})
    pdf.loc[rng.random(n) < 0.1, "H"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("H", F.when(F.isnan("H"), None).otherwise(F.col("H")))
    for strategy in ("window", "scan"):
        r = rank_within(df, ["player"], [("H", False)], name="rk", strategy=strategy,
                        num_partitions=None if strategy == "window" else 6)
        got = sorted(x.row for x in r.filter((F.col("rk") <= 2) & (F.col("H") > 0)).collect())
        rk = pdf.assign(h=pdf.H.fillna(-np.inf)).groupby("player").h.rank(method="min", ascending=False)
        exp = sorted(pdf[(rk <= 2) & (pdf.H > 0)].row.tolist())
        assert got == exp, strategy


def test_year_rule(spark):
    df = spark.createDataFrame([("01-Jan-1995",), ("",), (None,), ("12-Mar-1977",)], "d string")
    got = [r.y for r in df.select(year_from_text("d").alias("y")).collect()]
    assert got == [1995, 1900, None, 1977]


def _expected_holdout(rows, start, stop, cap):
    """The hold-out from counts alone: a row qualifies by its number within its user, and
    at most ``cap`` qualifying rows (0: all), in input order, are taken."""
    pdf = pd.DataFrame(rows, columns=["line", "user"]).sort_values("line")
    qualifies = (pdf.groupby("user").cumcount() + 1).between(start, stop)
    if cap:
        qualifies &= qualifies.cumsum() <= cap
    return dict(zip(pdf.line, np.where(qualifies, "test", "base")))


def test_holdout_matches_reference_walk(spark):
    rng = np.random.default_rng(5)
    users = np.concatenate([np.repeat(np.arange(40), rng.integers(2, 40, 40))])
    rng.shuffle(users)
    rows = list(enumerate(users.tolist()))
    df = spark.createDataFrame(rows, "line long, user long")
    for start, stop, cap in [(1, 10, 0), (11, 20, 0), (1, 10, 150)]:
        got = {r.line: r.split for r in holdout_per_key(df, "user", ["line"], start, stop, cap).collect()}
        assert got == _expected_holdout(rows, start, stop, cap), (start, stop, cap)


def test_boxplot_against_brute_force(spark):
    from sparkdeck.operators.stats import boxplot_stats
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": rng.choice(list("abc"), 600), "x": rng.standard_t(3, 600)})
    got = {r.g: r for r in boxplot_stats(spark.createDataFrame(pdf), "x", "g").collect()}
    for g, grp in pdf.groupby("g"):
        x = grp.x.values
        q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        r = got[g]
        assert np.allclose([r.q1, r.median, r.q3], [q1, med, q3])
        assert r.lower_whisker == x[x >= lo].min() and r.upper_whisker == x[x <= hi].max()
        assert r.n_outliers == int(((x < lo) | (x > hi)).sum()) and r.n == len(x)


def test_string_index_ties_by_name(spark):
    from sparkdeck.operators.features import string_index
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", "b", "a", "d"]], "s string")
    model, _ = string_index(df, "s", "i")
    assert list(model.labels) == ["a", "b", "c", "d"]   # a, b, c tie at 2: by name; d last


def test_block_kfold_uneven(spark):
    from sparkdeck.operators.splits import block_kfold
    df = spark.range(23).select(F.col("id").alias("k"))
    got = [r.fold for r in block_kfold(df, 5, ["k"]).orderBy("k").collect()]
    assert got == [int(np.floor(i * 5 / 23)) + 1 for i in range(23)]
    assert sorted(set(got)) == [1, 2, 3, 4, 5]


def test_welch_t_against_numpy(spark):
    from sparkdeck.operators.stats import pairwise_t_test
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({"g": np.repeat(["a", "b", "c"], [40, 70, 55]),
                        "x": np.concatenate([rng.normal(0, 1, 40), rng.normal(0.5, 2, 70), rng.normal(1, 3, 55)])})
    got = {(r.group_a, r.group_b): r for r in
           pairwise_t_test(spark.createDataFrame(pdf), "x", "g", p_adjust=None, pooled=False).collect()}
    for (ga, gb), r in got.items():
        xa, xb = pdf[pdf.g == ga].x.values, pdf[pdf.g == gb].x.values
        va, vb = xa.var(ddof=1) / len(xa), xb.var(ddof=1) / len(xb)
        t = (xa.mean() - xb.mean()) / np.sqrt(va + vb)
        df = (va + vb) ** 2 / (va ** 2 / (len(xa) - 1) + vb ** 2 / (len(xb) - 1))
        assert np.isclose(r.t, t) and np.isclose(r.df, df)


def test_outlier_modes_and_fills(spark):
    from sparkdeck.operators.features import fill_missing, handle_outliers
    vals = [1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 100.0, -50.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")
    x = np.array([v for v in vals if v is not None])
    q1, q3 = np.quantile(x, [0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    clipped = {r.id: r.x for r in handle_outliers(df, "x", "clip").collect()}
    assert clipped[6] == hi and clipped[7] == lo and clipped[8] is None and clipped[0] == 1.0
    kept = sorted(r.id for r in handle_outliers(df, "x", "remove").collect())
    assert kept == [0, 1, 2, 3, 4, 5, 8]
    nulled = {r.id: r.x for r in handle_outliers(df, "x", "null").collect()}
    assert nulled[6] is None and nulled[7] is None and nulled[2] == 2.5
    assert fill_missing(df, "x", "zero").filter("id = 8").first().x == 0.0
    assert np.isclose(fill_missing(df, "x", "mean").filter("id = 8").first().x, x.mean())
    assert np.isclose(fill_missing(df, "x", "median").filter("id = 8").first().x, np.median(x))


def test_standardized_kmeans_centres_in_original_units(spark):
    from sparkdeck.ml import models as M
    rng = np.random.default_rng(2)
    pts = np.concatenate([rng.normal((0, 100), (1, 10), (60, 2)), rng.normal((10, 500), (1, 10), (60, 2)),
                          rng.normal((20, 900), (1, 10), (60, 2))])
    df = spark.createDataFrame(pd.DataFrame(pts, columns=["a", "b"]))
    model, centers = M.kmeans(df, ["a", "b"], k=3, seed=1, standardize=True)
    pred = model.transform(df).toPandas()
    for r in centers.collect():
        grp = pred[pred.prediction == r.prediction]
        assert np.isclose(r.a, grp.a.mean(), atol=1e-6) and np.isclose(r.b, grp.b.mean(), atol=1e-6)
