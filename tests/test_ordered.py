"""Skew-safe positions, ranks and quantiles against pandas / numpy on hand-made frames."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sparkdeck.operators.ordered import exact_quantiles, rank_within, segmented_positions, with_row_index


def _frame(spark, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    # one hot group holding half the rows, many ties, some NULL values
    g = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 40, n))
    v = rng.integers(0, 20, n).astype(float)
    v[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": v})
    return pdf, spark.createDataFrame(pdf).withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")))


def test_rank_matches_sql_rank_with_hot_group(spark):
    pdf, df = _frame(spark)
    out = rank_within(df, ["g"], [("v", False)], name="rk", num_partitions=16).toPandas()
    exp = pdf.assign(vv=pdf.v.fillna(-np.inf)).groupby("g").vv.rank(method="min", ascending=False)
    m = out.set_index("id").rk.sort_index()
    assert (m.values == exp.sort_index().values.astype(int)).all()


def test_row_number_is_a_permutation_per_group(spark):
    pdf, df = _frame(spark, seed=1)
    out = segmented_positions(df, ["g"], ["v"], row_number="rn", num_partitions=12).toPandas()
    for _, grp in out.groupby("g"):
        assert sorted(grp.rn) == list(range(1, len(grp) + 1))
        # order respected: v non-decreasing in rn (NULLs first)
        s = grp.sort_values("rn").v.fillna(-1).values
        assert (np.diff(s) >= 0).all()


def test_global_index_dense(spark):
    _, df = _frame(spark, seed=2)
    out = with_row_index(df, ["id"], num_partitions=7).toPandas().sort_values("id")
    assert (out.row_idx.values == np.arange(len(out))).all()


def test_plan_reuses_one_range_exchange(spark):
    _, df = _frame(spark, seed=3)
    out = rank_within(df, ["g"], ["v"], num_partitions=8)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan.lower()
    assert "ReusedExchange" in plan or "reused" in plan.lower()


def test_exact_quantiles_match_numpy(spark):
    pdf, df = _frame(spark, seed=4)
    q = exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.75], ["a", "b", "c"], num_partitions=9).toPandas()
    for _, r in q.iterrows():
        vals = pdf[pdf.g == r.g].v.dropna().values
        exp = np.quantile(vals, [0.25, 0.5, 0.75])
        assert np.allclose([r.a, r.b, r.c], exp)


def test_single_value_group_split_across_partitions(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), F.lit(7.0).alias("v"), "id")
    out = rank_within(df, ["g"], ["v"], name="rk", num_partitions=10).agg(F.min("rk"), F.max("rk")).first()
    assert tuple(out) == (1, 1)
    rn = segmented_positions(df, ["g"], ["v"], row_number="rn", num_partitions=10)
    assert rn.agg(F.countDistinct("rn"), F.max("rn")).first() == (5000, 5000)


def test_prefix_sums_carry_across_partitions(spark):
    pdf, df = _frame(spark, seed=5)
    df = df.withColumn("w", F.when(F.col("v").isNull(), 0).otherwise(1))
    out = segmented_positions(df, ["g"], ["id"], row_number="rn", prefix_sums={"cw": "w"},
                              num_partitions=11).toPandas().sort_values(["g", "id"])
    exp = out.groupby("g").w.cumsum()
    assert (out.cw.values == exp.values).all()


def test_interpolation_scan_equals_window(spark):
    from sparkdeck.operators.features import interpolate_linear
    rng = np.random.default_rng(6)
    n = 4000
    pdf = pd.DataFrame({"id": np.arange(n), "g": np.where(rng.random(n) < 0.6, 0, rng.integers(1, 9, n)),
                        "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 10**6, n), unit="s"),
                        "v": rng.normal(size=n)})
    pdf.loc[rng.random(n) < 0.3, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")))
    a = interpolate_linear(df, ["g"], "ts", "v", "vi", tiebreak="id", strategy="window").toPandas()
    b = interpolate_linear(df, ["g"], "ts", "v", "vi", tiebreak="id", strategy="scan").toPandas()
    m = a.merge(b, on="id")
    assert len(m) == n
    assert np.allclose(m.vi_x.fillna(1e9), m.vi_y.fillna(1e9), rtol=1e-12, atol=1e-12)


def test_scan_is_deterministic(spark):
    pdf, df = _frame(spark, seed=7)
    a = rank_within(df, ["g"], ["v"], name="rk", num_partitions=9).select("id", "rk").collect()
    b = rank_within(df, ["g"], ["v"], name="rk", num_partitions=9).select("id", "rk").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_scan_survives_task_retries():
    import json
    import os
    import subprocess
    import sys
    script = os.path.join(os.path.dirname(__file__), "scripts", "retry_scan.py")
    env = dict(os.environ, PYSPARK_PYTHON=sys.executable)
    runs = {}
    for mode in ("clean", "inject"):
        res = subprocess.run([sys.executable, script, mode], capture_output=True, text=True, timeout=300, env=env)
        assert res.returncode == 0, res.stderr[-2000:]
        runs[mode] = json.loads(res.stdout.strip().splitlines()[-1])
    assert runs["clean"] == runs["inject"] and len(runs["clean"]) == 20000


def test_nan_and_null_values_rank_like_spark_window(spark):
    rows = [(i, i % 3, v) for i, v in enumerate([1.0, float("nan"), None, 2.0, float("nan"), 1.0, None, 3.0,
                                                  float("nan"), 2.0] * 30)]
    df = spark.createDataFrame(rows, "id long, g long, v double")
    a = rank_within(df, ["g"], [("v", False)], name="rk", strategy="window").select("id", "rk").collect()
    b = rank_within(df, ["g"], [("v", False)], name="rk", strategy="scan", num_partitions=7).select("id", "rk").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_quantile_edges_and_empty_input(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 1.0), (1, 3.0), (2, 7.0)], "g long, v double")
    for strategy in ("window", "scan"):
        kw = {"num_partitions": 3} if strategy == "scan" else {}
        q = {r.g: r for r in exact_quantiles(df, ["g"], "v", [0.0, 0.5, 1.0], ["lo", "mid", "hi"],
                                             strategy=strategy, **kw).collect()}
        assert (q[1].lo, q[1].mid, q[1].hi) == (1.0, 3.0, 5.0)
        assert (q[2].lo, q[2].mid, q[2].hi) == (7.0, 7.0, 7.0)       # single-row group
        empty = df.filter("g > 10")
        assert rank_within(empty, ["g"], ["v"], strategy=strategy, **kw).count() == 0


def test_helper_column_collision_is_refused(spark):
    import pytest
    df = spark.createDataFrame([(1, 2.0)], "_pid long, v double")
    with pytest.raises(ValueError):
        segmented_positions(df, [], ["v"], strategy="scan", num_partitions=2)


def test_tied_times_fill_alike_for_any_partitioning(spark):
    from sparkdeck.operators.features import interpolate_linear
    rows = [(i, "a" if i % 3 else None, f"2024-01-01 00:00:{i // 6:02d}", float(i) if i % 5 == 0 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, g string, ts string, v double").withColumn("ts", F.col("ts").cast("timestamp"))
    runs = []
    for n, parts, strategy in ((1, 1, "range"), (4, 4, "range"), (7, 64, "range"), (2, 8, "window")):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        runs.append({r.id: r.f for r in interpolate_linear(df.repartition(n), ["g"], "ts", "v", "f", strategy=strategy).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(runs[0]) == 60 and all(r == runs[0] for r in runs[1:])


def test_a_long_gap_is_spread_over_tasks(spark):
    from sparkdeck.operators.features import interpolate_linear
    n = 40_000
    df = spark.range(n).select("id", F.timestamp_seconds("id").alias("ts"), F.when(F.col("id").isin(10, n - 11), F.col("id") * 2.0).alias("v"))
    out = interpolate_linear(df, [], "ts", "v", "f").withColumn("p", F.spark_partition_id()).cache()
    assert out.where(F.abs(F.col("f") - F.least(F.greatest(F.col("id"), F.lit(10)), F.lit(n - 11)) * 2.0) > 1e-6).count() == 0
    sizes = [r["count"] for r in out.groupBy("p").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * n


def test_row_index_for_any_partition_count(spark):
    _, df = _frame(spark, seed=8)
    runs = [sorted(map(tuple, with_row_index(df.repartition(n), ["v"], num_partitions=n).select("id", "row_idx").collect())) for n in (1, 4, 64)]
    assert runs[0] == runs[1] == runs[2] and sorted(i for _, i in runs[0]) == list(range(3000))


def test_pieces_of_many_partitions(spark):
    # more partitions than a block of the two-level sum holds
    df = spark.range(3000)
    got = with_row_index(df, [("id", False)], num_partitions=1100).where(F.col("row_idx") != 2999 - F.col("id")).count()
    assert got == 0


def test_top_within_keeps_ties_and_splits_a_hot_group(spark):
    from sparkdeck.operators.ordered import top_within
    pdf, df = _frame(spark, seed=9)
    for k in (1, 2, 50, 5000):
        want = rank_within(df, ["g"], [("v", False)], strategy="window").where(F.col("rank") <= k)
        got = top_within(df, ["g"], [("v", False)], k)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select(got.columns).collect()), key=repr)
    plan = top_within(df, ["g"], [("v", False)], 2)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "partial_count" in text


def test_quantiles_with_odd_values_and_a_hot_group(spark):
    rng = np.random.default_rng(11)
    vals = {None: [1e300, -1e300, 0.0, 1e-300], "one": [5.0], "inf": [float("inf"), 1.0, 2.0, float("-inf"), 3.0], "tie": [2.0] * 500,
            "hot": rng.lognormal(3, 4, 4000).tolist(), "big": (rng.integers(0, 2**40, 301) * 1.0).tolist()}
    df = spark.createDataFrame([(k, v) for k, vs in vals.items() for v in vs] + [("none", None), ("hot", None)], "k string, v double").repartition(5)
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", [0.0, 0.1, 0.5, 0.999, 1.0], list("abcde")).collect()}
    assert set(got) == set(vals)
    for k, vs in vals.items():
        vs = sorted(vs)
        for p, name in zip([0.0, 0.1, 0.5, 0.999, 1.0], "abcde"):
            h = (len(vs) - 1) * p
            lo, hi = vs[int(np.floor(h))], vs[int(np.ceil(h))]
            want = lo if lo == hi else lo + (h - np.floor(h)) * (hi - lo)
            assert got[k][name] == want or np.isclose(got[k][name], want, rtol=1e-12, equal_nan=True), (k, p)
    nan = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double")
    row = exact_quantiles(nan, [], "v", [0.0, 0.5, 1.0], list("abc")).first()
    assert (row.a, row.b) == (1.0, 3.0) and np.isnan(row.c)


def test_no_whole_table_window(spark):
    from sparkdeck.plans import queries

    from .conftest import SF_SMALL
    import re
    for name in ("block_kfold", "daily_rank", "holdout_capped", "interpolate", "part_price_vs_global"):
        df = queries()[name](spark, SF_SMALL)
        text = df._jdf.queryExecution().optimizedPlan().toString()
        for line in text.splitlines():
            if re.search(r"\bWindow \[", line):
                assert "[_pid" in line or re.search(r"\], \[\w+#\d+", line), (name, line)


def test_scan_partitions_of_a_join_grow_with_the_sum_of_its_sides(spark):
    import re

    from sparkdeck.operators.ordered import scan_partitions, shuffle_partitions
    from sparkdeck.operators.splits import holdout_per_key
    rows = spark.range(1_000_000)
    assert scan_partitions(rows.join(rows.withColumnRenamed("id", "other"), F.col("id") == F.col("other"))) == shuffle_partitions(spark)
    assert scan_partitions(spark.range(1 << 30)) == 32                  # 8 GB
    small = spark.range(20_000).select(F.col("id").alias("event"), (F.col("id") % 100).alias("user"))
    capped = holdout_per_key(small, "user", ["event"], 1, 10, max_test=500)
    # the second numbering reads joined rows
    counts = [int(x) for x in re.findall(r"RepartitionByExpression \[.*\], (\d+)", capped._jdf.queryExecution().optimizedPlan().toString())]
    assert counts and set(counts) == {shuffle_partitions(spark)}
    assert capped.where("split = 'test'").agg(F.count("*"), F.max("event")).first() == (500, 499)
