import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdeck.functions.distributions import t_two_sided_p
from sparkdeck.operators.splits import holdout_per_key, partition, sample_n, split_frame
from sparkdeck.operators.stats import crosstab_long, holm_adjust, pairwise_t_test
from sparkdeck.operators.verbs import paired

from .conftest import SF_MID


def test_t_pvalues_known():
    assert math.isclose(t_two_sided_p(2.0, 10.0), 0.07338803, rel_tol=1e-6)
    assert math.isclose(t_two_sided_p(0.0, 5.0), 1.0, rel_tol=1e-9)
    # tabulated two-sided critical values: t(0.975, 10) and t(0.995, 30)
    assert math.isclose(t_two_sided_p(2.228138852, 10.0), 0.05, rel_tol=1e-6)
    assert math.isclose(t_two_sided_p(-2.749995652, 30.0), 0.01, rel_tol=1e-6)


def test_partition_disjoint_complete_stable(spark):
    o = spark.read.parquet(f"{SF_MID}/orders.parquet").select("o_orderkey")
    p1 = partition(o, {"a": 0.75, "b": 0.25}, seed=7, key=["o_orderkey"])
    p2 = partition(o.repartition(13), {"a": 0.75, "b": 0.25}, seed=7, key=["o_orderkey"])
    a1 = {r[0] for r in p1["a"].collect()}
    b1 = {r[0] for r in p1["b"].collect()}
    assert not a1 & b1 and len(a1) + len(b1) == o.count()
    assert a1 == {r[0] for r in p2["a"].collect()}
    assert abs(len(a1) / o.count() - 0.75) < 0.03
    parts = split_frame(o, [0.5], seed=1, key=["o_orderkey"])
    assert sum(p.count() for p in parts) == o.count()


def test_sample_n_exact_and_seeded(spark):
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    s1 = sample_n(li, 37, seed=3)
    assert s1.count() == 37
    assert sorted(map(tuple, s1.select("l_orderkey", "l_linenumber").collect())) == \
        sorted(map(tuple, sample_n(li, 37, seed=3).select("l_orderkey", "l_linenumber").collect()))


def test_holdout_cap(spark):
    e = spark.read.parquet(f"{SF_MID}/events.parquet").select("event_id", "user_id")
    h = holdout_per_key(e, "user_id", ["event_id"], 1, 10, max_test=500)
    assert h.count() == e.count()
    assert h.filter(F.col("split") == "test").count() == 500
    per = holdout_per_key(e, "user_id", ["event_id"], 1, 10).filter(F.col("split") == "test") \
        .groupBy("user_id").count().agg(F.max("count")).first()[0]
    assert per == 10


def test_pairwise_holm_monotone(spark):
    c = spark.read.parquet(f"{SF_MID}/customer.parquet")
    r = pairwise_t_test(c, "c_acctbal", "c_mktsegment").toPandas().sort_values("p_value")
    assert len(r) == 10
    assert (r.p_adj.values >= r.p_value.values - 1e-12).all()
    assert (np.diff(r.p_adj.values) >= -1e-12).all() and (r.p_adj <= 1).all()


def _holm(p):
    order, out, top = sorted(range(len(p)), key=lambda i: p[i]), [0.0] * len(p), 0.0
    for nth, i in enumerate(order):
        top = max(top, min(1.0, (len(p) - nth) * p[i]))
        out[i] = top
    return out


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_holm_equal_for_any_partitioning(spark, parts):
    rng = np.random.default_rng(3)
    p = np.r_[rng.random(300) ** 4, np.repeat(0.0002, 200), 0.0, 1.0].tolist()
    rows = [(i, x) for i, x in enumerate(p)] + [(9000, None), (9001, float("nan"))]
    got = holm_adjust(spark.createDataFrame(rows, "id int, p double"), "p", "adj", num_partitions=parts)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "windowspecdefinition(_at" not in plan
    found = {r.id: r.adj for r in got.collect()}
    assert found.pop(9000) is None and found.pop(9001) is None
    assert np.allclose([found[i] for i in range(len(p))], _holm(p), rtol=1e-15, atol=0)
    assert holm_adjust(spark.createDataFrame([], "id int, p double"), "p", "adj").count() == 0


def test_pairwise_t_of_many_groups(spark):
    rng = np.random.default_rng(5)
    group = rng.integers(0, 60, 900)
    x = rng.standard_normal(900) + (group % 7 == 0) * 0.8
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(group, x)] + [(None, 1.0), (3, None)], "g int, x double")
    got = {(r.group_a, r.group_b): r for r in pairwise_t_test(df, "x", "g").collect()}
    names = sorted(set(group.tolist()))
    parts = {g: x[group == g] for g in names}
    dof = len(x) - len(names)
    sp2 = sum(((v - v.mean()) ** 2).sum() for v in parts.values()) / dof
    pairs = [(a, b) for a in names for b in names if a < b]
    assert sorted(got) == pairs
    for a, b in pairs:
        u, v = parts[a], parts[b]
        assert got[a, b].t == pytest.approx((u.mean() - v.mean()) / np.sqrt(sp2 * (1 / len(u) + 1 / len(v))), rel=1e-9)
    # Student's density summed by Simpson's rule, apart from the library's incomplete beta
    top = 60.0
    for a, b in pairs[::97]:
        t = abs(got[a, b].t)
        s = np.linspace(t, top, 200_001)
        f = (1 + s * s / dof) ** (-(dof + 1) / 2)
        area = (f[0] + f[-1] + 4 * f[1:-1:2].sum() + 2 * f[2:-1:2].sum()) * (s[1] - s[0]) / 3
        c = math.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi)
        assert got[a, b].p_value == pytest.approx(2 * c * area, rel=1e-6, abs=1e-12)
    assert np.allclose([got[k].p_adj for k in pairs], _holm([got[k].p_value for k in pairs]), rtol=1e-12)


@pytest.mark.parametrize("tile", [1, 3, 1000])
def test_paired_rows_meet_once(spark, tile):
    a, b = spark.createDataFrame([(i,) for i in range(7)] + [(None,)], "a int"), spark.createDataFrame([(c,) for c in "xyz"], "b string")
    key = lambda v: (str(v[0]), v[1])
    got = sorted(((r.a, r.b) for r in paired(a, b, tile_rows=tile).collect()), key=key)
    assert got == sorted(((x, y) for x in [*range(7), None] for y in "xyz"), key=key)
    assert paired(a, b.where("false"), tile_rows=tile).count() == 0


def test_crosstab_zero_cells(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "p string, q string")
    rows = {(r.p, r.q): r.n for r in crosstab_long(df, "p", "q").collect()}
    assert rows == {("a", "x"): 1, ("a", "y"): 1, ("b", "x"): 1, ("b", "y"): 0}


def test_approx_distinct_close_to_exact(spark):
    from sparkdeck.operators.verbs import distinct_counts
    li = spark.read.parquet(f"{SF_MID}/lineitem.parquet")
    cols = ["l_orderkey", "l_partkey", "l_suppkey"]
    exact = distinct_counts(li, cols).first()
    approx = distinct_counts(li, cols, approx=True, rsd=0.01).first()
    for c in cols:
        assert abs(approx[f"n_{c}"] - exact[f"n_{c}"]) <= 0.05 * exact[f"n_{c}"]
