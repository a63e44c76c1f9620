import numpy as np
from pyspark.sql import functions as F

from sparkdeck.ml import models as M
from sparkdeck.ml.boosting import fit_multinomial_boost
from sparkdeck.ml.network import fit_network
from sparkdeck.ml.search import combinations
from sparkdeck.plans.ml_catalog import _emb

from .conftest import SF_MID, SF_SMALL


def test_grid_combinations():
    hyper = {"learn_rate": [0.01, 0.1], "max_depth": [3, 5, 9], "sample_rate": [0.8, 1.0],
             "col_sample_rate": [0.2, 0.5, 1.0]}
    assert len(combinations(hyper)) == 36
    big = {"a": list(range(10)), "b": list(range(9)), "c": list(range(6)), "d": list(range(10))}
    r1 = combinations(big, "RandomDiscrete", 50, seed=1)
    assert len(r1) == 50 and len({tuple(x.values()) for x in r1}) == 50
    assert r1 == combinations(big, "RandomDiscrete", 50, seed=1)


def test_pca_orthonormal(spark):
    p = M.pca(_emb(spark, SF_SMALL), "features", k=5).toPandas()
    L = np.array(p.loadings.tolist())
    assert np.allclose(L @ L.T, np.eye(5), atol=1e-6)
    assert p.explained.sum() <= 1 + 1e-9 and (np.diff(p.explained) <= 1e-12).all()
    u = M.pca(_emb(spark, SF_SMALL), "features", k=3, center=False).toPandas()
    assert (np.diff(u.std_dev) <= 1e-12).all()


def test_network_learns(spark):
    from sparkdeck.plans.ml_catalog import _DOC_X, _doc_reg
    _, parts = _doc_reg(spark, SF_MID)
    model, hist = fit_network(parts["train"], "y", _DOC_X, epochs=8, input_dropout=0.2, seed=3)
    assert hist[-1] < hist[0]
    pred = model.transform(parts["valid"].select(*_DOC_X, "y"))
    mse = pred.agg(F.avg(F.pow(F.col("y") - F.col("predict"), 2))).first()[0]
    mean_y = parts["train"].agg(F.avg("y")).first()[0]
    base = parts["valid"].agg(F.avg(F.pow(F.col("y") - mean_y, 2))).first()[0]
    assert mse < 0.7 * base


def test_network_array_input(spark):
    e = _emb(spark, SF_SMALL).withColumn("y", F.col("label").cast("double"))
    model, hist = fit_network(e, "y", "emb", epochs=2, hidden=(4,), input_dropout=0.0)
    out = model.transform(e.select("emb", "y"))
    assert out.count() == e.count() and len(hist) == 2


def test_booster_labels(spark):
    # a three-class target that is a known step function of one feature
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        "o_totalprice",
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")).cast("double").alias("days"))
    o = o.withColumn("o_orderstatus", F.when(F.col("days") < 800, "F").when(F.col("days") < 1600, "O").otherwise("P"))
    m = fit_multinomial_boost(o, "o_orderstatus", ["o_totalprice", "days"], ntrees=3, max_depth=2, learn_rate=0.5)
    p = m.transform(o).toPandas()
    assert set(p.predict) <= {"F", "O", "P"}
    probs = p[[f"p_{x}" for x in m.labels]].sum(axis=1)
    assert np.allclose(probs, 1.0)
    acc = (p.predict == p.o_orderstatus).mean()
    assert acc > 0.9


def test_save_load_same_predictions(spark, tmp_path):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_extendedprice", "l_quantity")
    m = M.linear_regression(li, "l_extendedprice", ["l_quantity"], solver="normal")
    M.save_model(m, str(tmp_path / "lr"))
    back = M.load_pipeline(str(tmp_path / "lr"))
    a = [r.prediction for r in m.transform(li).collect()]
    b = [r.prediction for r in back.transform(li).collect()]
    assert a == b


def test_regression_boost_starts_at_mean_and_improves(spark):
    from sparkdeck.ml.boosting import fit_regression_boost
    p = spark.read.parquet(f"{SF_SMALL}/part.parquet").select(
        "p_retailprice", F.col("p_size").cast("double").alias("p_size"),
        (F.col("p_partkey") % 1000).cast("double").alias("p_code"))
    mean = p.agg(F.avg("p_retailprice")).first()[0]
    m0 = fit_regression_boost(p, "p_retailprice", ["p_size", "p_code"], ntrees=0)
    assert abs(m0.transform(p).agg(F.avg("predict")).first()[0] - mean) < 1e-9
    mses = []
    for n in (1, 5, 15):
        m = fit_regression_boost(p, "p_retailprice", ["p_size", "p_code"], ntrees=n, learn_rate=0.3, max_depth=4)
        mses.append(m.transform(p).agg(F.avg(F.pow(F.col("p_retailprice") - F.col("predict"), 2))).first()[0])
    assert mses[0] > mses[1] > mses[2]


def test_grid_board(spark):
    from sparkdeck.ml.search import grid_search
    p = spark.read.parquet(f"{SF_SMALL}/part.parquet").select(
        "p_retailprice", F.col("p_size").cast("double").alias("p_size"),
        (F.col("p_partkey") % 1000).cast("double").alias("p_code"))
    board, models = grid_search(p, p, "p_retailprice", ["p_size", "p_code"],
                                {"learn_rate": [0.1, 0.3], "max_depth": [3]}, ntrees=3, parallelism=2)
    rows = board.collect()
    assert len(rows) == 2 and rows[0].mse <= rows[1].mse and set(models) == {r.model_id for r in rows}


def test_pca_matches_numpy(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_quantity", "l_extendedprice", "l_discount",
                                                                    "l_tax")
    X = li.toPandas().to_numpy(dtype=float)
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    # centred: variance shares are the covariance eigenvalues over their sum
    ev = np.sort(np.linalg.eigvalsh(np.cov(X, rowvar=False)))[::-1]
    got = M.pca(li, cols, k=4, center=True).orderBy("component").toPandas()
    assert np.allclose(got.explained.values, ev / ev.sum(), rtol=1e-6, atol=1e-12)
    # uncentred: standard deviations are the singular values of X over sqrt(n)
    s = np.linalg.svd(X, compute_uv=False)
    unc = M.pca(li, cols, k=4, center=False).orderBy("component").toPandas()
    assert np.allclose(unc.std_dev.values, s / np.sqrt(len(X)), rtol=1e-6)
    v = np.linalg.svd(X, full_matrices=False)[2][0]
    assert np.isclose(abs(np.dot(v, np.array(unc.loadings[0]))), 1.0, atol=1e-6)


def test_glm_path_starts_at_all_zero_model(spark):
    from sparkdeck.plans.ml_catalog import _DOC_X, _doc_reg
    _, parts = _doc_reg(spark, SF_MID)
    path = M.glm_path(parts["train"], "y", _DOC_X, alpha=0.5, n_lambda=6, valid=parts["valid"]).toPandas()
    assert path.n_nonzero.iloc[0] == 0                       # largest penalty: intercept only
    assert path.n_nonzero.iloc[-1] == len(_DOC_X)            # smallest: every feature in
    assert path.valid_mse.iloc[-1] < path.valid_mse.iloc[0]


def test_penalised_regression_with_constant_feature_and_nulls(spark):
    rows = [(float(i), float(i % 7), 4.0, 3.0 * i - 2.0 * (i % 7)) for i in range(80)] + [(None, 1.0, 4.0, 5.0), (1.0, 2.0, 4.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    path = M.glm_path(df, "y", ["a", "b", "c"], n_lambda=5).toPandas()
    assert path.n_nonzero.iloc[0] == 0 and path.n_nonzero.iloc[-1] == 2
    model, penalty = M.penalised_regression(df, "y", ["a", "b", "c"], n_lambda=5)
    assert penalty == path["lambda"].min()
    found = model.transform(df.dropna()).select("prediction", "y").toPandas()
    assert len(found) == 80 and (found.prediction - found.y).abs().max() < 1.0


def test_predicted_actual_keeps_rows_with_null_text(spark, tmp_path):
    from sparkdeck.plans import ml_catalog as C
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    gone = F.col("doc_id") % 10 == 0
    docs.withColumn("text", F.when(~gone, F.col("text"))).write.parquet(f"{tmp_path}/documents.parquet")
    d, parts = C._doc_reg(spark, str(tmp_path))
    want = {r.doc_id: r.y for r in parts["valid"].select("doc_id", "y").collect()}
    d.unpersist()
    got = C.predicted_actual(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.actual for r in got} == want and len(got) == len(want)
    assert {r.doc_id for r in got if r.predicted is None} == {i for i in want if i % 10 == 0} != set()


def test_residual_quantiles(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + e) for x, e in [(0, 1), (0, -1), (5, 3), (5, -3), (9, 0)]], "x double, y double")
    m = M.linear_regression(df, "y", ["x"], solver="normal")
    assert [round(v, 6) for v in M.residual_quantiles(m, df, "y").select("min", "q25", "median", "q75", "max").first()] == [-3, -1, 0, 1, 3]


def test_variable_importance_scaling(spark):
    from sparkdeck.plans.ml_catalog import _LANG_X, _doc_lang
    d, parts = _doc_lang(spark, SF_SMALL)
    try:
        m = M.random_forest(parts["train"], "lang", _LANG_X, num_trees=5, seed=1)
        vi = M.variable_importance(m, _LANG_X).toPandas()
    finally:
        d.unpersist()
    assert np.isclose(vi.scaled_importance.max(), 1.0) and np.isclose(vi.percentage.sum(), 1.0)
    assert list(vi.relative_importance) == sorted(vi.relative_importance, reverse=True)


def test_grid_stop_rules(spark):
    from sparkdeck.ml.search import grid_search
    p = spark.read.parquet(f"{SF_SMALL}/part.parquet").select(
        "p_retailprice", F.col("p_size").cast("double").alias("p_size"))
    hyper = {"learn_rate": [0.1, 0.2, 0.3], "max_depth": [2, 3]}
    board, _ = grid_search(p, p, "p_retailprice", ["p_size"], hyper, ntrees=2, max_runtime_secs=0)
    assert board.count() == 0                                   # run-time budget spent before the first fit
    board, _ = grid_search(p, p, "p_retailprice", ["p_size"], hyper, ntrees=2, max_models=4,
                           strategy="RandomDiscrete", parallelism=2)
    assert board.count() == 4                                   # model-count budget


def test_registered_boosters_fit_the_reference_tree_count(spark, monkeypatch):
    from sparkdeck.plans import ml_catalog as C
    asked = []

    class Asked(Exception):
        pass

    def fit(*args, ntrees, **rest):
        asked.append(ntrees)
        raise Asked
    monkeypatch.setattr(C, "grid_search", fit)
    monkeypatch.setattr(C, "fit_regression_boost", fit)
    monkeypatch.setattr(M, "gbt_regressor", fit)
    for run in (C.grid_full, C.grid_random, C.gbt_regression, C.gbm_regression_parity):
        try:
            run(spark, SF_SMALL)
        except Asked:
            pass
    assert asked == [100] * 4
