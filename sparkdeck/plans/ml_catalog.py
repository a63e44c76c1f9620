"""Catalogue entries for sampling, I/O round trips, evaluation and model fitting.

Evaluation steps are checked against DuckDB over a *fixed* prediction column (a
formula), so the oracle needs no model; fitted models are property-checked.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ml import models as M
from ..ml.boosting import fit_multinomial_boost, fit_regression_boost
from pyspark.ml.functions import array_to_vector

from ..ml.evaluate import (class_error, cluster_stats, cluster_stats_array, confusion_long, metrics_by_tag,
                           regression_metrics)
from ..ml.network import fit_network
from ..ml.search import best_model, grid_search
from pyspark.ml.classification import LogisticRegression

from ..operators.features import formula_features
from ..operators.splits import partition, sample_frac, sample_n, tag_partitions
from ..session import delete_path, ensure_checkpoint_dir
from ..sources.files import count_lines, read_csv, read_delimited, write_csv, write_parquet
from ..sources.tables import head
from .catalog import _t, query, r2, r4, rnd


def _small_result(spark, df: DataFrame) -> DataFrame:
    """Materialise a result whose size is bounded by the model (classes², path length,
    one metrics row), so cached training inputs can be released before returning."""
    return spark.createDataFrame(df.collect(), df.schema)


def _scratch(spark, what: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local on a cluster)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sparkdeck-{what}-{uuid.uuid4().hex}"


def _fixed_pred(spark, sf) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return li.select("l_linestatus", (F.col("l_extendedprice") / 1000.0).alias("y"),
                     (F.col("l_quantity") * 2.0).alias("pred"))


_FIXED = "(SELECT l_linestatus, l_extendedprice / 1000.0 AS y, l_quantity * 2.0 AS pred FROM lineitem)"


# ---------------------------------------------------------------- evaluation over fixed predictions

@query("kmeans_sizes", """
WITH p AS (SELECT l_returnflag AS prediction, l_quantity AS x1, l_discount * 100 AS x2 FROM lineitem),
c AS (SELECT prediction, avg(x1) AS c1, avg(x2) AS c2 FROM p GROUP BY 1)
SELECT p.prediction, count(*) AS size, (round((sum(pow(x1 - c1, 2) + pow(x2 - c2, 2))) * 1e2) / 1e2) AS within_ss
FROM p JOIN c ON p.prediction = c.prediction GROUP BY p.prediction
""")
def kmeans_sizes(spark, sf):
    """L-04: per-cluster size and within-cluster sum of squares for a given assignment."""
    li = _t(spark, sf, "lineitem").select(F.col("l_returnflag").alias("prediction"), F.col("l_quantity").alias("x1"),
                                          (F.col("l_discount") * 100).alias("x2"))
    s = cluster_stats(li, ["x1", "x2"], "prediction")
    return s.select("prediction", "size", r2("within_ss").alias("within_ss"))


_PRED_CLASS = "CASE WHEN l_quantity < 25 THEN 'A' WHEN l_quantity < 40 THEN 'N' ELSE 'R' END"


def _class_pred(spark, sf):
    li = _t(spark, sf, "lineitem")
    pred = F.when(F.col("l_quantity") < 25, "A").when(F.col("l_quantity") < 40, "N").otherwise("R")
    return li.select(F.col("l_returnflag").alias("actual"), pred.alias("predicted"))


@query("confusion", f"""
WITH p AS (SELECT l_returnflag AS actual, {_PRED_CLASS} AS predicted FROM lineitem),
a AS (SELECT DISTINCT actual FROM p), b AS (SELECT DISTINCT predicted FROM p),
c AS (SELECT actual, predicted, count(*) AS n FROM p GROUP BY 1, 2)
SELECT a.actual, b.predicted, coalesce(c.n, 0) AS n FROM a CROSS JOIN b
LEFT JOIN c ON c.actual = a.actual AND c.predicted = b.predicted
""")
def confusion(spark, sf):
    """L-13: confusion matrix, long form with zero cells."""
    return confusion_long(_class_pred(spark, sf), "actual", "predicted")


@query("class_error", f"""
WITH p AS (SELECT l_returnflag AS actual, {_PRED_CLASS} AS predicted FROM lineitem)
SELECT actual AS class, count(*) AS n, CAST(sum(CAST(actual <> predicted AS BIGINT)) AS BIGINT) AS n_wrong,
       (round((sum(CAST(actual <> predicted AS BIGINT)) / count(*)) * 1e4) / 1e4) AS error FROM p GROUP BY 1
UNION ALL
SELECT 'Total', count(*), CAST(sum(CAST(actual <> predicted AS BIGINT)) AS BIGINT),
       (round((sum(CAST(actual <> predicted AS BIGINT)) / count(*)) * 1e4) / 1e4) FROM p
""")
def class_error_q(spark, sf):
    """L-13: per-class and total error under the confusion matrix."""
    e = class_error(_class_pred(spark, sf), "actual", "predicted")
    return e.select("class", "n", "n_wrong", r4("error").alias("error"))


@query("regression_metrics", f"""
SELECT count(*) AS n, (round((avg(pow(y - pred, 2))) * 1e4) / 1e4) AS mse, (round((sqrt(avg(pow(y - pred, 2)))) * 1e4) / 1e4) AS rmse,
       (round((avg(abs(y - pred))) * 1e4) / 1e4) AS mae, (round((1 - avg(pow(y - pred, 2)) / var_pop(y)) * 1e4) / 1e4) AS r2
FROM {_FIXED} t
""")
def regression_metrics_q(spark, sf):
    """L-18: MSE, RMSE, MAE, R² of a prediction column."""
    m = regression_metrics(_fixed_pred(spark, sf), "y", "pred")
    return m.select("n", *[r4(c).alias(c) for c in ("mse", "rmse", "mae", "r2")])


@query("split_mse", f"""
SELECT CASE WHEN l_linestatus = 'F' THEN 'training' ELSE 'test' END AS split, count(*) AS n,
       (round((avg(pow(y - pred, 2))) * 1e4) / 1e4) AS mse
FROM {_FIXED} t WHERE l_linestatus IN ('F', 'O') GROUP BY 1
""")
def split_mse(spark, sf):
    """L-22: one metric per named part in a single job."""
    d = _fixed_pred(spark, sf)
    d = d.withColumn("part", F.when(F.col("l_linestatus") == "F", "training").when(F.col("l_linestatus") == "O", "test"))
    m = metrics_by_tag(d, "part", "y", "pred")
    return m.select("split", "n", r4("mse").alias("mse"))


@query("ols_line", """
SELECT (round((regr_slope(l_extendedprice, l_quantity)) * 1e4) / 1e4) AS slope,
       (round((regr_intercept(l_extendedprice, l_quantity)) * 1e2) / 1e2) AS intercept,
       (round((regr_r2(l_extendedprice, l_quantity)) * 1e6) / 1e6) AS r2
FROM lineitem
""")
def ols_line(spark, sf):
    """L-05..L-07: least squares by the normal equations; slope, intercept, R²."""
    li = _t(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    m = M.linear_regression(li, "l_extendedprice", ["l_quantity"], solver="normal")
    lr = m.stages[-1]
    return spark.createDataFrame([(float(lr.coefficients[0]), float(lr.intercept), float(lr.summary.r2))],
                                 "slope double, intercept double, r2 double") \
        .select(r4("slope").alias("slope"), r2("intercept").alias("intercept"), rnd("r2", 6).alias("r2"))


@query("residual_quantiles", """
WITH fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
r AS (SELECT l_extendedprice - (a + b * l_quantity) AS residual FROM lineitem, fit)
SELECT (round((min(residual)) * 1e2) / 1e2) AS "min", (round((quantile_cont(residual, 0.25)) * 1e2) / 1e2) AS q25,
       (round((quantile_cont(residual, 0.5)) * 1e2) / 1e2) AS median, (round((quantile_cont(residual, 0.75)) * 1e2) / 1e2) AS q75,
       (round((max(residual)) * 1e2) / 1e2) AS "max"
FROM r
""")
def residual_quantiles(spark, sf):
    """L-06: the five residual quantiles of a least-squares line."""
    li = _t(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    m = M.linear_regression(li, "l_extendedprice", ["l_quantity"], solver="normal")
    found = M.residual_quantiles(m, li, "l_extendedprice")
    return found.select(*[r2(c).alias(c) for c in ("min", "q25", "median", "q75", "max")])


# ---------------------------------------------------------------- sampling and splits (property checks)

@query("head_rows", None)
def head_rows(spark, sf):
    """S-13: the first six rows of a table (R's ``head``; a limit, not a sample)."""
    return head(_t(spark, sf, "orders"))


@query("sample_n", None)
def sample_n_q(spark, sf):
    """X-01: exactly 100 random orders (seeded)."""
    return sample_n(_t(spark, sf, "orders"), 100, seed=42)


@query("sample_frac", None)
def sample_frac_q(spark, sf):
    """X-02: about 1 % of lineitem (seeded Bernoulli)."""
    return sample_frac(_t(spark, sf, "lineitem"), 0.01, seed=42)


@query("partition_sizes", None)
def partition_sizes(spark, sf):
    """X-03, X-04: 75 / 25 split by a hash of the key — disjoint, complete, near weight."""
    t = tag_partitions(_t(spark, sf, "orders"), {"training": 0.75, "test": 0.25}, seed=1099, key=["o_orderkey"])
    return t.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- I/O round trips

@query("parquet_roundtrip", "SELECT o_orderstatus, count(*) AS n, (round((sum(o_totalprice)) * 1e2) / 1e2) AS total FROM orders GROUP BY 1")
def parquet_roundtrip(spark, sf):
    """S-05, S-06: write parquet (partitioned by status), read it back, aggregate."""
    path = _scratch(spark, "parquet")
    try:
        write_parquet(_t(spark, sf, "orders"), path, partition_by=["o_orderstatus"])
        back = spark.read.parquet(path)
        return _small_result(spark, back.groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("n"), r2(F.sum("o_totalprice")).alias("total")))
    finally:
        delete_path(spark, path)


@query("csv_roundtrip", None)
def csv_roundtrip(spark, sf):
    """S-02..S-04, S-07: write CSV with a header, count raw lines, read back both ways."""
    from pyspark.sql import types as T
    path = _scratch(spark, "csv")
    try:
        o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
        write_csv(o, path)
        lines = count_lines(spark, path)
        inferred = read_csv(spark, path)
        schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                               T.StructField("o_orderstatus", T.StringType()),
                               T.StructField("o_totalprice", T.DoubleType())])
        typed = read_delimited(spark, path, schema, sep=",", header=True, quote='"')
        return spark.createDataFrame([("raw_lines", lines), ("rows_inferred", inferred.count()),
                                      ("rows_typed", typed.count())], "check string, value long")
    finally:
        delete_path(spark, path)


# ---------------------------------------------------------------- models (property checks)

def _emb(spark, sf) -> DataFrame:
    """Embeddings as one double array and one ML vector (no per-dimension columns)."""
    e = _t(spark, sf, "embeddings")
    arr = F.transform("embedding", lambda x: x.cast("double"))
    return e.select("vec_id", "label", arr.alias("emb"), array_to_vector(arr).alias("features"))


@query("kmeans_fit", None)
def kmeans_fit(spark, sf):
    """L-01, L-03, L-21: k-means with k = 10 on the embeddings; sizes and within SS per cluster."""
    e = _emb(spark, sf)
    model, centers = M.kmeans(e, "features", k=10, seed=1)
    return cluster_stats_array(model.transform(e), "emb", centers)


@query("kmeans_standardized", None)
def kmeans_standardized(spark, sf):
    """L-02, L-03, G-07: standardised k-means (k = 3) on two columns; centres in original units."""
    p = _t(spark, sf, "part").select("p_size", F.col("p_retailprice").cast("double"))
    _, centers = M.kmeans(p, ["p_size", "p_retailprice"], k=3, seed=1, standardize=True)
    return centers.withColumn("label", F.col("prediction") + 1)


@query("pca_centered", None)
def pca_centered(spark, sf):
    """L-09: principal components of the 64 embedding dimensions and their variance shares."""
    return M.pca(_emb(spark, sf), "features", k=10, center=True)


@query("pca_uncentered", None)
def pca_uncentered(spark, sf):
    """L-10: k = 4 over four numeric columns without centring."""
    li = _t(spark, sf, "lineitem")
    return M.pca(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], k=4, center=False)


@query("logistic_fit", None)
def logistic_fit(spark, sf):
    """L-08, F-04, F-05: binary response (toxic) on log length and quality."""
    d = _t(spark, sf, "labels").join(_t(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    d = d.withColumn("log_chars", F.log1p("n_chars")).withColumn("y", F.col("toxic").cast("double"))
    f = formula_features(d, "y ~ log_chars + quality")       # F-04: formula to features and label
    lr = LogisticRegression(featuresCol="features", labelCol="label").fit(f)
    rows = [("(Intercept)", float(lr.intercept))] + [(n, float(c)) for n, c in
                                                     zip(["log_chars", "quality"], lr.coefficients.toArray())]
    return spark.createDataFrame(rows, "term string, estimate double")


@query("regression_summary", None)
def regression_summary(spark, sf):
    """L-06, L-20: coefficient table with standard errors, t and p, plus R² and RMSE."""
    li = _t(spark, sf, "lineitem").select("l_extendedprice", "l_quantity", "l_discount")
    m = M.linear_regression(li, "l_extendedprice", ["l_quantity", "l_discount"], solver="normal")
    return M.regression_summary(m, ["l_quantity", "l_discount"])


_OLS2_SQL = """
WITH d AS (SELECT l_extendedprice / 1000.0 AS y, CAST(l_quantity AS DOUBLE) AS x1, l_discount * 100.0 AS x2
           FROM lineitem),
s AS (SELECT count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my,
             var_pop(x1) * count(*) AS s11, var_pop(x2) * count(*) AS s22, covar_pop(x1, x2) * count(*) AS s12,
             covar_pop(x1, y) * count(*) AS s1y, covar_pop(x2, y) * count(*) AS s2y,
             var_pop(y) * count(*) AS syy FROM d),
b AS (SELECT *, s11 * s22 - s12 * s12 AS det FROM s),
c AS (SELECT *, (s22 * s1y - s12 * s2y) / det AS b1, (s11 * s2y - s12 * s1y) / det AS b2 FROM b),
e AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS sig2 FROM c),
f AS (SELECT *, sqrt(sig2 * s22 / det) AS se1, sqrt(sig2 * s11 / det) AS se2,
             sqrt(sig2 * (1.0 / n + (m1 * m1 * s22 + m2 * m2 * s11 - 2 * m1 * m2 * s12) / det)) AS se0 FROM e)
SELECT 'x1' AS term, (round((b1) * 1e6) / 1e6) AS estimate, (round((se1) * 1e6) / 1e6) AS std_error, (round((b1 / se1) * 1e4) / 1e4) AS t_value FROM f
UNION ALL SELECT 'x2', (round((b2) * 1e6) / 1e6), (round((se2) * 1e6) / 1e6), (round((b2 / se2) * 1e4) / 1e4) FROM f
UNION ALL SELECT '(Intercept)', (round((b0) * 1e6) / 1e6), (round((se0) * 1e6) / 1e6), (round((b0 / se0) * 1e4) / 1e4) FROM f
"""


@query("ols_two_features", _OLS2_SQL)
def ols_two_features(spark, sf):
    """L-06, L-20: least-squares summary (estimate, standard error, t) for two regressors,
    checked against the closed form in centred cross-products."""
    li = _t(spark, sf, "lineitem").select((F.col("l_extendedprice") / 1000.0).alias("y"),
                                          F.col("l_quantity").cast("double").alias("x1"),
                                          (F.col("l_discount") * 100.0).alias("x2"))
    m = M.linear_regression(li, "y", ["x1", "x2"], solver="normal")
    summ = M.regression_summary(m, ["x1", "x2"])
    return summ.select("term", rnd("estimate", 6).alias("estimate"), rnd("std_error", 6).alias("std_error"),
                       r4("t_value").alias("t_value"))


@query("robust_regression", None)
def robust_regression(spark, sf):
    """F-10: Huber-loss regression of price on quantity."""
    li = _t(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    m = M.linear_regression(li, "l_extendedprice", ["l_quantity"], loss="huber")
    return M.coefficients(m, ["l_quantity"])


# Letters whose share of a text is used as a language feature.
LETTERS = ["a", "e", "i", "o", "u", "h", "n", "s", "t", "w", "z", "c"]
_LANG_X = [f"share_{c}" for c in LETTERS]


def _doc_lang(spark, sf):
    """Language-classification data derived from whole texts: the share of each letter
    in ``LETTERS`` (lower-cased), built-in string functions only; 75 / 25 hash split."""
    d = _t(spark, sf, "documents").select("doc_id", "lang", F.lower("text").alias("t"))
    n = F.greatest(F.length("t"), F.lit(1))
    feats = [((F.length("t") - F.length(F.replace("t", F.lit(c), F.lit("")))) / n).alias(f"share_{c}")
             for c in LETTERS]
    # the derived table is small (a dozen doubles per document) and every tree level,
    # split search and indexer re-reads it: cache it for the fit, release after
    d = d.select("doc_id", "lang", *feats).persist(StorageLevel.MEMORY_AND_DISK)
    return d, partition(d, {"train": 0.75, "valid": 0.25}, seed=1, key=["doc_id"])


@query("rf_validation", None)
def rf_validation(spark, sf):
    """L-12, L-13: 400-tree forest, depth 5, 32 bins, seed 1 (language from letter shares);
    confusion on the validation part."""
    d, parts = _doc_lang(spark, sf)
    try:
        m = M.random_forest(parts["train"], "lang", _LANG_X, num_trees=400, max_depth=5, max_bins=32, seed=1)
        labels = m.stages[0].labels
        p = m.transform(parts["valid"]).withColumn(
            "predicted", F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int") + 1))
        return _small_result(spark, confusion_long(p.select(F.col("lang").alias("actual"), "predicted"),
                                                   "actual", "predicted"))
    finally:
        d.unpersist()


@query("rf_importance", None)
def rf_importance(spark, sf):
    """L-11, L-14: 10-tree forest (language from letter shares) and its scaled variable importance."""
    d, parts = _doc_lang(spark, sf)
    try:
        m = M.random_forest(parts["train"], "lang", _LANG_X, num_trees=10, seed=1)
        return M.variable_importance(m, _LANG_X)
    finally:
        d.unpersist()


@query("gbm_multiclass", None)
def gbm_multiclass(spark, sf):
    """L-15: multi-class boosting (four languages from letter shares), 20 rounds, depth 3,
    rate 0.01, column sample 0.7, seed 1; confusion on the validation part."""
    d, parts = _doc_lang(spark, sf)
    try:
        m = fit_multinomial_boost(parts["train"], "lang", _LANG_X, ntrees=20, max_depth=3, learn_rate=0.01,
                                  col_sample_rate=0.7, seed=1)
        p = m.transform(parts["valid"])
        return _small_result(spark, confusion_long(
            p.select(F.col("lang").alias("actual"), F.col("predict").alias("predicted")), "actual", "predicted"))
    finally:
        d.unpersist()


_DOC_X = ["log_words", "log_lines", "log_digits", "log_upper"]


def _doc_reg(spark, sf):
    """Regression data derived from whole document texts: log length on log counts of
    words, lines, digits and capitals (built-in string functions, JVM side); split
    75 / 25 by a hash of ``doc_id``."""
    d = _t(spark, sf, "documents").select(
        "doc_id", F.log1p("n_chars").alias("y"),
        F.log1p(F.size(F.split("text", r"\s+"))).alias("log_words"),
        F.log1p(F.size(F.split("text", "\n"))).alias("log_lines"),
        F.log1p(F.length(F.regexp_replace("text", "[^0-9]", ""))).alias("log_digits"),
        F.log1p(F.length(F.regexp_replace("text", "[^A-Z]", ""))).alias("log_upper"))
    d = d.persist(StorageLevel.MEMORY_AND_DISK)      # re-read by every boosting round / epoch / path point
    return d, partition(d, {"train": 0.75, "valid": 0.25}, seed=1, key=["doc_id"])


@query("gbt_regression", None)
def gbt_regression(spark, sf):
    """L-16: 100 boosted regression trees with row and column sampling; validation metrics."""
    d, parts = _doc_reg(spark, sf)
    try:
        m = M.gbt_regressor(parts["train"], "y", _DOC_X, ntrees=100, max_depth=5, learn_rate=0.1, sample_rate=0.8,
                            col_sample_rate=0.7, seed=1)
        return _small_result(spark, regression_metrics(m.transform(parts["valid"]), "y", "prediction"))
    finally:
        d.unpersist()


@query("network_regression", None)
def network_regression(spark, sf):
    """L-17: 10-5-10 ReLU network, input dropout 0.7, 15 epochs; validation metrics and the
    constant-mean baseline."""
    d, parts = _doc_reg(spark, sf)
    try:
        model, hist = fit_network(parts["train"], "y", _DOC_X, hidden=(10, 5, 10), epochs=15, input_dropout=0.7,
                                  seed=1)
        pred = model.transform(parts["valid"].select(*_DOC_X, "y"))
        mean_y = parts["train"].select(F.avg("y")).scalar()
        met = regression_metrics(pred, "y", "predict")
        base = parts["valid"].agg(F.avg(F.pow(F.col("y") - mean_y, 2)))
        out = (met.withColumn("baseline_mse", base.scalar())          # scalar subquery, no join
               .withColumn("first_loss", F.lit(hist[0])).withColumn("last_loss", F.lit(hist[-1])))
        return _small_result(spark, out)
    finally:
        d.unpersist()


@query("glm_path", None)
def glm_path_q(spark, sf):
    """L-19: elastic-net path (alpha 0.5) with validation MSE at every penalty."""
    d, parts = _doc_reg(spark, sf)
    try:
        return M.glm_path(parts["train"], "y", _DOC_X, alpha=0.5, n_lambda=10, valid=parts["valid"])
    finally:
        d.unpersist()


@query("predicted_actual", None)
def predicted_actual(spark, sf):
    """G-06, L-19: predicted and actual response of every validation row under the best point of the penalty path;
    a row with a NULL feature stays, with a NULL prediction."""
    d, parts = _doc_reg(spark, sf)
    try:
        model, _ = M.penalised_regression(parts["train"], "y", _DOC_X, alpha=0.5, valid=parts["valid"])
    finally:
        d.unpersist()
    return (M.predict_every_row(model, parts["valid"], _DOC_X)
            .select("doc_id", F.col("prediction").alias("predicted"), F.col("y").alias("actual")))


def _part_split(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"),
                                     (F.col("p_partkey") % 1000).cast("double").alias("p_code"), "p_retailprice")
    return partition(p, {"train": 0.75, "valid": 0.25}, seed=1, key=["p_partkey"])


@query("gbm_regression_parity", None)
def gbm_regression_parity(spark, sf):
    """L-16 with H2O's conventions (start at the mean, every tree shrunk): 100 trees, depth 5,
    rate 0.1, row sample 0.8, column sample 0.5; validation metrics."""
    parts = _part_split(spark, sf)
    m = fit_regression_boost(parts["train"], "p_retailprice", ["p_size", "p_code"], ntrees=100, max_depth=5,
                             learn_rate=0.1, sample_rate=0.8, col_sample_rate=0.5, seed=1)
    return _small_result(spark, regression_metrics(m.transform(parts["valid"]), "p_retailprice", "predict"))


_FULL = {"learn_rate": [0.01, 0.1], "max_depth": [3, 5, 9], "sample_rate": [0.8, 1.0], "col_sample_rate": [0.2, 0.5, 1.0]}
_RANDOM = {"learn_rate": [round(0.01 * i, 2) for i in range(1, 11)], "max_depth": list(range(2, 11)),
           "sample_rate": [round(0.5 + 0.1 * i, 1) for i in range(6)], "col_sample_rate": [round(0.1 * i, 1) for i in range(1, 11)]}


@query("grid_full", None)
def grid_full(spark, sf):
    """R-01, R-04, R-05: Cartesian grid 2 x 3 x 2 x 3 = 36 GBMs of 100 trees, leaderboard by validation MSE."""
    parts = _part_split(spark, sf)
    board, models = grid_search(parts["train"], parts["valid"], "p_retailprice", ["p_size", "p_code"], _FULL,
                                ntrees=100, seed=1)
    return board


@query("grid_random", None)
def grid_random(spark, sf):
    """R-02, R-03: random grid over 10 x 9 x 6 x 10 = 5,400 combinations, at most 50 models of 100 trees;
    the best model's row first."""
    parts = _part_split(spark, sf)
    board, models = grid_search(parts["train"], parts["valid"], "p_retailprice", ["p_size", "p_code"], _RANDOM,
                                strategy="RandomDiscrete", max_models=50, ntrees=100, seed=1)
    top, _ = best_model(board, models)
    return board.withColumn("is_best", F.col("model_id") == F.lit(top["model_id"]))


# ---------------------------------------------------------------- facts about fitted models
# Each of these fits a model and returns counts and comparisons computed from the model's own output;
# the SQL states what they must be.

def _board_facts(spark, sf, board: DataFrame, models: dict, hyper: dict, most: int) -> DataFrame:
    """One row of facts about a leaderboard, all computed from its rows and the best model's predictions."""
    valid = _part_split(spark, sf)["valid"]
    rows = board.collect()                              # a row a model
    names = list(hyper)
    top, model = best_model(board, models)
    again = model.transform(valid).agg(F.avg(F.pow(F.col("p_retailprice") - F.col("predict"), 2))).first()[0]
    combos = {tuple(r[n] for n in names) for r in rows}
    facts = (len(rows), len(combos), sum(all(r[n] in [float(v) for v in hyper[n]] for n in names) for r in rows),
             sum(a.mse <= b.mse for a, b in zip(rows, rows[1:])), rows[0].model_id == top.model_id and top.mse == min(r.mse for r in rows),
             bool(abs(again - top.mse) <= 1e-6 * again), len(rows) <= most, min(len(m.ensemble.roots) for m in models.values()),
             max(len(m.ensemble.roots) for m in models.values()))
    return spark.createDataFrame([facts], "models long, combinations long, inside_grid long, in_order long, best_first boolean, "
                                          "best_error_repeats boolean, within_limit boolean, least_trees long, most_trees long")


_BOARD_SQL = """
SELECT CAST({n} AS BIGINT) AS models, CAST({n} AS BIGINT) AS combinations, CAST({n} AS BIGINT) AS inside_grid, CAST({n} - 1 AS BIGINT) AS in_order,
       true AS best_first, true AS best_error_repeats, true AS within_limit, CAST(100 AS BIGINT) AS least_trees, CAST(100 AS BIGINT) AS most_trees
"""


@query("grid_full_facts", _BOARD_SQL.format(n="(2 * 3 * 2 * 3)"))
def grid_full_facts(spark, sf):
    """R-01, R-04, R-05: the 36 models of the full grid: count, distinct combinations, order, the best one's error from its predictions."""
    parts = _part_split(spark, sf)
    board, models = grid_search(parts["train"], parts["valid"], "p_retailprice", ["p_size", "p_code"], _FULL, ntrees=100, seed=1)
    return _board_facts(spark, sf, board, models, _FULL, 36)


@query("grid_random_facts", _BOARD_SQL.format(n="least(50, 10 * 9 * 6 * 10)"))
def grid_random_facts(spark, sf):
    """R-02, R-04, R-05: 50 distinct models of the random grid, as above."""
    parts = _part_split(spark, sf)
    board, models = grid_search(parts["train"], parts["valid"], "p_retailprice", ["p_size", "p_code"], _RANDOM,
                                strategy="RandomDiscrete", max_models=50, ntrees=100, seed=1)
    return _board_facts(spark, sf, board, models, _RANDOM, 50)


@query("grid_stop", """
SELECT true AS same_board, true AS stopped_early, true AS stop_is_due
""")
def grid_stop(spark, sf):
    """R-03: a search that stops after two models without an improvement of a tenth gives one board in waves of 1 and of 8 models;
    the whole grid's errors show that the stop was due there and not before."""
    parts = _part_split(spark, sf)
    hyper = {"learn_rate": [0.1, 0.05], "max_depth": [2, 3, 4, 5]}
    args = (parts["train"], parts["valid"], "p_retailprice", ["p_size", "p_code"], hyper)
    number = lambda r: int(r.model_id.rpartition("_")[2])
    one, eight = (sorted(map(tuple, grid_search(*args, ntrees=20, stopping_rounds=2, stopping_tolerance=0.1, parallelism=p)[0].collect())) for p in (1, 8))
    errors = [r.mse for r in sorted(grid_search(*args, ntrees=20)[0].collect(), key=number)]
    best = [min(errors[:i + 1]) for i in range(len(errors))]
    due = [i + 1 for i in range(2, len(best)) if best[i - 2] - best[i] <= 0.1 * best[i - 2]]
    return spark.createDataFrame([(one == eight, len(one) < len(errors), bool(due) and len(one) == due[0])],
                                 "same_board boolean, stopped_early boolean, stop_is_due boolean")


@query("gbm_importance", """
SELECT CAST(13 AS BIGINT) AS variables, true AS shares_add_up, true AS top_is_one, true AS unused_is_zero, true AS descending
""")
def gbm_importance(spark, sf):
    """L-14: variable importance of the multi-class booster over the twelve letter shares and a constant column."""
    d, parts = _doc_lang(spark, sf)
    try:
        m = fit_multinomial_boost(parts["train"].withColumn("constant", F.lit(1.0)), "lang", [*_LANG_X, "constant"], ntrees=20, max_depth=3,
                                  learn_rate=0.1, col_sample_rate=0.7, seed=1)
        rows = m.importance(d).collect()
    finally:
        d.unpersist()
    unused = [r for r in rows if r.variable == "constant"]
    return spark.createDataFrame([(len(rows), abs(sum(r.percentage for r in rows) - 1) < 1e-9, rows[0].scaled_importance == 1.0,
                                   unused[0].relative_importance == 0.0, all(a.relative_importance >= b.relative_importance for a, b in zip(rows, rows[1:])))],
                                 "variables long, shares_add_up boolean, top_is_one boolean, unused_is_zero boolean, descending boolean")


@query("gbm_log_loss", """
WITH p AS (SELECT count(*) * 1.0 / sum(count(*)) OVER () AS p FROM documents WHERE lang IS NOT NULL GROUP BY lang)
SELECT round(-sum(p * ln(p)) * 1e6) / 1e6 AS start_loss, CAST(20 AS BIGINT) AS rounds, CAST(20 AS BIGINT) AS falls, true AS better,
       (SELECT count(*) FROM documents WHERE lang IS NOT NULL) AS rows_scored FROM p
""")
def gbm_log_loss(spark, sf):
    """L-15: log loss of the multi-class booster (20 rounds, depth 3, rate 0.01, column sample 0.7) on its training rows; it starts at the
    entropy of the classes and falls every round."""
    d, _ = _doc_lang(spark, sf)
    try:
        m = fit_multinomial_boost(d, "lang", _LANG_X, ntrees=20, max_depth=3, learn_rate=0.01, col_sample_rate=0.7, seed=1)
        rows = m.log_loss(d, "lang").collect()          # a row a round
    finally:
        d.unpersist()
    loss = [r.log_loss for r in rows]
    return spark.createDataFrame([(round(loss[0] * 1e6) / 1e6, len(loss) - 1, sum(a > b for a, b in zip(loss, loss[1:])), loss[-1] < 0.95 * loss[0], rows[0].rows)],
                                 "start_loss double, rounds long, falls long, better boolean, rows_scored long")


@query("every_row_scored", """
SELECT model, count(*) AS rows_out, count(*) FILTER (WHERE p_partkey % 7 = 0) AS rows_missing, CAST(0 AS BIGINT) AS unpredicted
FROM part, (VALUES ('kmeans'), ('linear'), ('logistic'), ('forest'), ('gbt'), ('booster'), ('multinomial')) m(model) GROUP BY model
""")
def every_row_scored(spark, sf):
    """L-21: every model scores every row, also the seventh of the rows without one of the predictors."""
    p = _t(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 7 != 0, F.col("p_size").cast("double")).alias("size"),
                                     (F.col("p_partkey") % 1000).cast("double").alias("code"), F.col("p_retailprice").cast("double").alias("price"))
    p = p.withColumn("dear", (F.col("price") > 1400).cast("double")).withColumn("kind", F.when(F.col("price") > 1400, "dear").otherwise("cheap"))
    xs = ["size", "code"]
    fitted = {"kmeans": M.kmeans(p, xs, k=3, seed=1)[0], "linear": M.linear_regression(p, "price", xs), "logistic": M.logistic_regression(p, "dear", xs),
              "forest": M.random_forest(p, "kind", xs, num_trees=5), "gbt": M.gbt_regressor(p, "price", xs, ntrees=5),
              "booster": fit_regression_boost(p, "price", xs, ntrees=5), "multinomial": fit_multinomial_boost(p, "kind", xs, ntrees=5)}
    out = None
    for name, m in fitted.items():
        scored = m.transform(p)
        predicted = F.col("predict" if "predict" in scored.columns else "prediction")
        one = scored.agg(F.count(F.lit(1)).alias("rows_out"), F.count_if(F.col("size").isNull()).alias("rows_missing"), F.count_if(predicted.isNull()).alias("unpredicted")) \
            .withColumn("model", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.select("model", "rows_out", "rows_missing", "unpredicted")


@query("kmeans_labels", """
SELECT count(*) AS points, CAST(3 AS BIGINT) AS clusters, CAST(1 AS INTEGER) AS least_label, CAST(3 AS INTEGER) AS most_label, CAST(0 AS BIGINT) AS nearer_elsewhere FROM part
""")
def kmeans_labels(spark, sf):
    """G-07: every point with its label ``prediction + 1``; none lies nearer to another centre than to its own."""
    p = _t(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("x1"), (F.col("p_retailprice") / 100.0).cast("double").alias("x2"))
    model, centers = M.kmeans(p, ["x1", "x2"], k=3, seed=1)
    points = M.labelled_points(model, p)
    far = [F.pow(F.col("x1") - c.x1, 2) + F.pow(F.col("x2") - c.x2, 2) for c in centers.orderBy("prediction").collect()]      # k rows
    own = F.element_at(F.array(*far), F.col("label"))
    return points.agg(F.count(F.lit(1)).alias("points"), F.countDistinct("label").alias("clusters"), F.min("label").alias("least_label"),
                      F.max("label").alias("most_label"), F.count_if(own > F.least(*far) + 1e-9).alias("nearer_elsewhere"))
