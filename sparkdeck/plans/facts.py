"""Queries that return facts about an operator's own output, so that SQL can check what it cannot express.

Every value is counted or compared by Spark over the operator's whole result; the SQL computes it from the tables, or
states it where it must always hold.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import last_chars, number_sequence, safe_int
from ..ml import models as M
from ..ml.evaluate import cluster_stats_array
from ..ml.network import fit_network
from ..operators.features import formula_features
from ..operators.splits import partition, sample_frac, sample_n, split_frame
from ..operators.stats import bar_counts
from ..operators.verbs import select_positions
from ..session import delete_path
from ..sources.files import read_csv, read_delimited, write_csv
from ..sources.tables import clean_names, create_table, head, list_tables, table
from .catalog import _t, query, r2
from .ml_catalog import _DOC_X, _LANG_X, _doc_lang, _doc_reg, _emb, _scratch, _small_result

_CSV = """SELECT '{how}' AS how, o_orderstatus, count(*) AS n, (round((sum(o_totalprice)) * 1e2) / 1e2) AS total, min(o_orderkey) AS first_key,
       max(o_orderkey) AS last_key, CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders GROUP BY o_orderstatus"""


@query("csv_values", " UNION ALL ".join(_CSV.format(how=h) for h in ("inferred", "typed")))
def csv_values(spark, sf):
    """S-02..S-04: the values of a CSV that was written and read back, with inferred and with given types."""
    path = _scratch(spark, "csv")
    try:
        write_csv(_t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path)
        schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                               T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType())])
        out = None
        for how, d in (("inferred", read_csv(spark, path)), ("typed", read_delimited(spark, path, schema, sep=",", header=True, quote='"'))):
            one = d.groupBy("o_orderstatus").agg(
                F.count(F.lit(1)).alias("n"), r2(F.sum("o_totalprice")).alias("total"), F.min("o_orderkey").cast("long").alias("first_key"),
                F.max("o_orderkey").cast("long").alias("last_key"), F.sum("o_custkey").cast("long").alias("customers")).withColumn("how", F.lit(how))
            out = one if out is None else out.unionByName(one)
        return _small_result(spark, out.select("how", "o_orderstatus", "n", "total", "first_key", "last_key", "customers"))
    finally:
        delete_path(spark, path)


@query("table_verbs", """
SELECT count(*) AS n, CAST(sum(n_nationkey) AS BIGINT) AS keys, true AS listed, true AS refused_twice, least(6, count(*)) AS head_rows,
       'n_nationkey,n_name,n_name_1,_1st' AS names FROM nation
""")
def table_verbs(spark, sf):
    """S-01, S-08, S-09, S-13, S-14: copy into a named table, list, refuse the same name, first rows, clean names."""
    d = _t(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("n.name"), F.col("n_name").alias("n-name"), F.lit(1).alias("1st"))
    name = "sparkdeck_table_verbs"
    made = create_table(spark, clean_names(d), name, overwrite=True)
    try:
        try:
            create_table(spark, d, name)
            refused = False
        except Exception as e:
            refused = "ALREADY_EXISTS" in str(e)
        listed = name in list_tables(spark)
        return _small_result(spark, table(spark, name).agg(F.count(F.lit(1)).alias("n"), F.sum("n_nationkey").cast("long").alias("keys")).select(
            "n", "keys", F.lit(listed).alias("listed"), F.lit(refused).alias("refused_twice"), F.lit(head(made).count()).cast("long").alias("head_rows"),
            F.lit(",".join(made.columns)).alias("names")))
    finally:
        spark.catalog.dropTempView(name)


@query("model_roundtrip", "SELECT count(*) AS n, count(*) AS same FROM part")
def model_roundtrip(spark, sf):
    """S-15: a saved and reloaded pipeline predicts every row alike, rows without a predictor included."""
    p = _t(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 5 != 0, F.col("p_size")).alias("size"), F.col("p_retailprice").cast("double").alias("price"))
    path = _scratch(spark, "model")
    try:
        model = M.linear_regression(p, "price", ["size"])
        M.save_model(model, path)
        one = model.transform(p).select("p_partkey", F.col("prediction").alias("a"))
        two = M.load_pipeline(path).transform(p).select(F.col("p_partkey").alias("k"), F.col("prediction").alias("b"))
        return _small_result(spark, one.join(two, F.col("p_partkey") == F.col("k")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") == F.col("b")).alias("same")))
    finally:
        delete_path(spark, path)


@query("sampling_facts", """
SELECT least(100, count(*)) AS drawn, least(100, count(*)) AS drawn_distinct, CAST(0 AS BIGINT) AS drawn_strange, true AS drawn_again, count(*) AS in_parts,
       count(*) AS in_parts_distinct, true AS parts_near, count(*) AS in_frames, true AS frames_near, true AS share_near FROM orders
""")
def sampling_facts(spark, sf):
    """X-01..X-04: an exact sample, a share, named parts and split frames: sizes, disjointness, completeness, repeatability."""
    o = _t(spark, sf, "orders").select("o_orderkey")
    n = o.count()
    one = sample_n(o, 100, seed=42)
    keys = sorted(r[0] for r in one.collect())          # at most 100 rows
    again = sorted(r[0] for r in sample_n(o, 100, seed=42).collect())
    strange = one.join(o, "o_orderkey", "left_anti").count()
    parts = partition(o, {"training": 0.7, "valid": 0.2, "test": 0.1}, seed=1099, key=["o_orderkey"])
    sizes = {k: d.count() for k, d in parts.items()}
    whole = parts["training"].union(parts["valid"]).union(parts["test"]).distinct().count()
    frames = [d.count() for d in split_frame(o, [0.75], seed=1234, key=["o_orderkey"])]
    near = lambda got, share: abs(got - share * n) <= 6 * math.sqrt(n * share * (1 - share)) + 1
    share = sample_frac(_t(spark, sf, "orders"), 0.25, seed=7).count()
    row = (len(keys), len(set(keys)), strange, keys == again, sum(sizes.values()), whole, all(near(sizes[k], w) for k, w in
           (("training", 0.7), ("valid", 0.2), ("test", 0.1))), sum(frames), near(frames[0], 0.75), near(share, 0.25))
    return spark.createDataFrame([row], "drawn long, drawn_distinct long, drawn_strange long, drawn_again boolean, in_parts long, in_parts_distinct long, "
                                        "parts_near boolean, in_frames long, frames_near boolean, share_near boolean")


@query("logistic_facts", """
SELECT count(*) AS n, (round(avg(toxic) * 1e4) / 1e4) AS mean_probability, (round(avg(toxic * ln(1 + n_chars)) * 1e3) / 1e3) AS mean_times_x,
       CAST(sum(toxic) AS BIGINT) AS positives
FROM labels JOIN documents USING (doc_id) WHERE toxic IS NOT NULL AND n_chars IS NOT NULL
""")
def logistic_facts(spark, sf):
    """L-08, L-21, F-04, F-05: at the maximum of the likelihood the fitted probabilities match the response's mean and its product with a feature."""
    from pyspark.ml.functions import vector_to_array
    d = _t(spark, sf, "labels").join(_t(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id").where("toxic is not null and n_chars is not null")
    d = d.withColumn("log_chars", F.log1p("n_chars")).withColumn("y", F.col("toxic").cast("double")).withColumn("half", F.col("log_chars") / 2)
    f = formula_features(d.select("doc_id", "y", "log_chars"), "y ~ log_chars")
    model = M.logistic_regression(f.select("y", "log_chars"), "y", ["log_chars"], max_iter=200)
    p = vector_to_array("probability")[1]
    return model.transform(d).agg(F.count(F.lit(1)).alias("n"), (F.round(F.avg(p) * 1e4) / 1e4).alias("mean_probability"),
                                  (F.round(F.avg(p * F.col("log_chars")) * 1e3) / 1e3).alias("mean_times_x"), F.sum("y").cast("long").alias("positives"))


@query("pca_facts", """
SELECT (round((var_samp(l_quantity) + var_samp(l_extendedprice / 1000) + var_samp(l_discount * 100) + var_samp(l_tax * 100)) * 1e4) / 1e4) AS variance,
       CAST(4 AS BIGINT) AS components, true AS shares_add_up, true AS orthonormal, true AS descending, true AS uncentred_adds_up FROM lineitem
""")
def pca_facts(spark, sf):
    """L-09, L-10: all components hold the whole variance, are orthonormal and in descending order; so are the uncentred ones."""
    li = _t(spark, sf, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 1000).alias("price"), (F.col("l_discount") * 100).alias("discount"),
                                          (F.col("l_tax") * 100).alias("tax"))
    cols = li.columns
    rows, raw = (M.pca(li, cols, k=4, center=c).collect() for c in (True, False))        # four rows each
    base = np.array([r.loadings for r in rows])
    facts = (round(sum(r.std_dev ** 2 for r in rows) * 1e4) / 1e4, len(rows), abs(sum(r.explained for r in rows) - 1) < 1e-9,
             bool(np.allclose(base @ base.T, np.eye(4), atol=1e-8)), all(a.explained >= b.explained for a, b in zip(rows, rows[1:])),
             abs(sum(r.explained for r in raw) - 1) < 1e-9)
    return spark.createDataFrame([facts], "variance double, components long, shares_add_up boolean, orthonormal boolean, descending boolean, uncentred_adds_up boolean")


@query("forest_facts", """
SELECT CAST(count(*) FILTER (WHERE lang IS NOT NULL) AS BIGINT) AS scored, true AS better_than_the_largest_class, CAST(12 AS BIGINT) AS variables,
       true AS shares_add_up, true AS top_is_one FROM documents
""")
def forest_facts(spark, sf):
    """L-11..L-14: a forest of 10 trees scores every document, beats the largest class, and its importances add up."""
    d, _ = _doc_lang(spark, sf)
    try:
        d = d.where("lang is not null")
        m = M.random_forest(d, "lang", _LANG_X, num_trees=10, seed=1)
        labels = F.array(*[F.lit(x) for x in m.stages[0].labels])
        p = m.transform(d).withColumn("hit", (F.element_at(labels, F.col("prediction").cast("int") + 1) == F.col("lang")).cast("int"))
        scored, hits = p.agg(F.count("prediction"), F.sum("hit")).first()
        largest = d.groupBy("lang").count().agg(F.max("count")).first()[0]
        vi = M.variable_importance(m, _LANG_X).collect()
    finally:
        d.unpersist()
    return spark.createDataFrame([(scored, hits > largest, len(vi), abs(sum(r.percentage for r in vi) - 1) < 1e-9, vi[0].scaled_importance == 1.0)],
                                 "scored long, better_than_the_largest_class boolean, variables long, shares_add_up boolean, top_is_one boolean")


@query("kmeans_facts", """
SELECT count(*) AS points, CAST(10 AS BIGINT) AS clusters, true AS below_two_clusters FROM embeddings
""")
def kmeans_facts(spark, sf):
    """L-01, L-03, L-21: ten clusters of all embeddings; their sums of squares are below those of two clusters."""
    e = _emb(spark, sf)
    model, centers = M.kmeans(e, "features", k=10, seed=1)
    stats = cluster_stats_array(model.transform(e), "emb", centers).collect()            # a row a cluster
    two, at = M.kmeans(e, "features", k=2, seed=1)
    whole = cluster_stats_array(two.transform(e), "emb", at).collect()
    return spark.createDataFrame([(sum(r["size"] for r in stats), len(stats), sum(r["within_ss"] for r in stats) < sum(r["within_ss"] for r in whole))],
                                 "points long, clusters long, below_two_clusters boolean")


@query("robust_facts", """
SELECT count(*) AS n, true AS robust_is_near, true AS least_squares_is_not FROM part
""")
def robust_facts(spark, sf):
    """F-10: a line of slope 2 with a tenth of wild values: the Huber fit finds it, least squares does not."""
    d = _t(spark, sf, "part").select(F.col("p_size").cast("double").alias("x"), F.pmod("p_partkey", F.lit(10)).alias("m"), F.pmod("p_partkey", F.lit(7)).alias("e"))
    d = d.withColumn("y", F.when(F.col("m") == 0, F.col("x") * 40 + 900).otherwise(2 * F.col("x") + 1 + (F.col("e") - 3) / 10))
    slopes = [M.linear_regression(d, "y", ["x"], loss=loss).stages[-1].coefficients[0] for loss in ("huber", "squaredError")]
    return spark.createDataFrame([(d.count(), bool(abs(slopes[0] - 2) < 0.1), bool(abs(slopes[1] - 2) > 0.5))], "n long, robust_is_near boolean, least_squares_is_not boolean")


@query("path_and_network_facts", """
SELECT CAST(10 AS BIGINT) AS points, CAST(0 AS BIGINT) AS first_nonzero, true AS error_falls, true AS penalty_falls, true AS network_learns, true AS network_beats_mean
""")
def path_and_network_facts(spark, sf):
    """L-17, L-19: the penalty path starts at the empty model and its error never rises; the network's loss falls below the mean's."""
    d, parts = _doc_reg(spark, sf)
    try:
        path = M.glm_path(parts["train"], "y", _DOC_X, alpha=0.5, n_lambda=10).collect()
        train = parts["train"].dropna()
        model, hist = fit_network(train, "y", _DOC_X, epochs=6, input_dropout=0.2, seed=1)
        mse, var = model.transform(train.select(*_DOC_X, "y")).agg(F.avg(F.pow(F.col("y") - F.col("predict"), 2)), F.var_pop("y")).first()
    finally:
        d.unpersist()
    return spark.createDataFrame([(len(path), path[0]["n_nonzero"], all(a["train_mse"] >= b["train_mse"] - 1e-9 for a, b in zip(path, path[1:])),
                                   all(a["lambda"] > b["lambda"] for a, b in zip(path, path[1:])), hist[-1] < hist[0], mse < var)],
                                 "points long, first_nonzero long, error_falls boolean, penalty_falls boolean, network_learns boolean, network_beats_mean boolean")


@query("helper_columns", """
SELECT p_partkey, p_name, right(p_name, 4) AS tail, coalesce(TRY_CAST(right(CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE p_name END, 1) AS BIGINT), -1) AS digit, '0,5,10' AS steps FROM part
""")
def helper_columns(spark, sf):
    """P-02, E-10, E-11, E-16: columns by position, last characters, a text as a number where it is one, a number sequence."""
    p = _t(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    digit = F.coalesce(safe_int(last_chars(F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey").cast("string")).otherwise(F.col("p_name")), 1)).cast("long"),
                       F.lit(-1).cast("long"))
    return select_positions(p, 1, 2).select("p_partkey", "p_name", last_chars("p_name", 4).alias("tail"), digit.alias("digit"),
                                            F.concat_ws(",", F.transform(number_sequence(0, 10, 5), lambda x: x.cast("int").cast("string"))).alias("steps"))


@query("bars", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def bars(spark, sf):
    """G-04: rows by value."""
    return bar_counts(_t(spark, sf, "orders"), "o_orderpriority")
