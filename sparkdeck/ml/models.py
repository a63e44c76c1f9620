"""Model fitting on ``pyspark.ml`` (L-01..L-14, L-16, L-19..L-21) and model saving (S-15).

Every fit is a Spark job over the DataFrame; what reaches the driver is bounded by
the model size (coefficients, centres, trees, a d x d moment matrix), never by
the row count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.distributions import t_two_sided_p
from ..operators.ordered import exact_quantiles


def features(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def complete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows without a NULL or NaN in ``cols``: those that models are fitted on."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in cols], F.lit(True)))


def filled_features(df: DataFrame, cols: Sequence[str], out: str = "features") -> list:
    """Pipeline stages that assemble ``cols`` with the means of ``df`` in place of NULL and NaN.

    The means are part of the stages (and so of a saved model): a row with a missing value is scored like
    any other, and its own columns stay as they are."""
    cols = list(cols)
    means = df.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    name = lambda c: c.replace("`", "``")
    put = ", ".join(f"coalesce(nanvl(cast(`{name(c)}` AS double), NULL), {float(m or 0.0)!r}D) AS `_filled_{i}`" for i, (c, m) in enumerate(zip(cols, means)))
    held = [f"_filled_{i}" for i in range(len(cols))]
    return [SQLTransformer(statement=f"SELECT *, {put} FROM __THIS__"), VectorAssembler(inputCols=held, outputCol=out, handleInvalid="keep"),
            SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(held)}) FROM __THIS__")]


# ---------------------------------------------------------------- clustering

def kmeans(df: DataFrame, cols: Sequence[str] | str, k: int = 3, seed: int = 1, standardize: bool = False,
           max_iter: int = 20):
    """k-means (k-means|| start).  ``standardize`` scales to unit variance around the
    mean first, as H2O does by default; centres are reported in the original units.
    Returns (pipeline model, centres frame)."""
    spark = df.sparkSession
    if isinstance(cols, str):            # already a vector column
        stages, feat = [], cols
        names = None
    else:
        stages = filled_features(df, cols, "_raw")
        feat, names = "_raw", list(cols)
        df = complete(df, names)
    if standardize:
        stages.append(StandardScaler(inputCol=feat, outputCol="_std", withMean=True, withStd=True))
        feat = "_std"
    stages.append(KMeans(featuresCol=feat, k=k, seed=seed, maxIter=max_iter, predictionCol="prediction"))
    model = Pipeline(stages=stages).fit(df)
    centers = np.array(model.stages[-1].clusterCenters())
    if standardize:
        sc = model.stages[-2]
        centers = centers * np.array(sc.std.toArray()) + np.array(sc.mean.toArray())
    if names is None:
        return model, spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centers)],
                                            "prediction int, center array<double>")
    rows = [(i, *[float(v) for v in c]) for i, c in enumerate(centers)]
    schema = T.StructType([T.StructField("prediction", T.IntegerType())] +
                          [T.StructField(c, T.DoubleType()) for c in cols])
    return model, spark.createDataFrame(rows, schema)


def labelled_points(model: PipelineModel, df: DataFrame, label: str = "label") -> DataFrame:
    """Every row of ``df`` with its cluster as a label from 1 (the scatter table of G-07)."""
    return model.transform(df).select(*df.columns, (F.col("prediction") + 1).cast("int").alias(label))


# ---------------------------------------------------------------- linear models

def linear_regression(df: DataFrame, y: str, xs: Sequence[str], reg: float = 0.0, elastic_net: float = 0.0,
                      solver: str = "auto", loss: str = "squaredError"):
    """Least squares (``solver="normal"`` gives standard errors); ``loss="huber"`` is the
    robust variant (F-10).  Returns (pipeline model)."""
    lr = LinearRegression(featuresCol="features", labelCol=y, regParam=reg, elasticNetParam=elastic_net,
                          solver=solver if loss == "squaredError" else "l-bfgs", loss=loss)
    return Pipeline(stages=[*filled_features(df, xs), lr]).fit(complete(df, [y, *xs]))


def coefficients(model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Named coefficients, intercept first (``coef(model)``)."""
    m = model.stages[-1]
    spark = SparkSession.getActiveSession()
    coefs = m.coefficients.toArray() if hasattr(m.coefficients, "toArray") else m.coefficientMatrix.toArray()[0]
    rows = [("(Intercept)", float(m.intercept))] + [(n, float(c)) for n, c in zip(names, coefs)]
    return spark.createDataFrame(rows, "term string, estimate double")


def regression_summary(model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """``summary(fit)``: estimate, standard error, t and p per term, plus R² and RMSE."""
    m = model.stages[-1]
    s = m.summary
    spark = SparkSession.getActiveSession()
    est = list(m.coefficients.toArray()) + [m.intercept]
    terms = list(names) + ["(Intercept)"]
    try:
        se, tv = s.coefficientStandardErrors, s.tValues
        pv = [t_two_sided_p(float(t), float(s.degreesOfFreedom)) for t in tv]
    except Exception:  # not available for regularised / non-normal fits
        se = tv = pv = [None] * len(est)
    rows = [(t, float(e), _f(a), _f(b), _f(c)) for t, e, a, b, c in zip(terms, est, se, tv, pv)]
    out = spark.createDataFrame(rows, "term string, estimate double, std_error double, t_value double, p_value double")
    return out.withColumn("r2", F.lit(float(s.r2))).withColumn("rmse", F.lit(float(s.rootMeanSquaredError)))


def residual_quantiles(model: PipelineModel, df: DataFrame, y: str) -> DataFrame:
    """``summary(fit)``'s residual line: smallest, quartiles and largest, one row."""
    left = model.transform(df).select((F.col(y) - F.col("prediction")).alias("residual"))
    return exact_quantiles(left, [], "residual", [0.0, 0.25, 0.5, 0.75, 1.0], ["min", "q25", "median", "q75", "max"])


def _f(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)


def logistic_regression(df: DataFrame, y: str, xs: Sequence[str], reg: float = 0.0, max_iter: int = 100):
    lr = LogisticRegression(featuresCol="features", labelCol=y, regParam=reg, maxIter=max_iter)
    return Pipeline(stages=[*filled_features(df, xs), lr]).fit(complete(df, [y, *xs]))


def glm_path(train: DataFrame, y: str, xs: Sequence[str], alpha: float = 0.5, n_lambda: int = 10,
             min_ratio: float = 1e-4, valid: DataFrame | None = None, parallelism: int = 4) -> DataFrame:
    """Elastic-net linear model over a geometric penalty path (``lambda_search``).

    The path starts at the smallest penalty that zeroes every coefficient (one
    aggregate, consistent with Spark's scaling of the objective) and steps down
    geometrically; the points are fitted concurrently on one cached frame.  Returns a
    table: lambda, non-zero count, training and validation MSE, coefficients.

    Rows with a NULL in the response or a feature take no part; a constant feature has
    no scale and keeps a zero coefficient.
    """
    spark = train.sparkSession
    xs = list(xs)
    train = train.dropna(subset=[y, *xs])
    valid = valid.dropna(subset=[y, *xs]) if valid is not None else None
    # Up to 4096 features Spark standardises by the population SD (beyond, by the sample
    # SD, where the same penalty is just as enough) and applies regParam on the
    # response's own scale, so the smallest penalty that zeroes every coefficient is
    # max_j |sum_i z_ij (y_i - mean y)| / (n * alpha) with z the standardised features.
    st = train.agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("my"),
                   *[F.avg(x).alias(f"m_{x}") for x in xs], *[F.stddev_pop(x).alias(f"s_{x}") for x in xs]).first()
    n = st["n"]
    dots = train.agg(*[F.sum(((F.col(x) - st[f"m_{x}"]) / st[f"s_{x}"]) * (F.col(y) - st["my"]))
                       .alias(x) if st[f"s_{x}"] else F.lit(0.0).alias(x) for x in xs]).first()
    # a hair above the boundary, where the optimiser's tolerance could leave a
    # coefficient of order 1e-4 instead of an exact zero
    lmax = 1.001 * max(abs(dots[x]) for x in xs) / (n * max(alpha, 1e-3))
    lambdas = [lmax * (min_ratio ** (i / (n_lambda - 1))) for i in range(n_lambda)]
    va = VectorAssembler(inputCols=xs, outputCol="features", handleInvalid="skip")
    tr = va.transform(train).select("features", y).cache()
    lr = LinearRegression(featuresCol="features", labelCol=y, elasticNetParam=alpha, standardization=True)
    rows = []
    vt = va.transform(valid).select("features", y).cache() if valid is not None else None
    # path points are independent fits over one cached frame: run them concurrently
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        fitted = list(pool.map(lambda i: (i, lr.copy({lr.regParam: lambdas[i]}).fit(tr)), range(len(lambdas))))
    for idx, model in fitted:
        coefs = model.coefficients.toArray()
        vmse = None
        if vt is not None:
            vmse = model.evaluate(vt).meanSquaredError
        rows.append((float(lambdas[idx]), int(np.count_nonzero(np.abs(coefs) > 1e-12)),
                     float(model.summary.meanSquaredError), _f(vmse),
                     [float(c) for c in coefs], float(model.intercept)))
    tr.unpersist()
    if vt is not None:
        vt.unpersist()
    return spark.createDataFrame(rows, "lambda double, n_nonzero int, train_mse double, valid_mse double, "
                                       "coefficients array<double>, intercept double").orderBy(F.desc("lambda"))


def penalised_regression(train: DataFrame, y: str, xs: Sequence[str], alpha: float = 0.5, n_lambda: int = 10,
                         valid: DataFrame | None = None) -> tuple[PipelineModel, float]:
    """(model, penalty): the point of :func:`glm_path` with the smallest validation MSE
    (training MSE without ``valid``; the larger penalty on ties), fitted to predict with."""
    path = glm_path(train, y, xs, alpha, n_lambda, valid=valid).collect()      # n_lambda rows
    best = min(path, key=lambda r: (r["train_mse"] if r["valid_mse"] is None else r["valid_mse"], -r["lambda"]))
    model = linear_regression(train.dropna(subset=[y, *xs]), y, xs, reg=best["lambda"], elastic_net=alpha)
    return model, best["lambda"]


def predict_every_row(model: PipelineModel, df: DataFrame, xs: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """``model.transform`` that says where it had to fill: a row with a NULL (or NaN) feature has a NULL prediction
    instead of the one from the training means."""
    whole = reduce(lambda a, b: a & b, [F.col(x).isNotNull() & ~F.isnan(F.col(x).cast("double")) for x in xs])
    return model.transform(df).withColumn(prediction, F.when(whole, F.col(prediction)))


# ---------------------------------------------------------------- PCA

def pca(df: DataFrame, cols: Sequence[str] | str, k: int | None = None, center: bool = True) -> DataFrame:
    """Principal components and explained variance.

    Centred: Spark's ``PCA`` (note its ``transform`` does not centre).  Uncentred
    (H2O's default): the second-moment matrix ``E[x x^T]`` from the distributed
    correlation, means and deviations (d x d on the driver), then an eigen split.
    Output: component, explained (share), std_dev, loadings.
    """
    spark = df.sparkSession
    if isinstance(cols, str):            # already a vector column
        fd = df.select(F.col(cols).alias("features"))
        k = k or len(fd.first()["features"])
    else:
        cols = list(cols)
        k = k or len(cols)
        fd = features(df.select(*cols), cols)
    if center:
        m = PCA(k=k, inputCol="features", outputCol="pc").fit(fd)
        comps = m.pc.toArray().T
        ev = m.explainedVariance.toArray()
        s = fd.select(Summarizer.metrics("variance").summary(F.col("features")).alias("s")).first()["s"]
        total = float(np.sum(s["variance"].toArray()))
        sd = np.sqrt(ev * total)
        rows = [(i + 1, float(ev[i]), float(sd[i]), [float(v) for v in comps[i]]) for i in range(k)]
    else:
        stats = fd.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("features")).alias("s")).first()["s"]
        n = float(stats["count"])
        mu = stats["mean"].toArray()
        var = stats["variance"].toArray()
        corr = Correlation.corr(fd, "features", "pearson").first()[0].toArray()
        sdv = np.sqrt(var)
        cov = corr * np.outer(sdv, sdv)
        cov[np.isnan(cov)] = 0.0
        m2 = cov * (n - 1) / n + np.outer(mu, mu)
        w, v = np.linalg.eigh(m2)
        order = np.argsort(w)[::-1][:k]
        w, v = np.clip(w[order], 0, None), v[:, order]
        share = w / np.sum(np.clip(np.linalg.eigvalsh(m2), 0, None))
        rows = [(i + 1, float(share[i]), float(math.sqrt(w[i])), [float(x) for x in v[:, i]]) for i in range(k)]
    return spark.createDataFrame(rows, "component int, explained double, std_dev double, loadings array<double>")


# ---------------------------------------------------------------- trees

def random_forest(train: DataFrame, label: str, xs: Sequence[str] | str, num_trees: int = 10, max_depth: int = 5,
                  max_bins: int = 32, seed: int = 1):
    """Classification forest; the label is indexed by frequency first.  ``xs`` is a
    column list or the name of a vector column.  Returns the pipeline."""
    stages = [StringIndexer(inputCol=label, outputCol="label_idx", handleInvalid="keep")]
    feat = xs if isinstance(xs, str) else "features"
    if not isinstance(xs, str):
        stages += filled_features(train, xs)
        train = complete(train, xs)
    stages.append(RandomForestClassifier(featuresCol=feat, labelCol="label_idx", numTrees=num_trees,
                                         maxDepth=max_depth, maxBins=max_bins, seed=seed))
    return Pipeline(stages=stages).fit(train)


def variable_importance(model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """Importances scaled to a maximum of 1, with the percentage share (H2O's table)."""
    imp = model.stages[-1].featureImportances.toArray()
    top = float(imp.max()) if imp.size and imp.max() > 0 else 1.0
    total = float(imp.sum()) or 1.0
    rows = [(n, float(v), float(v / top), float(v / total)) for n, v in zip(names, imp)]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "variable string, relative_importance double, scaled_importance double, "
                                       "percentage double").orderBy(F.desc("relative_importance"))


def gbt_regressor(train: DataFrame, y: str, xs: Sequence[str], ntrees: int = 100, max_depth: int = 5,
                  learn_rate: float = 0.1, sample_rate: float = 1.0, col_sample_rate: float = 1.0, seed: int = 1):
    """Spark's boosted regression trees (first tree weight 1, the rest ``learn_rate``)."""
    gbt = GBTRegressor(featuresCol="features", labelCol=y, maxIter=ntrees, maxDepth=max_depth, stepSize=learn_rate,
                       subsamplingRate=sample_rate, featureSubsetStrategy=_subset(col_sample_rate), seed=seed)
    return Pipeline(stages=[*filled_features(train, xs), gbt]).fit(complete(train, [y, *xs]))


def _subset(rate: float) -> str:
    return "all" if rate >= 1.0 else repr(float(rate))


def predictions_as_columns(pred: DataFrame, prob: str = "probability") -> DataFrame:
    return pred.withColumn(prob, vector_to_array(prob))


# ---------------------------------------------------------------- persistence

def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
