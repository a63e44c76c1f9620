"""Feature steps and cleaning (F-01..F-11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import IndexToString, RFormula, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import exact_median, exact_quantiles, placed, with_pieces


def string_index(df: DataFrame, col: str, out: str, order: str = "frequencyDesc",
                 handle_invalid: str = "keep"):
    """Index a text column, most frequent value first (ties by name).  Returns (model, frame)."""
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType=order,
                          handleInvalid=handle_invalid).fit(df)
    return model, model.transform(df)


def index_to_string(df: DataFrame, col: str, out: str, labels: Sequence[str]) -> DataFrame:
    return IndexToString(inputCol=col, outputCol=out, labels=list(labels)).transform(df)


def index_roundtrip(df: DataFrame, col: str, idx: str, back: str) -> DataFrame:
    """Indexer then its inverse, chained in one pipeline (``sdf_mutate`` twice)."""
    si = StringIndexer(inputCol=col, outputCol=idx, stringOrderType="frequencyDesc")
    model = Pipeline(stages=[si]).fit(df)
    labels = model.stages[0].labels
    pm = Pipeline(stages=[model.stages[0], IndexToString(inputCol=idx, outputCol=back, labels=labels)])
    return pm.fit(df).transform(df)


def formula_features(df: DataFrame, formula: str, features: str = "features", label: str = "label") -> DataFrame:
    """``y ~ a + b`` to a feature vector and a label column (``RFormula``)."""
    return RFormula(formula=formula, featuresCol=features, labelCol=label).fit(df).transform(df)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "skip") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(cols) if cols else None)


def fill_missing(df: DataFrame, col: str, strategy: str = "zero", out: str | None = None) -> DataFrame:
    """Fill NULLs with 0, the column mean or the exact median (scalar subqueries, no join)."""
    out = out or col
    if strategy == "zero":
        v = F.lit(0.0)
    elif strategy == "mean":
        v = df.select(F.avg(col)).scalar()
    elif strategy == "median":
        v = exact_median(df, [], col, name="_m").scalar()
    else:
        raise ValueError(strategy)
    return df.withColumn(out, F.coalesce(F.col(col), v))


def _micros(df: DataFrame, time: str):
    from pyspark.sql.types import TimestampNTZType
    if isinstance(df.schema[time].dataType, TimestampNTZType):
        # zone-free: microseconds from the NTZ epoch, whatever the session time zone
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{time}`)").cast("double")
    return F.unix_micros(F.col(time)).cast("double")


def _interp_expr(value: str, t, pv: str, pt: str, nv: str, nt: str):
    frac = F.when(F.col(nt) == F.col(pt), F.lit(0.0)).otherwise((t - F.col(pt)) / (F.col(nt) - F.col(pt)))
    return (F.when(F.col(value).isNotNull(), F.col(value))
            .when(F.col(pv).isNotNull() & F.col(nv).isNotNull(), F.col(pv) + (F.col(nv) - F.col(pv)) * frac)
            .otherwise(F.coalesce(F.col(pv), F.col(nv))))


def interpolate_linear(df: DataFrame, keys: Sequence[str], time: str, value: str, out: str,
                       tiebreak: str | None = None, strategy: str = "range") -> DataFrame:
    """Fill NULLs in a series by linear interpolation in time between the nearest
    non-NULL neighbours of the same key; one neighbour only -> its value.  Rows of one time stand in the order of ``tiebreak``
    (if given) and of a hash of the row.

    The rows are range-partitioned by (key, time); inside a piece of a key the neighbours are running first and last
    values, and a piece's own ends get theirs from the nearest pieces of the key that hold a value.  A long gap is many
    pieces, so no key and no gap gathers in one task.  ``strategy="window"`` asks for Spark's window over whole keys."""
    keys = list(keys)
    order = [time] + ([tiebreak] if tiebreak else [])
    if strategy == "window":
        return _interpolate_window(df, keys, order, time, value, out)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col("_t").alias("t")))
    rows = placed(df.withColumn("_t", _micros(df, time)), keys, order).withColumn("_known", known)
    w = Window.partitionBy("_pid", *keys).orderBy("_at")
    rows = rows.withColumn("_prev", F.last("_known", True).over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("_next", F.last("_known", True).over(Window.partitionBy("_pid", *keys).orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, 0)))
    ends = rows.groupBy("_pid", *keys).agg(F.min_by("_known", F.when(F.col("_known").isNotNull(), F.col("_at"))).alias("_head"),
                                           F.max_by("_known", F.when(F.col("_known").isNotNull(), F.col("_at"))).alias("_tail"))
    over = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_pid")             # one row a piece of the key
    back = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.desc("_pid"))
    ends = ends.select("_pid", *keys, F.last("_tail", True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_left"),
                       F.last("_head", True).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("_right"))
    d = with_pieces(rows, ends, keys).withColumn("_prev", F.coalesce("_prev", "_left")).withColumn("_next", F.coalesce("_next", "_right"))
    return d.select(*df.columns, _interp_expr(value, F.col("_t"), "_prev.v", "_prev.t", "_next.v", "_next.t").alias(out))


def _interpolate_window(df, keys, order, time, value, out):
    cols = df.columns
    df = df.withColumn("_t", _micros(df, time))
    order = [F.col(c) for c in order] + [F.xxhash64(*[F.col(c) for c in df.columns])]
    before = Window.partitionBy(*keys).orderBy(*[c.asc() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    # the next value is the last one of the reversed series: a running frame, linear in its length
    after = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    t = F.col("_t")
    tv = F.when(F.col(value).isNotNull(), t)
    d = (df.withColumn("_pv", F.last(value, True).over(before)).withColumn("_pt", F.last(tv, True).over(before))
         .withColumn("_nv", F.last(value, True).over(after)).withColumn("_nt", F.last(tv, True).over(after)))
    return d.select(*cols, _interp_expr(value, t, "_pv", "_pt", "_nv", "_nt").alias(out))


def iqr_fences(df: DataFrame, col: str, coef: float = 1.5) -> DataFrame:
    q = exact_quantiles(df, [], col, [0.25, 0.75], ["q1", "q3"])
    return q.select((F.col("q1") - coef * (F.col("q3") - F.col("q1"))).alias("lo"),
                    (F.col("q3") + coef * (F.col("q3") - F.col("q1"))).alias("hi"))


def handle_outliers(df: DataFrame, col: str, how: str = "clip", coef: float = 1.5,
                    out: str | None = None) -> DataFrame:
    """Outside the IQR fences: ``clip`` to the fence, ``remove`` the row, or ``null`` the value."""
    out = out or col
    # the fences enter once, as one struct-valued scalar subquery in a helper column
    d = df.withColumn("_fence", iqr_fences(df, col, coef).select(F.struct("lo", "hi")).scalar())
    lo, hi = F.col("_fence.lo"), F.col("_fence.hi")
    x = F.col(col)
    if how == "clip":
        d = d.withColumn(out, F.when(x < lo, lo).when(x > hi, hi).otherwise(x))  # NULL stays NULL
    elif how == "remove":
        d = d.filter(x.isNull() | ((x >= lo) & (x <= hi)))
    elif how == "null":
        d = d.withColumn(out, F.when((x >= lo) & (x <= hi), x))
    else:
        raise ValueError(how)
    return d.drop("_fence")


def log_gauss(df: DataFrame, col: str) -> DataFrame:
    """``log1p`` and a Gaussian kernel around the column mean with its sample SD."""
    d = df.withColumn("_st", df.select(F.struct(F.avg(col).alias("mu"), F.stddev_samp(col).alias("sd"))).scalar())
    mu, sd = F.col("_st.mu"), F.col("_st.sd")
    x = F.col(col)
    return (d.withColumn(f"{col}_log1p", F.log1p(x))
            .withColumn(f"{col}_gauss", F.exp(-F.pow(x - mu, 2) / (F.lit(2.0) * F.pow(sd, 2)))).drop("_st"))
