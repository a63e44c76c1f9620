"""Statistics behind the reference's plots and tests (G-01..G-05, A-13), computed on the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.distributions import t_pvalue_udf
from .ordered import exact_quantiles, running_max
from .verbs import paired


def group_moments(df: DataFrame, value: str, group: str) -> DataFrame:
    """n, mean and sample variance per group (NULL values dropped); partial aggregation."""
    return (df.filter(F.col(value).isNotNull() & F.col(group).isNotNull())
            .groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                                F.var_samp(value).alias("var")))


def pairwise_t_test(df: DataFrame, value: str, group: str, p_adjust: str | None = "holm",
                    pooled: bool = True) -> DataFrame:
    """R ``pairwise.t.test(x, g)``: every pair of groups, pooled SD, Holm adjustment.

    The data are reduced to one row per group first; pairs are formed from that
    summary (k groups give k(k-1)/2 rows), so nothing row-level is paired.  The
    p-value is an Arrow-batched UDF over the pair rows only.
    Output: group_a, group_b, n_a, n_b, mean_a, mean_b, t, df, p_value[, p_adj].
    """
    m = group_moments(df, value, group)
    a = m.select(F.col(group).alias("group_a"), F.col("n").alias("n_a"), F.col("mean").alias("mean_a"),
                 F.col("var").alias("var_a"))
    b = m.select(F.col(group).alias("group_b"), F.col("n").alias("n_b"), F.col("mean").alias("mean_b"),
                 F.col("var").alias("var_b"))
    # pooled variance and residual degrees of freedom in one scalar subquery
    pool = m.select(F.struct(
        (F.sum("n") - F.count(F.lit(1))).cast("double").alias("dof"),
        (F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))) /
         (F.sum("n") - F.count(F.lit(1)))).alias("sp2"))).scalar()
    pairs = paired(a, b, F.col("group_a") < F.col("group_b")).withColumn("_pool", pool)
    dfree, sp2 = F.col("_pool.dof"), F.col("_pool.sp2")
    if pooled:
        se = F.sqrt(sp2 * (F.lit(1.0) / F.col("n_a") + F.lit(1.0) / F.col("n_b")))
        dof = dfree
    else:
        va, vb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
        se = F.sqrt(va + vb)
        dof = F.pow(va + vb, 2) / (F.pow(va, 2) / (F.col("n_a") - 1) + F.pow(vb, 2) / (F.col("n_b") - 1))
    out = (pairs.withColumn("t", (F.col("mean_a") - F.col("mean_b")) / se)
           .withColumn("df", dof.cast("double"))
           .withColumn("p_value", t_pvalue_udf(F.col("t"), F.col("df")))
           .drop("var_a", "var_b", "_pool"))
    if p_adjust == "holm":
        out = holm_adjust(out, "p_value", "p_adj")
    return out


def holm_adjust(df: DataFrame, p: str, out: str, num_partitions: int | None = None) -> DataFrame:
    """Holm step-down: the i-th smallest of m p-values times (m - i + 1), running maximum, at most 1.

    The k(k-1)/2 rows of many groups are sorted by range, the maximum is carried over the partitions.  NULL and NaN
    values are not tests: they count nowhere and get NULL."""
    known = F.col(p).isNotNull() & ~F.isnan(p)
    m = df.select(F.count(F.when(known, 1))).scalar()
    ranked = running_max(df.withColumn("_unknown", ~known), ["_unknown", p],
                         lambda i: F.when(known, F.least(F.lit(1.0), (m - i + 1) * F.col(p))), out, num_partitions)
    return ranked.withColumn(out, F.when(known, F.col(out))).drop("_unknown")


def boxplot_stats(df: DataFrame, value: str, group: str, coef: float = 1.5, strategy: str = "range") -> DataFrame:
    """Box-plot numbers per group: quartiles (type 7), whisker ends at the most extreme
    values within ``coef`` IQR of the box, and the outlier count.

    Quartiles come from the skew-safe exact quantile operator; the whisker pass is an
    aggregate over the rows joined to one summary row per group.
    """
    base = df.select(group, value).filter(F.col(value).isNotNull())
    q = exact_quantiles(base, [group], value, [0.25, 0.5, 0.75], ["q1", "median", "q3"], strategy=strategy)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = base.join(q.select(F.col(group).alias("_g"), "q1", "q3", "iqr"), F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
    lo = F.col("q1") - coef * F.col("iqr")
    hi = F.col("q3") + coef * F.col("iqr")
    w = j.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col(value) >= lo, F.col(value))).alias("lower_whisker"),
        F.max(F.when(F.col(value) <= hi, F.col(value))).alias("upper_whisker"),
        F.count(F.when((F.col(value) < lo) | (F.col(value) > hi), 1)).alias("n_outliers"))
    w = w.withColumnRenamed(group, "_g")
    return q.join(w, F.col(group).eqNullSafe(F.col("_g"))).select(group, *[c for c in q.columns if c != group], *[c for c in w.columns if c != "_g"])


def histogram(df: DataFrame, col: str, binwidth: float, name: str = "bin_center") -> DataFrame:
    """Counts per bin; bins are centred on multiples of ``binwidth`` and closed on the right."""
    x = F.col(col)
    center = (F.ceil((x - binwidth / 2.0) / binwidth) * binwidth).cast("double")
    return df.filter(x.isNotNull()).groupBy(center.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def bar_counts(df: DataFrame, col: str) -> DataFrame:
    """Bar heights: rows per value, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(col))


def count_of_counts(df: DataFrame, key: str, name: str = "n_rows") -> DataFrame:
    """How many keys have 1, 2, ... rows (the ratings-per-user bar chart)."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return per.groupBy(name).agg(F.count(F.lit(1)).alias("n_keys"))


def crosstab_long(df: DataFrame, a: str, b: str, values_b: Sequence | None = None) -> DataFrame:
    """R ``table(a, b)`` in long form, zero cells included: (a, b, n).

    Values keep their types, NULL is a value, and no column is named after one.  The values of
    both sides meet tile by tile (the table's own size); no list of a side's values is made.
    """
    cells = df.select(F.col(a).alias("_a"), F.col(b).alias("_b")).groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n"))
    xs = cells.select(F.col("_a").alias("_x_value")).distinct()
    if values_b is not None:
        cells = cells.filter(F.col("_b").isin(list(values_b)))
        listed = F.array(*[F.struct(F.lit(v).cast(df.schema[b].dataType).alias("v")) for v in values_b])
        rows = xs.select("_x_value", F.explode(listed).alias("_y_value")).select("_x_value", F.col("_y_value.v").alias("_y_value"))
    else:
        rows = paired(xs, cells.select(F.col("_b").alias("_y_value")).distinct())
    found = rows.join(cells, F.col("_x_value").eqNullSafe(F.col("_a")) & F.col("_y_value").eqNullSafe(F.col("_b")), "left")
    return found.select(F.col("_x_value").alias(a), F.col("_y_value").alias(b), F.coalesce("_n", F.lit(0)).alias("n"))


def fitted_line(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares slope, intercept and R² of ``y ~ x`` in one aggregate."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))
