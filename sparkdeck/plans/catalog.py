"""Query catalogue: one Spark query per operator of the survey, each paired with the
DuckDB SQL that must give the same rows (``None`` = property-checked only).

Rounding rule for the value hash: computed doubles are rounded on both sides, since
float sums differ in the last bits between engines.  Sums of two-decimal data: 2
places (their exact value has two decimals, so they never sit on a tie).  Means of
two-decimal data: 8 places (6 at money scale) — a mean S/(100 n) can only fall
exactly on a rounding tie at 8 places when n is a multiple of 128.  Other derived
values: 4 places.  Rounding is
written ``round(x * 10^d) / 10^d`` on both sides: the scaling is the same IEEE
operation in both engines, a scaled tie ``k + 0.5`` is exact in binary, so Spark
(which rounds a double through its shortest decimal string) and DuckDB (which
rounds the binary value) agree even on exact decimal ties such as 56.20875.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import code_to_label, indicator, safe_divide, year_from_text
from ..operators.features import (drop_missing, fill_missing, handle_outliers, index_roundtrip,
                                  interpolate_linear, log_gauss)
from ..operators.ordered import rank_within, top_within
from ..operators.splits import block_kfold, holdout_per_key
from ..operators.stats import (boxplot_stats, count_of_counts, crosstab_long, fitted_line, holm_adjust,
                               pairwise_t_test)
from ..operators.verbs import attach_global_stats, group_extremes, join_by, select_range
from ..sources.tables import load_table, materialize, read_parquet

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql.strip() if sql else None)
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return load_table(spark, sf, name)


def rnd(c, places: int):
    """``round(c * 10^places) / 10^places`` — the same arithmetic as the oracle SQL."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** places)
    return F.round(c * F.lit(scale)) / F.lit(scale)


def r4(c):
    return rnd(c, 4)


def r2(c):
    return rnd(c, 2)


def _day(col: str = "o_orderdate"):
    return F.date_format(col, "yyyy-MM-dd")


# ---------------------------------------------------------------- windows (W)

@query("daily_best_worst", """
WITH d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS o_day, o_orderkey, o_totalprice FROM orders),
m AS (SELECT o_day, min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM d GROUP BY o_day)
SELECT d.o_day, d.o_orderkey, d.o_totalprice FROM d JOIN m ON d.o_day = m.o_day
WHERE d.o_totalprice = m.mn OR d.o_totalprice = m.mx
""")
def daily_best_worst(spark, sf):
    """W-01, P-09, P-10: each day's cheapest and dearest orders, ties kept."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice", _day().alias("o_day"))
    return group_extremes(o, ["o_day"], "o_totalprice").select("o_day", "o_orderkey", "o_totalprice")


@query("daily_rank", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS o_day, o_orderkey, o_totalprice,
       rank() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m-%d') ORDER BY o_totalprice DESC NULLS LAST) AS rank
FROM orders
""")
def daily_rank(spark, sf):
    """W-02, O-02: rank within day, descending, ties share, gaps left."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice", _day().alias("o_day"))
    return rank_within(o, ["o_day"], [("o_totalprice", False)], name="rank") \
        .select("o_day", "o_orderkey", "o_totalprice", "rank")


@query("top2_per_supplier", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity, l_discount, rank FROM (
  SELECT l_orderkey, l_suppkey, l_linenumber, l_quantity, l_discount,
         rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC NULLS LAST) AS rank
  FROM lineitem) t
WHERE rank <= 2 AND l_discount > 0
""")
def top2_per_supplier(spark, sf):
    """W-03, P-02: rank over all rows of the supplier first, then both predicates."""
    li = select_range(_t(spark, sf, "lineitem"), "l_orderkey", "l_discount").drop("l_partkey", "l_extendedprice")
    r = top_within(li, ["l_suppkey"], [("l_quantity", False)], 2)
    return r.filter(F.col("l_discount") > 0) \
        .select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "rank")


@query("part_price_vs_global", """
SELECT p_partkey, p_retailprice,
       (round(((SELECT avg(p_retailprice) FROM part)) * 1e8) / 1e8) AS mean_price,
       (round(((SELECT median(p_retailprice) FROM part)) * 1e4) / 1e4) AS median_price
FROM part
""")
def part_price_vs_global(spark, sf):
    """W-04, A-14: every part with the global mean and exact median price."""
    p = _t(spark, sf, "part").select("p_partkey", "p_retailprice")
    g = attach_global_stats(p, "p_retailprice", "mean_price", "median_price")
    return g.select("p_partkey", "p_retailprice", rnd("mean_price", 8).alias("mean_price"),
                    r4("median_price").alias("median_price"))


# ---------------------------------------------------------------- verbs (P, E, O)

@query("verb_chain", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity, l_extendedprice,
       l_extendedprice / l_quantity AS unit_price
FROM lineitem
WHERE month(l_shipdate) = 5 AND day(l_shipdate) = 17 AND l_returnflag IN ('A', 'R')
ORDER BY l_returnflag, l_orderkey, l_linenumber
""")
def verb_chain(spark, sf):
    """P-01, P-04, P-06, P-11, E-01, E-05, O-01: filter, select, arrange, mutate."""
    li = _t(spark, sf, "lineitem")
    c1 = li.filter((F.month("l_shipdate") == 5) & (F.dayofmonth("l_shipdate") == 17)
                   & F.col("l_returnflag").isin("A", "R"))
    c2 = c1.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    c3 = c2.orderBy("l_returnflag", "l_orderkey", "l_linenumber")
    # one IEEE division gives the same double in both engines: no rounding needed
    return c3.withColumn("unit_price", safe_divide("l_extendedprice", "l_quantity"))


@query("select_range_drop", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_range_drop(spark, sf):
    """P-02, P-03: a column range, then drop one column."""
    return select_range(_t(spark, sf, "orders"), "o_orderkey", "o_totalprice").drop("o_orderstatus")


@query("filters_null", """
SELECT o_orderkey, o_orderstatus, o_orderpriority, price FROM (
  SELECT o_orderkey, o_orderstatus, o_orderpriority,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS price FROM orders) t
WHERE price IS NOT NULL AND o_orderstatus <> 'P' AND (price >= 100000 OR NOT (o_orderpriority = '1-URGENT'))
""")
def filters_null(spark, sf):
    """P-05, P-07, E-03, E-04, E-06: not-missing, !=, OR and NOT filters over made NULLs."""
    o = _t(spark, sf, "orders").withColumn(
        "price", F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_totalprice")))
    return o.filter(F.col("price").isNotNull() & (F.col("o_orderstatus") != "P")
                    & ((F.col("price") >= 100000) | ~(F.col("o_orderpriority") == "1-URGENT"))) \
        .select("o_orderkey", "o_orderstatus", "o_orderpriority", "price")


@query("year_from_text", """
SELECT o_orderkey, release_date, nchar, year, 1998 - year AS age FROM (
  SELECT o_orderkey, release_date, CAST(length(release_date) AS BIGINT) AS nchar,
         TRY_CAST(CASE WHEN y = '' THEN '1900' ELSE y END AS INTEGER) AS year
  FROM (SELECT o_orderkey, release_date,
               CASE WHEN length(release_date) >= 4 THEN substr(release_date, length(release_date) - 3, 4)
                    ELSE release_date END AS y
        FROM (SELECT o_orderkey, CASE WHEN o_orderpriority = '3-MEDIUM' THEN ''
                                      ELSE strftime(o_orderdate, '%d-%b-%Y') END AS release_date
              FROM orders) a) b) c
WHERE year <> 1900
""")
def year_from_text_q(spark, sf):
    """E-07..E-11, P-04: year = last four characters of a date text, '' -> 1900, drop 1900."""
    o = _t(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(""))
        .otherwise(F.date_format("o_orderdate", "dd-MMM-yyyy")).alias("release_date"))
    o = o.withColumn("nchar", F.length("release_date").cast("long")).withColumn("year", year_from_text("release_date"))
    return o.filter(F.col("year") != 1900).withColumn("age", F.lit(1998) - F.col("year"))


@query("code_to_label", """
SELECT doc_id, toxic, toxic_label, CAST(toxic_label = 'Toxic' AS DOUBLE) AS binary_response FROM (
  SELECT doc_id, toxic, CASE WHEN toxic = 0 THEN 'Non-Toxic' WHEN toxic = 1 THEN 'Toxic' END AS toxic_label
  FROM labels) t
""")
def code_to_label_q(spark, sf):
    """E-12, E-13, F-05: codes to factor labels, then a 0/1 double response."""
    lb = _t(spark, sf, "labels").select(
        "doc_id", "toxic", code_to_label("toxic", [0, 1], ["Non-Toxic", "Toxic"]).alias("toxic_label"))
    return lb.withColumn("binary_response", indicator("toxic_label", "Toxic"))


@query("math_functions", """
SELECT p_partkey, k, (round((pow(p_retailprice, 2)) * 1e2) / 1e2) AS price_sq, (round((ln(p_retailprice)) * 1e4) / 1e4) AS price_ln,
       (round((p_retailprice * k * 0.01) * 1e4) / 1e4) AS scaled
FROM part, range(1, 4) AS s(k)
""")
def math_functions(spark, sf):
    """E-02, E-15, E-16: power, log and an exploded number sequence."""
    p = _t(spark, sf, "part").select("p_partkey", "p_retailprice",
                                     F.explode(F.sequence(F.lit(1), F.lit(3))).alias("k"))
    p = p.withColumn("k", F.col("k").cast("long"))
    return p.select("p_partkey", "k", r2(F.pow("p_retailprice", 2)).alias("price_sq"),
                    r4(F.log("p_retailprice")).alias("price_ln"),
                    r4(F.col("p_retailprice") * F.col("k") * F.lit(0.01)).alias("scaled"))


# ---------------------------------------------------------------- aggregates (A)

@query("global_mean", "SELECT (round((avg(value)) * 1e8) / 1e8) AS mean_value FROM events")
def global_mean(spark, sf):
    """A-01."""
    return _t(spark, sf, "events").agg(rnd(F.avg("value"), 8).alias("mean_value"))


@query("global_profile", """
SELECT n, mean_value, max_value, min_value, sum_value, sd_value, n_users, n_types,
       (round((n / n_users) * 1e4) / 1e4) AS events_per_user, (round((n / n_types) * 1e4) / 1e4) AS events_per_type
FROM (SELECT count(*) AS n, (round((avg(value)) * 1e8) / 1e8) AS mean_value, max(value) AS max_value,
             min(value) AS min_value, (round((sum(value)) * 1e2) / 1e2) AS sum_value, (round((stddev_samp(value)) * 1e4) / 1e4) AS sd_value,
             count(DISTINCT user_id) AS n_users, count(DISTINCT event_type) AS n_types FROM events) t
""")
def global_profile(spark, sf):
    """A-06, A-07, A-08, A-17: count, mean, max, min, sum, SD, distincts and their ratios."""
    e = _t(spark, sf, "events").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("value"), 8).alias("mean_value"), F.max("value").alias("max_value"),
        F.min("value").alias("min_value"), r2(F.sum("value")).alias("sum_value"),
        r4(F.stddev_samp("value")).alias("sd_value"), F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("event_type").alias("n_types"))
    return e.withColumn("events_per_user", r4(F.col("n") / F.col("n_users"))) \
        .withColumn("events_per_type", r4(F.col("n") / F.col("n_types")))


@query("multi_distinct", """
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT event_type) AS n_types,
       count(DISTINCT props) AS n_props FROM events
""")
def multi_distinct(spark, sf):
    """A-04: several exact distinct counts in one aggregate (Catalyst expands them)."""
    return _t(spark, sf, "events").agg(F.countDistinct("user_id").alias("n_users"),
                                       F.countDistinct("event_type").alias("n_types"),
                                       F.countDistinct("props").alias("n_props"))


@query("group_mean_count", """
SELECT user_id, count(*) AS n, (round((sum(value)) * 1e2) / 1e2) AS sum_value, (round((avg(value)) * 1e8) / 1e8) AS mean_value
FROM events GROUP BY user_id
""")
def group_mean_count(spark, sf):
    """A-02, A-10: per-user count, sum and mean."""
    return _t(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), r2(F.sum("value")).alias("sum_value"), rnd(F.avg("value"), 8).alias("mean_value"))


@query("having_delay", """
SELECT l_partkey, n, (round((mean_qty) * 1e4) / 1e4) AS mean_qty, (round((mean_discount) * 1e8) / 1e8) AS mean_discount FROM (
  SELECT l_partkey, count(*) AS n, avg(l_quantity) AS mean_qty, avg(l_discount) AS mean_discount
  FROM lineitem GROUP BY l_partkey) t
WHERE n > 20 AND mean_qty < 30 AND mean_discount IS NOT NULL
""")
def having_delay(spark, sf):
    """A-03, P-08, G-08: group count and two means, then HAVING on all three."""
    g = _t(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("mean_qty"), F.avg("l_discount").alias("mean_discount"))
    g = g.filter((F.col("n") > 20) & (F.col("mean_qty") < 30) & F.col("mean_discount").isNotNull())
    return g.select("l_partkey", "n", r4("mean_qty").alias("mean_qty"), rnd("mean_discount", 8).alias("mean_discount"))


@query("count_sorted_having", """
SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey HAVING count(*) > 55 ORDER BY n DESC
""")
def count_sorted_having(spark, sf):
    """A-05, A-09, A-11, A-12, O-05: count by value, keep counts above a limit, most frequent first."""
    return _t(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") > 55).orderBy(F.desc("n"))


@query("crosstab_long", """
WITH f AS (SELECT DISTINCT l_returnflag FROM lineitem), s AS (SELECT DISTINCT l_linestatus FROM lineitem),
c AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT f.l_returnflag, s.l_linestatus, coalesce(c.n, 0) AS n
FROM f CROSS JOIN s LEFT JOIN c ON c.l_returnflag = f.l_returnflag AND c.l_linestatus = s.l_linestatus
""")
def crosstab_long_q(spark, sf):
    """A-13: two-way frequency table with zero cells."""
    return crosstab_long(_t(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("filtered_mean", "SELECT (round((avg(o_totalprice)) * 1e6) / 1e6) AS mean_price FROM orders WHERE o_orderstatus = 'F'")
def filtered_mean(spark, sf):
    """A-15: mean of a filtered column."""
    return _t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").agg(
        rnd(F.avg("o_totalprice"), 6).alias("mean_price"))


@query("mse_constant", """
WITH g AS (SELECT l_returnflag, avg(l_quantity) AS gm FROM lineitem GROUP BY 1)
SELECT l.l_returnflag, (round((avg(pow(l.l_quantity - g.gm, 2))) * 1e4) / 1e4) AS mse
FROM lineitem l JOIN g ON l.l_returnflag = g.l_returnflag GROUP BY l.l_returnflag
""")
def mse_constant(spark, sf):
    """A-16: mean squared distance to the group mean."""
    return _t(spark, sf, "lineitem").groupBy("l_returnflag").agg(r4(F.var_pop("l_quantity")).alias("mse"))


# ---------------------------------------------------------------- joins (J)

_JOIN_SQL = """
SELECT o.o_custkey, o.o_orderkey, o.o_orderstatus, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING') c
ON o.o_custkey = c.c_custkey
"""


def _join_inputs(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    c = _t(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING") \
        .select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return o, c


@query("join_natural", _JOIN_SQL)
def join_natural(spark, sf):
    """J-01: left join on all shared names."""
    o, c = _join_inputs(spark, sf)
    return join_by(o, c)


@query("join_key", _JOIN_SQL)
def join_key(spark, sf):
    """J-02: left join on a named key; the key appears once."""
    o, c = _join_inputs(spark, sf)
    return join_by(o, c, "o_custkey")


@query("join_key_list", _JOIN_SQL)
def join_key_list(spark, sf):
    """J-03: a key list with a repeat counts the key once."""
    o, c = _join_inputs(spark, sf)
    return join_by(o, c, ["o_custkey", "o_custkey"])


@query("join_kinds", """
WITH c AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'),
o AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F')
SELECT 'inner' AS kind, count(*) AS n_rows FROM c JOIN o ON c.c_custkey = o.o_custkey
UNION ALL SELECT 'left', count(*) FROM c LEFT JOIN o ON c.c_custkey = o.o_custkey
UNION ALL SELECT 'right', count(*) FROM c RIGHT JOIN o ON c.c_custkey = o.o_custkey
UNION ALL SELECT 'full', count(*) FROM c FULL JOIN o ON c.c_custkey = o.o_custkey
UNION ALL SELECT 'semi', count(*) FROM c WHERE EXISTS (SELECT 1 FROM o WHERE o.o_custkey = c.c_custkey)
UNION ALL SELECT 'anti', count(*) FROM c WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.o_custkey = c.c_custkey)
""")
def join_kinds(spark, sf):
    """J-04, J-05: inner, left, right, full, semi and anti joins (row counts)."""
    c = _t(spark, sf, "customer").filter(F.col("c_mktsegment") != "BUILDING").select("c_custkey")
    o = _t(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")
    cond = c["c_custkey"] == o["o_custkey"]
    out = None
    for kind, how in [("inner", "inner"), ("left", "left"), ("right", "right"), ("full", "full"),
                      ("semi", "left_semi"), ("anti", "left_anti")]:
        one = c.join(o, cond, how).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(kind).alias("kind"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- set operations (T)

@query("set_ops", """
SELECT 'union' AS op, nationkey FROM (SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 0) a
UNION ALL SELECT 'union_all', nationkey FROM (SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier WHERE s_acctbal > 0) b
UNION ALL SELECT 'intersect', nationkey FROM (SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0) c
UNION ALL SELECT 'except', nationkey FROM (SELECT c_nationkey AS nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0) d
""")
def set_ops(spark, sf):
    """T-02: union (set and all), intersect, difference."""
    cn = _t(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    sn = _t(spark, sf, "supplier").filter(F.col("s_acctbal") > 0).select(F.col("s_nationkey").alias("nationkey"))
    parts = {"union": cn.union(sn).distinct(), "union_all": cn.union(sn),
             "intersect": cn.intersect(sn), "except": cn.subtract(sn)}
    out = None
    for op, d in parts.items():
        one = d.select(F.lit(op).alias("op"), "nationkey")
        out = one if out is None else out.unionByName(one)
    return out


@query("distinct_rows", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_rows(spark, sf):
    """T-01."""
    return _t(spark, sf, "customer").select("c_nationkey", "c_mktsegment").distinct()


# ---------------------------------------------------------------- catalog and SQL (S, O)

@query("sql_limit", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def sql_limit(spark, sf):
    """S-05, S-10, O-03: read parquet as a named table, then SQL with ORDER BY ... LIMIT."""
    read_parquet(spark, f"{sf.rstrip('/')}/orders.parquet", name="orders_tbl")
    return spark.sql("SELECT o_orderkey, o_custkey, o_totalprice FROM orders_tbl "
                     "ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")


@query("table_roundtrip", """
SELECT l_returnflag, l_linestatus, n, revenue FROM (
  SELECT l_returnflag, l_linestatus, count(*) AS n, (round((sum(l_extendedprice)) * 1e2) / 1e2) AS revenue
  FROM lineitem GROUP BY 1, 2) t
ORDER BY revenue DESC LIMIT 1
""")
def table_roundtrip(spark, sf):
    """S-01, S-09, S-11, O-04: materialise a query as a table, look it up, take the best row."""
    agg = _t(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), r2(F.sum("l_extendedprice")).alias("revenue"))
    materialize(agg, "flag_status_summary")
    return spark.table("flag_status_summary").orderBy(F.desc("revenue")).limit(1)


# ---------------------------------------------------------------- splits (X)

@query("block_kfold", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx,
       CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) * 5 / (SELECT count(*) FROM orders)) + 1 AS BIGINT) AS fold
FROM orders
""")
def block_kfold_q(spark, sf):
    """X-05, X-07: fold i = i-th contiguous block of the key order, k = 5."""
    return block_kfold(_t(spark, sf, "orders").select("o_orderkey"), 5, ["o_orderkey"])


_HOLDOUT_SQL = """
WITH p AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos FROM events),
q AS (SELECT *, CASE WHEN pos BETWEEN 1 AND 10
                     THEN row_number() OVER (PARTITION BY pos BETWEEN 1 AND 10 ORDER BY event_id) END AS qn FROM p)
SELECT event_id, user_id, pos, CASE WHEN qn IS NOT NULL AND {cap} THEN 'test' ELSE 'base' END AS split FROM q
"""


@query("holdout_per_user", _HOLDOUT_SQL.format(cap="TRUE"))
def holdout_per_user(spark, sf):
    """X-06: the first ten events of every user go to test, the rest to base."""
    return holdout_per_key(_t(spark, sf, "events").select("event_id", "user_id"), "user_id", ["event_id"], 1, 10)


@query("holdout_capped", _HOLDOUT_SQL.format(cap="qn <= 500"))
def holdout_capped(spark, sf):
    """X-06 with a cap: at most 500 test rows, taken in event order."""
    return holdout_per_key(_t(spark, sf, "events").select("event_id", "user_id"), "user_id", ["event_id"], 1, 10,
                           max_test=500)


# ---------------------------------------------------------------- statistics (G)

@query("pairwise_t", """
WITH g AS (SELECT c_mktsegment AS grp, count(c_acctbal) AS n, avg(c_acctbal) AS mean, var_samp(c_acctbal) AS var
           FROM customer WHERE c_acctbal IS NOT NULL GROUP BY 1),
p AS (SELECT sum((n - 1) * var) / (sum(n) - count(*)) AS sp2, CAST(sum(n) - count(*) AS DOUBLE) AS dof FROM g)
SELECT a.grp AS group_a, b.grp AS group_b, a.n AS n_a, b.n AS n_b, (round((a.mean) * 1e4) / 1e4) AS mean_a,
       (round((b.mean) * 1e4) / 1e4) AS mean_b, (round(((a.mean - b.mean) / sqrt(p.sp2 * (1.0 / a.n + 1.0 / b.n))) * 1e4) / 1e4) AS t,
       p.dof AS df
FROM g a JOIN g b ON a.grp < b.grp CROSS JOIN p
""")
def pairwise_t(spark, sf):
    """G-01 (n, means, t, df; p-values in ``pairwise_t_holm``)."""
    r = pairwise_t_test(_t(spark, sf, "customer"), "c_acctbal", "c_mktsegment", p_adjust=None)
    return r.select("group_a", "group_b", "n_a", "n_b", r4("mean_a").alias("mean_a"), r4("mean_b").alias("mean_b"),
                    r4("t").alias("t"), "df")


@query("pairwise_t_holm", None)
def pairwise_t_holm(spark, sf):
    """G-01 with two-sided p-values and the Holm adjustment (property-checked)."""
    return pairwise_t_test(_t(spark, sf, "customer"), "c_acctbal", "c_mktsegment", p_adjust="holm")


@query("holm_steps", """
WITH p AS (SELECT o_orderkey, o_totalprice * 1e-10 AS p FROM orders),
r AS (SELECT *, row_number() OVER (ORDER BY p, o_orderkey) AS i, count(*) OVER () AS m FROM p WHERE p IS NOT NULL)
SELECT o_orderkey, p, max(least(1.0, (m - i + 1) * p)) OVER (ORDER BY i) AS p_adj FROM r
UNION ALL SELECT o_orderkey, p, NULL FROM p WHERE p IS NULL
""")
def holm_steps(spark, sf):
    """G-01: Holm's step-down over one value a row of a whole table (a scaled price stands for the p-value)."""
    return holm_adjust(_t(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") * F.lit(1e-10)).alias("p")), "p", "p_adj")


@query("boxplot_by_group", """
WITH q AS (SELECT c_mktsegment, quantile_cont(c_acctbal, 0.25) AS q1, median(c_acctbal) AS median,
                  quantile_cont(c_acctbal, 0.75) AS q3 FROM customer WHERE c_acctbal IS NOT NULL GROUP BY 1),
j AS (SELECT c.c_mktsegment, c.c_acctbal AS x, q.q1, q.q3, q.q3 - q.q1 AS iqr
      FROM customer c JOIN q ON c.c_mktsegment = q.c_mktsegment WHERE c.c_acctbal IS NOT NULL)
SELECT q.c_mktsegment, (round((q.q1) * 1e4) / 1e4) AS q1, (round((q.median) * 1e4) / 1e4) AS median, (round((q.q3) * 1e4) / 1e4) AS q3,
       (round((q.q3 - q.q1) * 1e4) / 1e4) AS iqr, w.n, w.lower_whisker, w.upper_whisker, w.n_outliers
FROM q JOIN (SELECT c_mktsegment, count(*) AS n,
                    min(CASE WHEN x >= q1 - 1.5 * iqr THEN x END) AS lower_whisker,
                    max(CASE WHEN x <= q3 + 1.5 * iqr THEN x END) AS upper_whisker,
                    count(CASE WHEN x < q1 - 1.5 * iqr OR x > q3 + 1.5 * iqr THEN 1 END) AS n_outliers
             FROM j GROUP BY 1) w ON q.c_mktsegment = w.c_mktsegment
""")
def boxplot_by_group(spark, sf):
    """G-02: box-plot numbers of account balance by segment."""
    b = boxplot_stats(_t(spark, sf, "customer"), "c_acctbal", "c_mktsegment")
    return b.select("c_mktsegment", r4("q1").alias("q1"), r4("median").alias("median"), r4("q3").alias("q3"),
                    r4("iqr").alias("iqr"), "n", "lower_whisker", "upper_whisker", "n_outliers")


@query("histogram_w5", """
SELECT CAST(ceil((p_size - 2.5) / 5) * 5 AS DOUBLE) AS bin_center, count(*) AS n FROM part
WHERE p_size IS NOT NULL GROUP BY 1
""")
def histogram_w5(spark, sf):
    """G-03: counts in bins of width 5 centred on multiples of 5."""
    from ..operators.stats import histogram
    return histogram(_t(spark, sf, "part"), "p_size", 5)


@query("count_of_counts", """
SELECT n_orders, count(*) AS n_keys FROM (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) t GROUP BY 1
""")
def count_of_counts_q(spark, sf):
    """G-04: how many customers have 1, 2, ... orders."""
    return count_of_counts(_t(spark, sf, "orders"), "o_custkey", "n_orders")


@query("fitted_line", """
SELECT (round((regr_slope(l_extendedprice, l_quantity)) * 1e4) / 1e4) AS slope,
       (round((regr_intercept(l_extendedprice, l_quantity)) * 1e2) / 1e2) AS intercept,
       (round((regr_r2(l_extendedprice, l_quantity)) * 1e6) / 1e6) AS r2,
       CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n
FROM lineitem
""")
def fitted_line_q(spark, sf):
    """G-05: slope and intercept of the fitted line in one aggregate."""
    f = fitted_line(_t(spark, sf, "lineitem"), "l_extendedprice", "l_quantity")
    return f.select(r4("slope").alias("slope"), r2("intercept").alias("intercept"),
                    rnd("r2", 6).alias("r2"), "n")


# ---------------------------------------------------------------- features (F)

def _events_with_gaps(spark, sf) -> DataFrame:
    """``events.value`` with NULLs where the second of the stamp is below 6 (about 10 %)."""
    e = _t(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return e.withColumn("value", F.when(F.second("ts") < 6, F.lit(None)).otherwise(F.col("value")))


_GAPS = "(SELECT event_id, user_id, ts, CASE WHEN second(ts) < 6 THEN NULL ELSE value END AS value FROM events)"


@query("string_index", """
WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY n DESC, o_orderpriority) - 1 AS DOUBLE) AS priority_idx,
       o_orderpriority AS priority_remap, n FROM c
""")
def string_index_q(spark, sf):
    """F-01..F-03: index by frequency (ties by name) and back, chained in one pipeline."""
    o = _t(spark, sf, "orders").select("o_orderpriority")
    r = index_roundtrip(o, "o_orderpriority", "priority_idx", "priority_remap")
    return r.groupBy("o_orderpriority", "priority_idx", "priority_remap").agg(F.count(F.lit(1)).alias("n"))


@query("drop_missing", f"SELECT event_id, value FROM {_GAPS} g WHERE value IS NOT NULL")
def drop_missing_q(spark, sf):
    """F-06: drop records with a missing value."""
    return drop_missing(_events_with_gaps(spark, sf), ["value"]).select("event_id", "value")


@query("drop_fill", f"""
SELECT event_id, coalesce(value, 0.0) AS fill_zero,
       (round((coalesce(value, (SELECT avg(value) FROM {_GAPS} a))) * 1e8) / 1e8) AS fill_mean,
       (round((coalesce(value, (SELECT median(value) FROM {_GAPS} b))) * 1e4) / 1e4) AS fill_median
FROM {_GAPS} g
""")
def drop_fill(spark, sf):
    """F-07: fill missing with zero, the mean or the exact median."""
    e = _events_with_gaps(spark, sf)
    e = fill_missing(e, "value", "zero", "fill_zero")
    e = fill_missing(e, "value", "mean", "fill_mean")
    e = fill_missing(e, "value", "median", "fill_median")
    return e.select("event_id", "fill_zero", rnd("fill_mean", 8).alias("fill_mean"),
                    r4("fill_median").alias("fill_median"))


@query("interpolate", f"""
WITH b AS (SELECT event_id, user_id, ts, value, CAST(epoch_us(ts) AS DOUBLE) AS t FROM {_GAPS} g),
w AS (SELECT *,
  last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  last_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pt,
  first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
  first_value(CASE WHEN value IS NOT NULL THEN t END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nt
  FROM b)
SELECT event_id, user_id, (round((CASE WHEN value IS NOT NULL THEN value
  WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * (CASE WHEN nt = pt THEN 0.0 ELSE (t - pt) / (nt - pt) END)
  ELSE coalesce(pv, nv) END) * 1e4) / 1e4) AS value_interp
FROM w
""")
def interpolate(spark, sf):
    """F-08: linear interpolation in time within each user's series."""
    e = interpolate_linear(_events_with_gaps(spark, sf), ["user_id"], "ts", "value", "value_interp", tiebreak="event_id")
    return e.select("event_id", "user_id", r4("value_interp").alias("value_interp"))


@query("clip_outliers", f"""
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM {_GAPS} a),
f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT event_id, (round((CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END) * 1e4) / 1e4) AS value_clipped
FROM {_GAPS} g CROSS JOIN f
""")
def clip_outliers(spark, sf):
    """F-09: clip values to the IQR fences (NULL stays NULL)."""
    e = handle_outliers(_events_with_gaps(spark, sf), "value", "clip", out="value_clipped")
    return e.select("event_id", r4("value_clipped").alias("value_clipped"))


@query("log_gauss", f"""
WITH s AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd FROM {_GAPS} a)
SELECT event_id, (round((ln(1 + value)) * 1e4) / 1e4) AS value_log1p,
       (round((exp(-pow(value - mu, 2) / (2.0 * pow(sd, 2)))) * 1e4) / 1e4) AS value_gauss
FROM {_GAPS} g CROSS JOIN s
""")
def log_gauss_q(spark, sf):
    """F-11: log and Gaussian-kernel transforms."""
    e = log_gauss(_events_with_gaps(spark, sf), "value")
    return e.select("event_id", r4("value_log1p").alias("value_log1p"), r4("value_gauss").alias("value_gauss"))


# ---------------------------------------------------------------- further registrations
# The range plan is the only one that the catalogue runs now; these names stay for the record of earlier rounds.

@query("daily_rank_scan", REGISTRY["daily_rank"][1])
def daily_rank_scan(spark, sf):
    """W-02 through the skew-safe scan."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice", _day().alias("o_day"))
    return rank_within(o, ["o_day"], [("o_totalprice", False)], name="rank", strategy="scan") \
        .select("o_day", "o_orderkey", "o_totalprice", "rank")


@query("holdout_capped_scan", REGISTRY["holdout_capped"][1])
def holdout_capped_scan(spark, sf):
    """X-06 with a cap, both orderings (per user and global) through the scan."""
    return holdout_per_key(_t(spark, sf, "events").select("event_id", "user_id"), "user_id", ["event_id"], 1, 10,
                           max_test=500, strategy="scan")


@query("boxplot_by_group_scan", REGISTRY["boxplot_by_group"][1])
def boxplot_by_group_scan(spark, sf):
    """G-02 with the exact quartiles from the scan."""
    b = boxplot_stats(_t(spark, sf, "customer"), "c_acctbal", "c_mktsegment", strategy="scan")
    return b.select("c_mktsegment", r4("q1").alias("q1"), r4("median").alias("median"), r4("q3").alias("q3"),
                    r4("iqr").alias("iqr"), "n", "lower_whisker", "upper_whisker", "n_outliers")


@query("interpolate_scan", REGISTRY["interpolate"][1])
def interpolate_scan(spark, sf):
    """F-08 through the scan: running non-NULL counts and equi-joins on (user, k)."""
    e = interpolate_linear(_events_with_gaps(spark, sf), ["user_id"], "ts", "value", "value_interp",
                           tiebreak="event_id", strategy="scan")
    return e.select("event_id", "user_id", r4("value_interp").alias("value_interp"))
