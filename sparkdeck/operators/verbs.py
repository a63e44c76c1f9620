"""Column selection by range / position, joins by shared names, grouped extremes and
global statistics attached to rows (P-02, P-03, J-01..J-05, W-01, W-04).

Where Spark already has the verb (select, filter, withColumn, orderBy, join,
distinct, union...) it is used directly in the query catalogue; only the shapes
Spark has no single call for live here.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import exact_median


def select_range(df: DataFrame, first: str, last: str, *extra: str) -> DataFrame:
    """``select(a:b, ...)``: every column from ``first`` to ``last`` in table order."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    return df.select(*cols[i:j + 1], *extra)


def select_positions(df: DataFrame, start: int, stop: int) -> DataFrame:
    """``select(3:4)``: 1-based, inclusive positions."""
    return df.select(*df.columns[start - 1:stop])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in right.columns]


def join_by(left: DataFrame, right: DataFrame, by: Sequence[str] | str | None = None,
            how: str = "left") -> DataFrame:
    """dplyr-style join: ``by=None`` joins on all shared names; repeated keys count once.

    The key list is passed as names, so each key appears once in the output (USING
    form).  The physical strategy is Spark's: AQE turns the join into a broadcast
    when the runtime size of a side is under the threshold, and splits skewed
    partitions otherwise.
    """
    if by is None:
        keys = shared_columns(left, right)
    else:
        keys = [by] if isinstance(by, str) else list(dict.fromkeys(by))
    return left.join(right, on=keys, how=how)


def group_extremes(df: DataFrame, keys: Sequence[str], value: str, which: str = "both") -> DataFrame:
    """Rows equal to their group's min or max of ``value`` (ties kept) — W-01.

    Written as aggregate-then-join instead of a window: the aggregate combines map
    side, so a hot group costs one partial row per task; the join back is an
    equi-join on the keys that AQE broadcasts (one row per group) or splits when skewed.
    """
    keys = list(keys)
    ext = df.groupBy(*keys).agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    cond = {"min": F.col(value) == F.col("_mn"), "max": F.col(value) == F.col("_mx"),
            "both": (F.col(value) == F.col("_mn")) | (F.col(value) == F.col("_mx"))}[which]
    ext = ext.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_mn", "_mx")
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)))    # a NULL key is a group
    return df.join(ext, same, "inner").filter(cond).drop("_mn", "_mx", *[f"_k{i}" for i in range(len(keys))])


def global_value(agg_df: DataFrame) -> Column:
    """A one-row, one-column frame as a scalar subquery column (computed once, no join)."""
    return agg_df.scalar()


def attach_global_stats(df: DataFrame, value: str, mean: str | None = "mean",
                        median: str | None = "median") -> DataFrame:
    """Every row with the table-wide mean and exact median of ``value`` — W-04.

    An empty ``Window.partitionBy()`` would move the whole table into one task; the
    statistics are scalar subqueries instead (one aggregate, one exact median).
    """
    out = df
    if mean:
        out = out.withColumn(mean, global_value(df.select(F.avg(value))))
    if median:
        out = out.withColumn(median, global_value(exact_median(df, [], value, name="_m")))
    return out


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct counts of several columns in one aggregate (A-04).

    Exact by default (Catalyst expands several exact distincts into one shuffle);
    ``approx=True`` uses HyperLogLog++ sketches, which merge map side and keep a
    fixed-size state per column however many values there are.
    """
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(f"n_{c}") for c in cols])
    return df.agg(*[F.countDistinct(c).alias(f"n_{c}") for c in cols])


#: Rows of either side in a tile of ``paired``.
TILE_ROWS = 1000


def paired(left: DataFrame, right: DataFrame, on: Column | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Every row of one summary beside every row of the other (where ``on`` holds), as an equi-join of tiles.

    For tables of one row a group or a class whose pairs are the result itself.  Each side is dealt into blocks of about
    ``tile_rows`` by a hash of its rows; a row goes to the tiles of its block, so a pair meets once and a task holds tiles, never a whole side."""
    def blocks(d: DataFrame) -> Column:
        return d.select(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / tile_rows)).cast("long")).scalar()
    n, m = blocks(left), blocks(right)
    each = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), k - 1))
    a = left.withColumn("_x", F.pmod(F.xxhash64(*left.columns), n)).withColumn("_y", each(m))
    b = right.withColumn("_y_r", F.pmod(F.xxhash64(*right.columns), m)).withColumn("_x_r", each(n))
    same = (F.col("_x") == F.col("_x_r")) & (F.col("_y") == F.col("_y_r"))
    return a.join(b, same if on is None else same & on).drop("_x", "_y", "_x_r", "_y_r")
