"""Positions, ranks, running sums, top-k and exact quantiles within groups, whatever the size of a group.

``Window.partitionBy(g).orderBy(v)`` puts every row of a group into one task, so a group holding a third of the
data becomes one straggler (and an empty ``partitionBy`` puts the whole table into one task).  Here there is one plan at
every size, JVM operators only:

* **Numbering.** Rows are range-partitioned and sorted by (keys, order, row hash).  A group is then a run of neighbouring
  rows, cut into *pieces* by the partition bounds; a row's place within its partition is known from the sort.  One
  aggregate gives each piece's length, and what lies before a piece within its group is a running sum over the few
  pieces of that group (over the partitions, in two levels, for a global numbering).  The row hash breaks ties, so one
  repeated value is split as well, and equal rows alone may change places.
* **Ranks** are numbered on the distinct values with their counts and joined back to the rows.
* **Top-k** keeps the k best distinct values a group, which Spark's group limit cuts in every task before the shuffle.
* **Quantiles** count buckets between a group's extremes, narrow twice to the buckets that hold the wanted
  positions, and sort only the distinct values inside those.

The two readers of a range exchange share it (``ReusedExchange``); a hash over all columns is part of each row's place so that
column pruning cannot make them differ.  Where exchange reuse is switched off the sorted input is persisted.

``strategy="window"`` asks for Spark's own window instead (one task a group); nothing chooses it by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions

OrderSpec = str | tuple[str, bool]   # "col" (ascending) or ("col", ascending)


def _norm_order(order: Sequence[OrderSpec]) -> list[tuple[str, bool]]:
    out = []
    for o in order:
        if isinstance(o, str):
            out.append((o[1:], False) if o.startswith("-") else (o, True))
        else:
            out.append((o[0], bool(o[1])))
    return out


def _sort_exprs(keys: Sequence[str], order: list[tuple[str, bool]], tiebreak: str | None) -> list[Column]:
    # ascending puts NULLs first and descending puts them last (Spark and SQL defaults)
    ex = [F.col(k).asc_nulls_first() for k in keys]
    ex += [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]
    if tiebreak:
        ex.append(F.col(tiebreak).asc())
    return ex


TARGET_PARTITION_BYTES_CONF = "spark.sparkdeck.scanPartitionBytes"
DEFAULT_TARGET_PARTITION_BYTES = 256 * 1024 * 1024
MAX_SCAN_PARTITIONS = 200_000


def _estimated_bytes(plan) -> int:
    """The optimiser's size of a plan, but a join counts as the sum of its sides.

    Without column statistics the optimiser takes a join for the product of its sides: rows joined to a table of their own
    pieces would grow with the square of the input."""
    def own(p) -> int:
        return int(str(p.stats().sizeInBytes()))
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    if len(below) != 1:
        return sum(map(_estimated_bytes, below)) if below else own(plan)
    child = _estimated_bytes(below[0])
    if plan.nodeName().endswith("Limit"):
        return min(child, own(plan))
    return child * own(plan) // max(1, own(below[0]))


def scan_partitions(df: DataFrame) -> int:
    """Partition count for the range exchange.

    The count must be explicit (AQE leaves a numbered repartition alone, which keeps partition ids the same for both
    readers), so it is sized from the optimiser's size estimates: about 256 MB a partition, never fewer than
    ``spark.sql.shuffle.partitions``.
    """
    spark = df.sparkSession
    size = _estimated_bytes(df._jdf.queryExecution().optimizedPlan())
    target = int(spark.conf.get(TARGET_PARTITION_BYTES_CONF, str(DEFAULT_TARGET_PARTITION_BYTES)))
    return int(min(MAX_SCAN_PARTITIONS, max(shuffle_partitions(spark), -(-size // target))))


HELPERS = ("_pid", "_at", "_tiebreak", "_first", "_rows")
_LOCAL = (1 << 33) - 1      # monotonically_increasing_id holds the row's place in its partition in these bits


def placed(df: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec], num_partitions: int | None = None, tiebreak: bool = True) -> DataFrame:
    """``df`` range-partitioned and sorted by (keys, order, row hash), with ``_pid`` and the place ``_at`` (from 0) within it."""
    if set(HELPERS) & set(df.columns):
        raise ValueError(f"input columns {sorted(set(HELPERS) & set(df.columns))} collide with the helper columns")
    d = df.withColumn("_tiebreak", F.xxhash64(*[F.col(c) for c in df.columns])) if tiebreak else df.withColumn("_tiebreak", F.lit(0))
    sx = _sort_exprs(keys, _norm_order(order), "_tiebreak" if tiebreak else None)
    d = d.repartitionByRange(num_partitions or scan_partitions(df), *sx).sortWithinPartitions(*sx)
    if df.sparkSession.conf.get("spark.sql.exchange.reuse", "true").lower() != "true":
        d = d.persist(StorageLevel.MEMORY_AND_DISK)
    everything = F.xxhash64(*[F.col(c) for c in d.columns]).bitwiseAND(F.lit(0))
    return d.withColumn("_pid", F.spark_partition_id()) \
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL)) + everything)


def pieces(rows: DataFrame, keys: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """One row a piece (partition and group) of ``placed`` rows: _pid, keys, ``_first`` place, ``_rows`` and the ``sums`` before it in its group
    (``_before`` and ``_before_<column>``)."""
    totals = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"_sum_{c}") for c in sums]
    each = rows.groupBy("_pid", *keys).agg(F.min("_at").alias("_first"), (F.max("_at") - F.min("_at") + 1).alias("_rows"), *totals)
    add = {"_before": "_rows", **{f"_before_{c}": f"_sum_{c}" for c in sums}}
    if keys:
        w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        for out, c in add.items():
            each = each.withColumn(out, F.coalesce(F.sum(c).over(w), F.lit(0)))
        return each
    return carried(each, add)


def carried(each: DataFrame, add: dict[str, str], largest: bool = False) -> DataFrame:
    """One row a partition (``_pid``) with the sum, or the largest, of a column over the partitions before it (``add``: output -> column).

    In two levels: blocks of 512 partitions, then the blocks.  Nothing before a partition is 0 for a sum and NULL for the largest."""
    fold = F.max if largest else F.sum
    block = each.groupBy(F.floor(F.col("_pid") / 512).alias("_block")).agg(
        F.collect_list(F.struct(*each.columns)).alias("_list"), *[fold(c).alias(f"_total{c}") for c in add.values()])
    whole = block.groupBy().agg(F.collect_list(F.struct(*block.columns)).alias("_all"))
    one = whole.select("_all", F.explode("_all").alias("_b")).select("_all", "_b", F.explode("_b._list").alias("_p"))
    kinds = dict(each.dtypes)

    def before(c):
        start = F.lit(None if largest else 0).cast(kinds[c])
        both = (lambda a, x: F.greatest(a, x)) if largest else (lambda a, x: (a + x).cast(kinds[c]))
        blocks = F.aggregate(F.filter("_all", lambda x: x["_block"] < F.col("_b._block")), start, lambda a, x: both(a, x[f"_total{c}"]))
        return both(blocks, F.aggregate(F.filter("_b._list", lambda x: x["_pid"] < F.col("_p._pid")), start, lambda a, x: both(a, x[c])))
    return one.select("_p.*", *[before(c).alias(out) for out, c in add.items()])


def with_pieces(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row with what ``table`` says of its piece."""
    other = table.select(F.col("_pid").alias("_pid_p"), *[F.col(k).alias(f"_key{i}_p") for i, k in enumerate(keys)],
                         *[c for c in table.columns if c not in ("_pid", *keys)])
    same = F.col("_pid") == F.col("_pid_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}_p"))
    return rows.join(other, same).drop("_pid_p", *[f"_key{i}_p" for i in range(len(keys))])


def _window_positions(df, keys, order_n, row_number, rank, prefix_sums, tiebreak):
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*_sort_exprs([], order_n, None))
    # the numbering's tie-break: both ways number tied rows alike
    t = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(
        *_sort_exprs([], order_n, None), *([F.xxhash64(*[F.col(c) for c in df.columns])] if tiebreak else []))
    out = df.withColumn(row_number, F.row_number().over(t).cast("long"))
    if rank:
        out = out.withColumn(rank, F.rank().over(w).cast("long"))
    for name, col in (prefix_sums or {}).items():
        out = out.withColumn(name, F.sum(F.coalesce(F.col(col), F.lit(0))).over(t.rowsBetween(Window.unboundedPreceding, 0)))
    return out


def segmented_positions(df: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec],
                        row_number: str = "row_number", rank: str | None = None,
                        num_partitions: int | None = None, tiebreak: bool = True,
                        strategy: str = "range", prefix_sums: dict[str, str] | None = None) -> DataFrame:
    """Add ``row_number`` (1-based, within ``keys`` by ``order``) and optionally SQL ``rank``.

    ``keys`` may be empty: the result is then a global row number (X-07).  ``prefix_sums`` maps an output name to a numeric
    column whose running (inclusive) sum within the group is added.  Select only the columns you need first.
    """
    keys, base = list(keys), df.columns
    if strategy == "window":
        return _window_positions(df, keys, _norm_order(order), row_number, rank, prefix_sums, tiebreak)
    rows = placed(df, keys, order, num_partitions, tiebreak)
    sums = dict(prefix_sums or {})
    out = with_pieces(rows, pieces(rows, keys, list(dict.fromkeys(sums.values()))), keys)
    w = Window.partitionBy("_pid", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    out = out.select(*base, (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("long").alias(row_number),
                     *[(F.sum(F.coalesce(F.col(c), F.lit(0))).over(w) + F.col(f"_before_{c}")).alias(name) for name, c in sums.items()])
    return _joined_ranks(out, keys, order, rank, num_partitions) if rank else out


def _joined_ranks(df, keys, order, name, num_partitions):
    """Rows with the rank of their value: 1 + the rows of smaller values of the group, counted on the distinct values."""
    cols = list(dict.fromkeys([*keys, *[c for c, _ in _norm_order(order)]]))
    values = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_count"))
    ranked = segmented_positions(values, keys, order, row_number="_nth", prefix_sums={"_upto": "_count"}, num_partitions=num_partitions)
    ranked = ranked.select(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)], (F.col("_upto") - F.col("_count") + 1).cast("long").alias(name))
    same = F.lit(True)
    for i, c in enumerate(cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_v{i}"))
    return df.join(ranked, same).drop(*[f"_v{i}" for i in range(len(cols))])


def with_row_index(df: DataFrame, order: Sequence[OrderSpec], name: str = "row_idx",
                   num_partitions: int | None = None, strategy: str = "range") -> DataFrame:
    """0-based global row index by ``order`` (X-07); the table never goes through one task."""
    r = segmented_positions(df, [], order, row_number="_rn1", num_partitions=num_partitions, strategy=strategy)
    return r.withColumn(name, F.col("_rn1") - 1).drop("_rn1")


def running_max(df: DataFrame, order: Sequence[OrderSpec], value, name: str, num_partitions: int | None = None) -> DataFrame:
    """Add the largest ``value(position)`` up to each row of the whole table by ``order``.

    ``value`` makes a column of a row's 1-based position (a column too).  Each partition of one range sort keeps its own
    running maximum and takes in the largest of the partitions before it, so the table never goes through one task."""
    rows = placed(df, [], order, num_partitions)
    rows = with_pieces(rows, pieces(rows, []), [])
    rows = rows.withColumn("_value", value(F.col("_at") - F.col("_first") + F.col("_before") + 1))
    tops = carried(rows.groupBy("_pid").agg(F.max("_value").alias("_top")), {"_peak": "_top"}, largest=True).select("_pid", "_peak")
    w = Window.partitionBy("_pid").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return with_pieces(rows, tops, []).select(*df.columns, F.greatest(F.max("_value").over(w), "_peak").alias(name))


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec], name: str = "rank",
                num_partitions: int | None = None, strategy: str = "range") -> DataFrame:
    """SQL ``RANK()`` within groups (ties share, gaps left) — W-02."""
    if strategy == "window":
        return _window_positions(df, list(keys), _norm_order(order), "_rn_tmp", name, None, False).drop("_rn_tmp")
    return _joined_ranks(df, list(keys), order, name, num_partitions)


def row_number_within(df: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec],
                      name: str = "row_number", num_partitions: int | None = None,
                      strategy: str = "range") -> DataFrame:
    return segmented_positions(df, keys, order, row_number=name, num_partitions=num_partitions, strategy=strategy)


def top_within(df: DataFrame, keys: Sequence[str], order: Sequence[OrderSpec], k: int, name: str = "rank") -> DataFrame:
    """The rows of SQL ``RANK() <= k`` within groups, all ties kept (W-03).

    Counts the distinct values of a group, keeps the k best of them (each task lets only its k best through), and
    joins their ranks to the rows: a hot group never stands in one task, and rows below the k-th value meet no sort."""
    keys = list(keys)
    norm = _norm_order(order)
    cols = list(dict.fromkeys([*keys, *[c for c, _ in norm]]))
    values = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_count"))
    w = Window.partitionBy(*keys).orderBy(*_sort_exprs([], norm, None))
    best = values.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= k)
    upto = F.sum("_count").over(w.rowsBetween(Window.unboundedPreceding, -1))
    best = best.withColumn(name, (F.coalesce(upto, F.lit(0)) + 1).cast("long")).where(F.col(name) <= k)
    best = best.select(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)], name)
    same = F.lit(True)
    for i, c in enumerate(cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_v{i}"))
    return df.join(best, same).drop(*[f"_v{i}" for i in range(len(cols))])


#: Buckets a group's values are counted in, each time they are narrowed.
BUCKETS = 4096


def _bucket(v: Column, lo: Column, hi: Column) -> Column:
    """A number that never falls as ``v`` rises; infinities and NaN (the largest) stand outside the finite range."""
    inf = F.lit(float("inf"))
    inside = F.when(hi > lo, F.least(F.lit(BUCKETS - 1), F.floor((v - lo) / (hi - lo) * BUCKETS))).otherwise(0)
    return F.when(v == -inf, -1).when(F.isnan(v) | (v == inf), BUCKETS).otherwise(inside).cast("int")


def _finite(v: Column) -> Column:
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, num_partitions: int | None = None,
                    strategy: str = "range") -> DataFrame:
    """Exact interpolated quantiles (R type 7, SQL ``quantile_cont`` / ``percentile``) per group.

    NULL values are skipped.  Every position p(n-1) and its neighbour are looked for at once: buckets between the group's
    extremes are counted, the buckets that hold a wanted position are cut into buckets again, and the distinct values in
    those are sorted.  Rows are only counted, never numbered, and no group or bucket is gathered in one task."""
    keys = list(keys)
    names = list(names) if names else [f"q{int(round(p * 100)):02d}" for p in probs]
    group = [f"_k{i}" for i in range(len(keys))]
    vals = df.where(F.col(value).isNotNull()).select(*[F.col(k).alias(g) for k, g in zip(keys, group)], F.col(value).cast("double").alias("_v"))
    v = F.col("_v")
    ends = vals.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.min(_finite(v)).alias("_lo"), F.max(_finite(v)).alias("_hi")).where("_n > 0")
    at = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    wanted = F.array_distinct(F.array(*[f(h).cast("long") for h in at for f in (F.floor, F.ceil)]))
    ends = ends.withColumn("_want", wanted).withColumn("_start", F.lit(0).cast("long"))
    state = ["_lo", "_hi", "_want", "_start"]

    def joined(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
        if not on:
            return rows.withColumn("_s", table.select(F.struct(*state)).scalar()).select(*rows.columns, *[F.col(f"_s.{c}").alias(c) for c in state])
        other = table.select(*[F.col(c).alias(f"{c}_t") for c in on], *state)
        same = F.lit(True)
        for c in on:
            same = same & F.col(c).eqNullSafe(F.col(f"{c}_t"))
        return rows.join(other, same).drop(*[f"{c}_t" for c in on])

    def narrowed(rows: DataFrame, on: list[str], by: str) -> DataFrame:
        """Counted values of ``by`` with the wanted positions that each holds."""
        c = rows.groupBy(*on, by).agg(F.count(F.lit(1)).alias("_c"), F.min(_finite(v)).alias("_lo"), F.max(_finite(v)).alias("_hi"),
                                      F.first("_want").alias("_want"), F.first("_start").alias("_start"))
        w = Window.partitionBy(*(on or [F.col("_start")])).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        c = c.withColumn("_from", F.col("_start") + F.coalesce(F.sum("_c").over(w), F.lit(0)))
        held = F.filter("_want", lambda x: (x >= F.col("_from")) & (x < F.col("_from") + F.col("_c")))
        return c.withColumn("_want", held).where(F.size("_want") > 0).withColumn("_start", F.col("_from")).drop("_from", "_c")
    table, rows, on = ends, vals, list(group)
    for i in range(2):
        rows = joined(rows, table, on).withColumn(f"_b{i}", _bucket(v, F.col("_lo"), F.col("_hi")))
        table = narrowed(rows, on, f"_b{i}")
        rows, on = rows.drop(*state), [*on, f"_b{i}"]
    found = narrowed(joined(rows, table, on), on, "_v").select(*group, F.explode("_want").alias("_r"), "_v")
    found = found.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_m"))
    if keys:
        counts = ends.select(*[F.col(g).alias(f"{g}_n") for g in group], "_n")
        same = F.lit(True)
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"{g}_n"))
        found = found.join(counts, same)
    else:
        found = found.withColumn("_n", ends.select("_n").scalar())
    out = []
    for p, name in zip(probs, names):
        h = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.col("_m")[F.floor(h).cast("long")], F.col("_m")[F.ceil(h).cast("long")]
        out.append(F.when(F.floor(h) == F.ceil(h), lo).otherwise(lo + (h - F.floor(h)) * (hi - lo)).alias(name))
    return found.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], *out)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median",
                 num_partitions: int | None = None, strategy: str = "range") -> DataFrame:
    return exact_quantiles(df, keys, value, [0.5], [name], num_partitions=num_partitions, strategy=strategy)
