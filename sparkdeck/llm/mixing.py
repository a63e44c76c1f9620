"""Mixing sources to target weights by Sainte-Lague apportionment of equal-word blocks.

Targets.  A mix of ``share`` times all words is divided over the sources by their weights; a source stops at ``cap`` times
its own words and what it cannot take is shared again by weight until no source is above.  Each round of that is one
aggregate over the source table.

Quotas.  The mix is a number of blocks of ``block_words`` words.  Sources get blocks by the highest quotients
``target / (2 seats + 1)``, and each source's blocks go to its shards in the same way by the shards' words, so every shard
has a whole quota.  The seats of all groups are found together: aggregates count the seats that 32 trial divisors
would give, three rounds narrow the divisor, and only the quotients that lie within the last interval are sorted.

Selection.  A shard is a hash class of a source's documents, of some ``shard_words`` words and ``shard_rows`` rows, so a hot
source is many tasks.  Its documents stand in seeded order and are cut into blocks; a quota above the
number of blocks takes all of them once first, the rest goes to the blocks of lowest seeded hash.  A document's share is the
sum over its blocks: at most ``cap`` copies.  Nothing depends on partitions, so reruns agree.

The source table is joined by Spark's own choice (broadcast below its size limit, else a sort-merge join
whose hot keys AQE splits).  Equal rows are counted first and dealt in lots of a thousand copies.

Edge cases: NULL texts and texts without words have size 0 and nothing taken; a NULL source is a source of its own, the last;
NULL and repeated document ids keep a row each; ties of quotients go to the smaller source or shard; an empty table gives
no row.  A source smaller than a few blocks is met to within a block.  A document is at most one shard: its blocks take some
30 bytes of a task's memory each.  Columns other than id, text and source are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import with_row_index
from .hashing import mix as scramble
from .util import bounded_batches, stored

WORDS = r"[^\x20\x09-\x0D]+"
#: Trial divisors a round, rounds, and copies of one row that stay together.
TRIALS, ROUNDS, LOT = 32, 3, 1000


def apportion(parties: DataFrame, group: str, party: str, weight: str, seats: DataFrame) -> DataFrame:
    """``parties`` with a column ``quota``: the seats of each party of its group by highest quotients weight / (2 n + 1).

    ``seats`` has one row (group, seats) a group; ``party`` orders the parties of a group where quotients are equal."""
    spark = parties.sparkSession
    w = F.col(weight).cast("double")
    sizes = parties.groupBy(group).agg(F.sum(w).alias("_sum"), F.max(w).alias("_max"), F.count(F.lit(1)).alias("_n"))
    # rounding moves each party by half a seat at most: the divisor lies between these
    q, half = F.col("seats").cast("double"), F.col("_n") / 2 + 1
    bounds = sizes.join(seats, group).select(
        group, "seats", (F.col("_sum") / (q + half)).alias("_lo"),
        F.when(q > half, F.least(F.col("_sum") / (q - half), 2.001 * F.col("_max"))).otherwise(2.001 * F.col("_max")).alias("_hi"))
    bounds = stored(spark, bounds, "bounds")

    def given(divisor):
        return F.when(divisor > 0, F.floor(w / divisor + 0.5)).otherwise(0).cast("long")
    for _ in range(ROUNDS):
        trials = bounds.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(TRIALS + 1)))) \
            .withColumn("_d", F.when(F.col("_i") > TRIALS, F.col("_hi")).otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) / (TRIALS + 1) * F.col("_i")))
        counted = parties.join(trials, group).groupBy(group, "seats", "_i", "_d").agg(F.sum(given(F.col("_d"))).alias("_given"))
        # the largest trial that gives enough seats, the smallest that does not give too many
        bounds = stored(spark, counted.groupBy(group, "seats").agg(F.max(F.when(F.col("_given") >= F.col("seats"), F.col("_d"))).alias("_lo"),
                                                                   F.min(F.when(F.col("_given") <= F.col("seats"), F.col("_d"))).alias("_hi")), "bounds")
    held = parties.join(bounds, group)
    few, most = given(F.greatest("_lo", "_hi")), given(F.least("_lo", "_hi"))
    held = stored(spark, held.select(*parties.columns, "seats", few.alias("_few"), most.alias("_most")), "seats")
    short = held.groupBy(group).agg((F.first("seats") - F.sum("_few")).alias("_short"))
    # the few quotients that lie inside the last interval
    close = held.where("_most > _few").select(group, party, w.alias("_w"), F.explode(F.sequence(F.col("_few") + 1, F.col("_most"))).alias("_j"))
    order = Window.partitionBy(group).orderBy(F.desc(F.col("_w") / (2 * F.col("_j") - 1)), party)
    extra = close.withColumn("_k", F.row_number().over(order)).join(short, group).where("_k <= _short") \
        .groupBy(group, party).agg(F.count(F.lit(1)).alias("_extra"))
    return held.join(extra, [group, party], "left").select(*parties.columns, (F.col("_few") + F.coalesce("_extra", F.lit(0))).alias("quota"))


def fill(sources: DataFrame, share: Fraction, cap: int) -> DataFrame:
    """``sources`` (size, weight) with a column ``target``."""
    most = cap * F.col("size")
    total = int(sources.agg(F.sum("size")).first()[0] or 0)
    whole, level, full = float(share * total), None, -1
    while True:
        stops = F.lit(False) if level is None else most <= F.lit(level) * F.col("weight")
        n, taken, weights = sources.agg(F.sum(stops.cast("long")), F.sum(F.when(stops, most)), F.sum(F.when(~stops, F.col("weight")))).first()
        if n == full or not weights:
            break
        full, level = n, (whole - int(taken or 0)) / int(weights)
    return sources.withColumn("target", F.least(most.cast("double"), F.lit(level or 0.0) * F.col("weight")))


@dataclass
class Mix:
    """``documents`` (doc_id, size, source_size, target, taken); ``sources`` and ``shards`` with their quotas in blocks."""
    documents: DataFrame
    sources: DataFrame
    shards: DataFrame


def take(sizes: np.ndarray, quota: int, block_words: int, cap: int, seed: int) -> np.ndarray:
    """Words taken from each of the documents that stand one behind the other in a shard."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    blocks = -(-total // block_words)
    if not blocks:
        return np.zeros(len(sizes), np.int64)
    rounds, extra = divmod(min(quota, cap * blocks), blocks)
    chosen = np.zeros(blocks + 1, np.int64)
    if extra:
        h = scramble(np.arange(blocks, dtype=np.uint64) + np.uint64(seed))
        chosen[np.argpartition(h, extra - 1)[:extra]] = 1
    before = np.r_[0, np.cumsum(chosen[:-1])] * block_words

    def upto(at):
        return before[at // block_words] + chosen[at // block_words] * (at % block_words)
    return rounds * sizes + upto(ends) - upto(ends - sizes)


def mix(docs: DataFrame, share: Fraction = Fraction(3, 2), weights: Sequence[int] = (5, 2, 1), cap: int = 2, block_words: int = 16,
        shard_words: int = 1_000_000, shard_rows: int = 4_000, seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> Mix:
    """The words that a mix takes from every document; ``weights`` repeat over the sources in code point order."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text, source = F.col(text_col), F.col(source_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source)).alias("src"),
                       F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64(F.lit(seed), F.col(id_col), text).alias("h"))
    lots = rows.groupBy("doc_id", "src", "size", "h").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / LOT).cast("int")))) \
        .withColumn("n", F.least(F.lit(LOT), F.col("n") - F.col("lot") * LOT).cast("long"))
    lots = stored(spark, lots, "sizes")
    sources = lots.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("rows"))
    sources = with_row_index(sources.withColumn("last", F.col("src") == "n"), ["last", "src"], name="nth")
    weight = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("size") / shard_words), F.ceil(F.col("rows") / shard_rows)).cast("long")
    sources = stored(spark, sources.select("src", "size", weight.alias("weight"), parts.alias("parts")), "sources")
    sources = stored(spark, fill(sources, share, cap), "targets")
    whole = sources.agg(F.sum("target")).first()[0] or 0.0
    seats = sources.select(F.lit(0).alias("all"), F.lit(round(whole / block_words)).cast("long").alias("seats")).distinct()
    sources = stored(spark, apportion(sources.withColumn("all", F.lit(0)), "all", "src", "target", seats).drop("all"), "quotas")
    placed = lots.join(sources.select("src", "parts", F.col("size").alias("source_size"), "target"), "src") \
        .withColumn("shard", F.pmod(F.xxhash64("h", "doc_id", "lot"), "parts"))
    placed = stored(spark, placed.drop("parts"), "placed")
    shards = placed.groupBy("src", "shard").agg(F.sum(F.col("size") * F.col("n")).alias("size"))
    shards = stored(spark, shards, "shards")
    shards = stored(spark, apportion(shards, "src", "shard", "size", sources.select("src", F.col("quota").alias("seats"))), "shard-quotas")

    def chosen(key, left, right):
        quota = right.column("quota")[0].as_py()
        h, lot, n, size = (left.column(c).to_numpy() for c in ("h", "lot", "n", "size"))
        ids = left.column("doc_id").combine_chunks()
        order = np.lexsort((lot, ids.fill_null(0).to_numpy(), size, h))
        order = np.repeat(order, n[order])
        src, shard = (k.as_py() for k in key)
        taken = take(size[order], quota, block_words, cap, xxhash.xxh3_64_intdigest(f"{seed} {shard} {src}".encode()))
        at = pa.array(order)
        return pa.Table.from_arrays([ids.take(at), pa.array(size[order]), left.column("source_size").combine_chunks().take(at),
                                     left.column("target").combine_chunks().take(at), pa.array(taken)], ["doc_id", "size", "source_size", "target", "taken"])
    documents = placed.groupBy("src", "shard").cogroup(shards.select("src", "shard", "quota").groupBy("src", "shard")) \
        .applyInArrow(chosen, "doc_id long, size long, source_size long, target double, taken long")
    named = F.when(F.col("src") != "n", F.expr("substr(src, 2)")).alias("source")
    return Mix(documents, sources.select(named, "size", "weight", "target", "quota"), shards.select(named, "shard", "size", "quota"))
