"""Connected components of a link table by hooking and contraction.

Each round hooks every node to its smallest neighbour, follows the hooks to their roots by
pointer jumps, and replaces the links by those between roots.  Links inside a component
vanish as soon as their ends share a root, so later rounds read only what is not yet
connected.  Labels found earlier are the start of a later call: only the new links, taken
between known labels, are then worked on.  What a round leaves is counted while it is
written: every job costs the driver threads and memory, however small its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import pieces, stored, stored_with

#: Rows of a label table in one file.
FILE_ROWS = 1_000_000


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct links with the smaller end first, without loops."""
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _relabelled(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between the labels of their ends; an end without a label stays."""
    one = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    two = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return _ordered(links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))


def _followed(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    """``labels`` with each label replaced by what ``hooks`` gives for it; ``old`` is the former one."""
    hop = hooks.select(F.col("node").alias("mid"), F.col("label").alias("far"))
    return labels.join(hop, labels.label == hop.mid, "left").select("node", F.coalesce("far", "label").alias("label"), F.col("label").alias("old"))


def _roots(hooks: DataFrame, files: int, rounds: int) -> DataFrame:
    """Every node's root: hooks lead to smaller nodes only, so each jump halves the way."""
    for _ in range(rounds):
        hooks, moved = stored_with(hooks.sparkSession, _followed(hooks, hooks).coalesce(files), "labels", F.count_if(F.col("label") != F.col("old")))
        hooks = hooks.select("node", "label")
        if not moved:
            return hooks
    raise RuntimeError("labels did not settle")


def components(links: DataFrame, known: DataFrame | None = None, rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node that each end of ``links`` (a, b) reaches.

    ``known`` is an earlier result whose links count as well; its nodes stay in the result."""
    spark = links.sparkSession
    edges, left = stored_with(spark, _ordered(links) if known is None else _relabelled(links, known), "edges", F.count("*"))
    labels = None
    for _ in range(rounds):
        if not left:
            break
        files = pieces(2 * left, FILE_ROWS)
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label"))
        hooks = _roots(stored(spark, hooks.coalesce(files), "labels"), files, rounds)
        labels = hooks if labels is None else stored(spark, _followed(labels, hooks).select("node", "label"), "labels")
        edges, left = stored_with(spark, _relabelled(edges, hooks).coalesce(files), "edges", F.count("*"))
    else:
        raise RuntimeError("labels did not settle")
    if known is None:
        return spark.createDataFrame([], "node long, label long") if labels is None else labels
    if labels is None:
        return known
    new = labels.join(known.select("node"), "node", "left_anti")
    return stored(spark, _followed(known, labels).select("node", "label").union(new.select("node", "label")), "labels")
