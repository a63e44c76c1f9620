"""Label rows that a classifier may learn from, and the hold-out rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n (a NULL id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(n))


def training_labels(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, y): ids outside the held-out fifth with one known label; contradicting
    rows for an id and NULLs are left out."""
    return (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).dropna()
            .where(F.col("y").isin(0, 1)).where(fold("doc_id", 5) != 0)
            .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").select("doc_id", "y"))


def hashed_sample(rows: DataFrame, limit: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``limit`` rows: those whose ids hash lowest (the same rows in any order)."""
    return rows.orderBy(F.xxhash64(id_col), id_col).limit(limit)
