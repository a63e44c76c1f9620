"""A training-data pipeline over ``documents``: STAGES in order, each a (name, function).

A stage function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  Every result is written as Parquet and reread as
the next stage's docs.

Stages that filter or rewrite go back to their rows by a hash of id and text, so rows
with NULL or repeated ids are judged by their own text; equal rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdeck.llm import decontam, jaccard_join, packing, pu_quality, suffix_dedup, tokens
from sparkdeck.llm.util import stored

#: The columns of ``documents``.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts stay."""
    judged = pu_quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3, with_row=True)
    good = judged.where("predicted = 1").select("row").distinct()
    return _keyed(docs).join(good, "row", "left_semi").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    rows = _keyed(docs)
    groups = jaccard_join.link(rows, size=5, id_col="row").select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select("doc_id", "row").distinct().join(groups, "row")
    first = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), "row")
    kept = ids.groupBy("component_id").agg(F.min(first).alias("first")).select(F.col("first.row").alias("row"))
    return rows.join(kept, "row", "left_semi").dropDuplicates(["row"]).select(*COLUMNS)


def suffix_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the 200-byte strings that start more than once; characters cut in two go whole."""
    rows = _keyed(docs)
    kept = suffix_dedup.deduplicate(rows, length=200, id_col="row").where("n_removed > 0") \
        .select(F.col("doc_id").alias("row"), "kept").dropDuplicates(["row"])
    kept = suffix_dedup.as_text(kept, "row", "kept")
    text = F.coalesce("kept", "text")
    return rows.join(kept, "row", "left").select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no 10-word window of ``benchmark`` stay."""
    rows = _keyed(docs)
    judged = decontam.decontaminate(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10, id_col="row")
    bad = judged.where("contaminated").select(F.col("doc_id").alias("row")).distinct()
    return rows.join(bad, "row", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as power-of-two pieces of at most 2048 ids."""
    return packing.pack(docs, tokens.public_path("byte_bpe_50k.json"), end_id=1, max_len=2048)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("suffix_repeats", suffix_repeats),
          ("decontamination", decontaminated), ("packing", packed)]

#: Classifiers, suffix sorting and byte-pair encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return docs
