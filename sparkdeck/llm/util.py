"""Helpers shared by the operators: shared scratch tables, Arrow columns, block sizes.

* Intermediate tables go to the folder that ``spark.checkpoint.dir`` names, through
  Spark's own writers, so every executor and a restarted task can read them.
* Python tasks get Arrow batches bounded in bytes as well as rows, so a few very long
  texts cannot fill a worker.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, ensure_checkpoint_dir

#: Arrow batch limits for Python tasks.
BATCH_ROWS, BATCH_BYTES = 4000, 16 << 20

_SCRATCH: dict[str, list[str]] = {}


def bounded_batches(spark: SparkSession) -> None:
    """Limit the Arrow batches handed to Python tasks in rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts the lineage)."""
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_with(spark: SparkSession, df: DataFrame, name: str, figure: Column) -> tuple[DataFrame, int]:
    """``stored``, and an aggregate of the rows (0 for none) taken while they are written: no job reads them for it."""
    seen = Observation()
    table = stored(spark, df.observe(seen, figure.alias("figure")), name)
    return table, int(seen.get["figure"] or 0)


def tidy(spark: SparkSession) -> None:
    """Collect the driver's garbage after a phase of many small jobs.  Plans and broadcasts of finished jobs go then, and with
    them their blocks and shuffle files: Spark's cleaner follows the driver's collector, which else waits until its heap is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(spark: SparkSession) -> None:
    """Delete the scratch tables made so far; frames that still read them become invalid."""
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        delete_path(spark, path)


def raw(col) -> list:
    """A string or binary Arrow column as ``bytes`` (no UTF-8 decoding); NULL stays None."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist() \
        if not pa.types.is_binary(col.type) else col.to_pylist()


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Total UTF-8 bytes of the text column (a column-pruned aggregate)."""
    return int(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)


def pieces(total: int, each: int, least: int = 1) -> int:
    return max(least, -(-total // each))
