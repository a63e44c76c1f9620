"""Delimited text, CSV and parquet readers / writers and the raw line count (S-02..S-07)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def read_delimited(spark: SparkSession, path: str, schema: StructType, sep: str = "|",
                   header: bool = False, quote: str | None = "", name: str | None = None,
                   keep_empty: bool = False) -> DataFrame:
    """Read a delimited file with an explicit schema (no inference pass over the data).

    ``quote=""`` turns quoting off, which the movie table needs because titles hold
    stray quote characters.  Whitespace-separated files use ``sep="\\t"``.
    ``keep_empty`` reads empty text fields as ``""`` (as R does) instead of NULL.
    """
    reader = (spark.read.schema(schema).option("sep", sep).option("header", str(header).lower())
              .option("mode", "PERMISSIVE"))
    if quote is not None:
        reader = reader.option("quote", quote if quote else "\u0000")
    df = reader.csv(path)
    if keep_empty:
        # the CSV parser turns an unquoted empty field into NULL whatever the options;
        # in delimited text empty and missing text are the same thing, read as "" like R
        df = df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, StringType)
                         else F.col(f.name) for f in schema.fields])
    if name:
        df.createOrReplaceTempView(name)
    return df


def read_csv(spark: SparkSession, path: str, name: str | None = None,
             schema: StructType | None = None, sample_ratio: float = 1.0) -> DataFrame:
    """Headered CSV.  A given schema is used as is; otherwise types are inferred from
    the whole file, so a late value cannot contradict them (a smaller ``sample_ratio`` risks that)."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true").option("samplingRatio", str(sample_ratio))
    df = reader.csv(path)
    if name:
        df.createOrReplaceTempView(name)
    return df


def write_csv(df: DataFrame, path: str, header: bool = True, null_value: str = "",
              mode: str = "overwrite") -> None:
    """Write CSV in parallel (one file per partition), empty string for NULL, no row names."""
    (df.write.mode(mode).option("header", str(header).lower()).option("nullValue", null_value)
     .option("emptyValue", "\"\"").csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def count_lines(spark: SparkSession, path: str) -> int:
    """Raw line count of a text file (header included), counted on the executors."""
    return spark.read.text(path).count()
