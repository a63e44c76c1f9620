"""Catalog verbs: register, look up, materialise and inspect named tables (S-01, S-05, S-08..S-14)."""

from __future__ import annotations

import re

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (parquet) lazily; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> dict[str, DataFrame]:
    """Register every driver table as a temp view and return them by name."""
    out = {}
    for n in names:
        df = load_table(spark, sf_dir, n)
        df.createOrReplaceTempView(n)
        out[n] = df
    return out


def create_table(spark: SparkSession, rows, name: str, schema=None, overwrite: bool = False) -> DataFrame:
    """Copy rows (list, pandas frame or DataFrame) into a named session table.

    Without ``overwrite`` an existing name is an error, as the reference's copy step.
    """
    df = rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows, schema=schema)
    if overwrite:
        df.createOrReplaceTempView(name)
    else:
        df.createTempView(name)  # raises TempTableAlreadyExists
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if name:
        df.createOrReplaceTempView(name)
    return df


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def sql(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(query)


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def materialize(df: DataFrame, name: str, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Run a query once and keep it as a named table (the reference's ``compute``).

    The cache is filled lazily by the first action; lost blocks are rebuilt from
    lineage, so an executor loss costs time, not correctness.
    """
    df = df.persist(level)
    df.createOrReplaceTempView(name)
    return df


def head(df: DataFrame, n: int = 6) -> DataFrame:
    """First ``n`` rows (R's default of six); a limit, not a sample."""
    return df.limit(n)


def clean_names(df: DataFrame) -> DataFrame:
    """Replace non-alphanumerics by ``_`` and make names unique (``Sepal.Length`` -> ``Sepal_Length``)."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        base = re.sub(r"[^0-9A-Za-z_]", "_", c)
        if not base or base[0].isdigit():
            base = "_" + base
        k = seen.get(base.lower(), 0)
        seen[base.lower()] = k + 1
        names.append(base if k == 0 else f"{base}_{k}")
    return df.toDF(*names)
