"""Stored tables as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.functions.calendar import within_years


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A Parquet table, or None when there is none yet (the first run of an upsert)."""
    if not path_exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def declare_external(spark: SparkSession, name: str, path: str, schema: T.StructType | None = None) -> None:
    """Make a Parquet path queryable by name."""
    table = read_table(spark, path, schema)
    if table is None:
        raise FileNotFoundError(path)
    table.createOrReplaceTempView(name)


def active_tickers(symbols: DataFrame) -> DataFrame:
    return symbols.where("is_active").select("ticker").distinct()


def recent_screened_tickers(screened: DataFrame, as_of: Column, years: int = 2) -> DataFrame:
    """Tickers selected within ``years`` before ``as_of``."""
    return screened.where(within_years(F.col("created_at"), as_of, years)).select("ticker").distinct()
