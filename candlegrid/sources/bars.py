"""Bars as delivered, to bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlegrid.operators.clean import BAR_COLUMNS
from candlegrid.schemas import BARS


def bronze_bars(delivered: DataFrame, batch_time: Column) -> DataFrame:
    """Date as a date and the batch time stamped on every row.

    Tickers that delivered nothing are found with ``reports.ingest_outcome``.
    """
    return (
        delivered.withColumn("Date", F.to_date("Date"))
        .withColumn("created_at", batch_time)
        .select(*BAR_COLUMNS)
    )


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Bronze or silver bars; ``ticker`` comes from the directory names."""
    return spark.read.schema(BARS).parquet(path)
