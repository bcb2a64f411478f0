"""Symbol list from its JSON form: an object of records keyed "0", "1", ..."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS = "map<string, struct<cik_str: bigint, ticker: string, title: string>>"


def symbols_from_json(documents: DataFrame, batch_time: Column, json_column: str = "value") -> DataFrame:
    """Active symbols, all stamped with the batch time."""
    records = F.map_values(F.from_json(F.col(json_column), RECORDS))
    return documents.select(F.inline(records)).select(
        F.col("cik_str").alias("cik"),
        "ticker",
        "title",
        batch_time.alias("last_updated"),
        F.lit(True).alias("is_active"),
    )


def read_symbols_json(spark: SparkSession, path: str, batch_time: Column) -> DataFrame:
    """Symbols of one JSON file or a directory of them."""
    return symbols_from_json(spark.read.text(path, wholetext=True), batch_time)
