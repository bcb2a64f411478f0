"""Run reports, each one aggregate over the tables of a step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlegrid.operators.clean import clean_report
from candlegrid.operators.upsert import merge_report

__all__ = [
    "clean_report",
    "ingest_outcome",
    "ingest_summary",
    "merge_report",
    "period_report",
    "screen_summary",
    "union_report",
]


def ingest_outcome(expected: DataFrame, arrived: DataFrame, attempts: DataFrame | None = None) -> DataFrame:
    """Status per expected ticker: success when it has bars, else retry or failed.

    ``attempts`` may hold ticker and rate_limited for tickers whose source asked to
    come back later; of those without bars, they are to be retried. Bars are counted
    per ticker before the join, so a ticker with many bars does not weigh on it.
    """
    counted = arrived.groupBy("ticker").agg(F.count("*").alias("bars"))
    joined = expected.select("ticker").distinct().join(counted, "ticker", "left")
    later = F.lit(False)
    if attempts is not None:
        limited = attempts.groupBy("ticker").agg(F.bool_or("rate_limited").alias("_later"))
        joined = joined.join(limited, "ticker", "left")
        later = F.coalesce(F.col("_later"), F.lit(False))
    bars = F.coalesce("bars", F.lit(0))
    return joined.select(
        "ticker",
        bars.alias("bars"),
        F.when(bars > 0, "success").when(later, "retry").otherwise("failed").alias("status"),
    )


def ingest_summary(outcome: DataFrame) -> DataFrame:
    """Tickers per status."""
    return outcome.groupBy("status").agg(F.count("*").alias("tickers"))


def period_report(gold: DataFrame) -> DataFrame:
    """Rows, tickers and latest date per period."""
    per_ticker = gold.groupBy("period", "ticker").agg(F.count("*").alias("n"), F.max("Date").alias("d"))
    return per_ticker.groupBy("period").agg(
        F.sum("n").alias("rows"), F.count("*").alias("tickers"), F.max("d").alias("latest")
    )


def union_report(merged: DataFrame) -> DataFrame:
    """Rows after a merge, in all and per period."""
    return merged.rollup("period").agg(F.count("*").alias("rows"))


def screen_summary(screened: DataFrame) -> DataFrame:
    """Selected companies per day and label, with the total of the day."""
    by_label = screened.groupBy("created_at", "is_selected").agg(F.count("*").alias("companies"))
    totals = by_label.groupBy("created_at").agg(F.sum("companies").alias("total"))
    return by_label.join(totals, "created_at")
