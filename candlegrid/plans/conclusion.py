"""The entry conclusion: daily sides next to the sides of the six slower periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlegrid.config import PERIODS, Period
from candlegrid.functions.calendar import within_years
from candlegrid.operators.asof import asof_within

SIDES = ("Side_1", "Side_2", "Side_3")


def period_slice(prices: DataFrame, code: str) -> DataFrame:
    """Sides of one period; prunes to one directory on a table partitioned by period."""
    return prices.where(F.col("period") == code).select("ticker", "Date", *SIDES)


def daily_slice(prices: DataFrame, as_of: Column, years: int = 2) -> DataFrame:
    """Daily sides of the last ``years`` before ``as_of``."""
    return period_slice(prices, "D").where(within_years(F.col("Date"), as_of, years))


def without_latest_day(daily: DataFrame) -> DataFrame:
    """Drop the latest day of each ticker, whose bar may still change."""
    newest = F.max("Date").over(Window.partitionBy("ticker"))
    return daily.withColumn("_newest", newest).where(F.col("Date") < F.col("_newest")).drop("_newest")


def asof_period(prices: DataFrame, p: Period, as_of: Column, years: int = 2) -> DataFrame:
    """Daily rows with the latest bar of one slower period. ``prices`` is read once."""
    daily = F.col("period") == "D"
    rows = prices.select("ticker", "Date", "period", *SIDES).where(
        (F.col("period") == p.code) | (daily & within_years(F.col("Date"), as_of, years))
    )
    matched = asof_within(rows, daily, {p.code: p.tolerance_days}, SIDES)
    found = F.col(p.code)
    return matched.select(
        "ticker",
        F.col("Date").alias("Date_D"),
        found["Date"].alias(f"Date_{p.suffix}"),
        *(found[s].alias(f"{s}_{p.suffix}") for s in SIDES),
    )


def entry_conclusion(prices: DataFrame, as_of: Column, years: int = 2) -> DataFrame:
    """One row per ticker and day with seven dates and 21 sides (29 columns).

    ``prices`` needs ticker, Date, period and the three sides, and is read once. The
    exchange on ticker made for the as-of pass also serves the latest-day window.
    """
    slow = [p for p in PERIODS if p.unit != "day"]
    daily = F.col("period") == "D"
    rows = prices.select("ticker", "Date", "period", *SIDES).where(
        F.col("period").isin(*(p.code for p in slow)) | (daily & within_years(F.col("Date"), as_of, years))
    )
    matched = asof_within(rows, daily, {p.code: p.tolerance_days for p in slow}, SIDES)
    kept = without_latest_day(matched)
    columns = [F.col("ticker"), F.col("Date").alias("Date_D")]
    columns += [F.col(p.code)["Date"].alias(f"Date_{p.suffix}") for p in slow]
    for s in SIDES:
        columns.append(F.col(s).alias(f"{s}_D"))
        columns += [F.col(p.code)[s].alias(f"{s}_{p.suffix}") for p in slow]
    return kept.select(*columns)
