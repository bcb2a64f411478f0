"""Fundamentals as they arrive, to the table the screen reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlegrid.functions.numeric import finite_or_null, null_if_in, ratio_to_high, to_number, truncate
from candlegrid.schemas import MEASURES, RATING_KEY


def normalise(raw: DataFrame, measures: tuple[str, ...] = MEASURES, decimals: int = 3) -> DataFrame:
    """Text to numbers, infinities to NULL, numbers cut at ``decimals`` places, words for none to NULL."""
    numbers = raw.select(
        F.to_date("created_at").alias("created_at"),
        "ticker",
        *(to_number(F.col(m).cast("string")).alias(m) for m in measures),
        null_if_in(F.col(RATING_KEY)).alias(RATING_KEY),
    )
    return numbers.withColumns({m: truncate(finite_or_null(F.col(m)), decimals) for m in measures})


def price_levels(bars: DataFrame) -> DataFrame:
    """Last close and highest close ever per ticker, combined map-side."""
    return bars.groupBy("ticker").agg(
        F.max_by("Close", "Date").alias("last_close"), F.max("Close").alias("all_time_high")
    )


def price_ratios(quotes: DataFrame, bars: DataFrame) -> DataFrame:
    """Current price and its ratios to the all-time and the 52-week high.

    ``quotes`` holds ticker, current_price and high_52w; a ticker without a current
    price falls back to its last close. A ticker with neither is not delivered.
    """
    joined = quotes.join(price_levels(bars), "ticker", "left").withColumn(
        "current_price", F.coalesce("current_price", "last_close")
    )
    price = F.col("current_price")
    return joined.where(price.isNotNull()).select(
        "ticker",
        "current_price",
        ratio_to_high(price, F.col("all_time_high")).alias("all_time_high_ratio"),
        ratio_to_high(price, F.col("high_52w")).alias("high_52w_ratio"),
    )
