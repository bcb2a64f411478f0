"""Bronze bars to silver bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlegrid.functions.numeric import nan_to_null
from candlegrid.schemas import PRICE_COLUMNS

BAR_COLUMNS = (
    "Date", *PRICE_COLUMNS, "Dividends", "Stock Splits", "created_at", "ticker",
)


def _complete() -> Column:
    """All six price columns hold a number."""
    ok = F.lit(True)
    for c in PRICE_COLUMNS:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    return ok


def clean_bars(raw: DataFrame) -> DataFrame:
    """Keep bars whose six price columns are all present; Date becomes a date.

    Dividends and Stock Splits may be missing. A narrow plan: no exchange.
    """
    optional = {"Dividends", "Stock Splits"}
    return raw.where(_complete()).select(
        F.to_date("Date").alias("Date"),
        *(nan_to_null(F.col(c)).alias(c) if c in optional else F.col(c) for c in BAR_COLUMNS[1:]),
    )


def clean_report(raw: DataFrame) -> DataFrame:
    """Raw, kept and dropped rows per ticker, in one partial-aggregated pass."""
    return (
        raw.groupBy("ticker")
        .agg(F.count("*").alias("raw_count"), F.count_if(_complete()).alias("cleaned_count"))
        .withColumn("dropped_count", F.col("raw_count") - F.col("cleaned_count"))
    )


def last_bar_per_day(bars: DataFrame) -> DataFrame:
    """At most one bar per ticker and day: the one stamped last.

    Silver is keyed by (ticker, Date), and the per-ticker stages count on it: a
    series then has no more rows than the calendar has days. Use this on sources
    that may repeat a day. The aggregate combines map-side, so a ticker that
    repeats its days many times is thinned before anything is shuffled.
    """
    rest = [c for c in bars.columns if c not in ("ticker", "Date")]
    order = F.struct("created_at", *(c for c in rest if c != "created_at"))
    return (
        bars.groupBy("ticker", "Date")
        .agg(F.max_by(F.struct(*rest), order).alias("_bar"))
        .select(*(F.col(c) if c in ("ticker", "Date") else F.col("_bar")[c].alias(c) for c in bars.columns))
    )
