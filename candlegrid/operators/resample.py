"""Daily bars to weekly and monthly bars."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlegrid.config import Period
from candlegrid.functions.calendar import (
    bin_label,
    bins_between,
    label_after,
    month_index,
    week_end,
)

OHLCV = ("Open", "High", "Low", "Close", "Adj Close", "Volume")


def _ohlcv(first, last):
    """Bar aggregates over rows ordered by ``first`` / ``last``; missing prices are skipped."""

    def seen(c: str, order):
        return F.when(F.col(c).isNotNull(), order)

    return [
        F.min_by("Open", seen("Open", first)).alias("Open"),
        F.max("High").alias("High"),
        F.min("Low").alias("Low"),
        F.max_by("Close", seen("Close", last)).alias("Close"),
        F.max_by("Adj Close", seen("Adj Close", last)).alias("Adj Close"),
        F.coalesce(F.sum("Volume"), F.lit(0.0)).alias("Volume"),
    ]


def resample(
    bars: DataFrame,
    periods: Iterable[Period],
    empty_bins: str = "keep",
    blank: tuple[str, ...] = (),
) -> DataFrame:
    """First open, highest high, lowest low, last closes and summed volume per bin.

    All asked-for periods come out of one plan. Days are first folded into
    (week, month) pieces -- every weekly or monthly bin is a union of whole pieces --
    so the fold runs map-side and only about a quarter of the rows goes on to be
    anchored, spread over the periods and folded again. That second fold is
    already partitioned by ticker and needs no exchange of its own. Bars that
    arrive partitioned by ticker are not exchanged at all.

    ``empty_bins``: "keep" adds a bar without prices and with zero volume for
    each interior bin without days, "drop" leaves such bins out. ``blank`` columns
    mean nothing beyond a day and come out NULL; they are still read, so that a caller
    that also needs them daily gets both results from one exchange.
    """
    periods = [p for p in periods if p.unit != "day"]
    if not periods:
        raise ValueError("resample needs at least one weekly or monthly period")
    if empty_bins not in ("keep", "drop"):
        raise ValueError(f"empty_bins must be 'keep' or 'drop', not {empty_bins!r}")

    day = F.col("Date")
    pieces = (
        bars.select("ticker", "Date", *OHLCV, "created_at", *blank)
        .groupBy("ticker", week_end(day).alias("_week"), month_index(day).alias("_month"))
        .agg(
            F.min("Date").alias("_first"),
            F.max("Date").alias("_last"),
            F.min_by("created_at", "Date").alias("created_at"),
            *(F.max(c).alias(c) for c in blank),
            *_ohlcv(day, day),
        )
    )
    whole = Window.partitionBy("ticker")
    anchored = pieces.withColumn("_anchor", F.min("_first").over(whole)).withColumn(
        "created_at", F.min_by("created_at", "_first").over(whole)
    )
    labelled = anchored.select(
        "*",
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(p.code).alias("period"),
                        bin_label(F.col("_first"), F.col("_anchor"), p).alias("Date"),
                    )
                    for p in periods
                )
            )
        ).alias("_bin"),
    )
    binned = (
        labelled.groupBy("ticker", F.col("_bin.period").alias("period"), F.col("_bin.Date").alias("Date"))
        .agg(
            F.first("created_at").alias("created_at"),
            *(F.nullif(F.max(c), F.max(c)).alias(c) for c in blank),
            *_ohlcv(F.col("_first"), F.col("_last")),
        )
        .select("Date", *OHLCV, *blank, "created_at", "ticker", "period")
    )
    return binned if empty_bins == "drop" else _fill_gaps(binned, periods)


def _fill_gaps(binned: DataFrame, periods: list[Period]) -> DataFrame:
    """Emit each bar followed by the empty bins up to the next one."""
    series = Window.partitionBy("ticker", "period").orderBy("Date")
    gap = label = None
    for p in periods:
        mine = F.col("period") == p.code
        g = bins_between(F.col("Date"), F.col("_next"), p)
        after = label_after(F.col("Date"), F.col("_k"), p)
        gap = F.when(mine, g) if gap is None else gap.when(mine, g)
        label = F.when(mine, after) if label is None else label.when(mine, after)
    spread = (
        binned.withColumn("_next", F.lead("Date").over(series))
        .withColumn("_gap", F.coalesce(gap, F.lit(1)))
        .withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_gap") - 1)))
    )
    real = F.col("_k") == 0
    return spread.select(
        label.alias("Date"),
        *(F.when(real, F.col(c)).alias(c) for c in OHLCV if c != "Volume"),
        F.when(real, F.col("Volume")).otherwise(0.0).alias("Volume"),
        *(F.col(c) for c in binned.columns if c not in (*OHLCV, "Date", "created_at", "ticker", "period")),
        "created_at",
        "ticker",
        "period",
    )
