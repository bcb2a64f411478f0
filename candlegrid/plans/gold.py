"""Silver bars to gold: resample, indicators and signals for all periods in one plan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.config import PERIODS, Period, PeriodConfig
from candlegrid.functions.numeric import truncate
from candlegrid.operators.indicators import (
    band_columns,
    indicator_columns,
    recursive_fields,
    recursive_step,
    window_columns,
)
from candlegrid.operators.resample import resample
from candlegrid.operators.series_pass import series_pass
from candlegrid.operators.signals import position_fields, position_step, signal_columns, signal_names

BASE = (
    "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends",
    "Stock Splits", "created_at", "ticker", "period",
)
DAILY_ONLY = ("Dividends", "Stock Splits")


def period_series(
    silver: DataFrame,
    periods: Iterable[Period] = PERIODS,
    empty_bins: str = "drop",
) -> DataFrame:
    """Daily bars as they are plus the resampled periods, keyed by (ticker, period, Date).

    Dividends and Stock Splits are NULL outside the daily period. Empty bins are
    dropped unless asked for: a bar without prices would blank every recursive
    indicator after it. The bars are exchanged on ticker once, both the daily rows and
    the resampled ones are built from that exchange, and their union keeps its
    partitioning.
    """
    periods = list(periods)
    by_ticker = silver.repartition("ticker")
    parts = []
    if any(p.unit == "day" for p in periods):
        parts.append(by_ticker.withColumn("period", F.lit("D")).select(*BASE))
    slow = [p for p in periods if p.unit != "day"]
    if slow:
        parts.append(resample(by_ticker, slow, empty_bins, blank=DAILY_ONLY).select(*BASE))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def analyse(series: DataFrame, config: PeriodConfig = PeriodConfig()) -> DataFrame:
    """Indicators and signals of every series: one exchange, one sort, one grouped pass."""
    ind, sig = config.indicators, config.signals
    base = series.columns
    windowed, helpers = window_columns(series, ind)
    unused = [h for h in helpers if not h.startswith(("_sd_", "_mean_"))]
    passed = series_pass(
        windowed,
        [recursive_step(ind), position_step(sig)],
        recursive_fields(ind) + position_fields(sig),
        dropped=unused,
    )
    marked = signal_columns(band_columns(passed, ind), sig)
    return marked.select(*base, *indicator_columns(ind), *signal_names(sig))


def truncate_measures(df: DataFrame, decimals: int = 2) -> DataFrame:
    """Cut every floating-point column toward zero at ``decimals`` places."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: truncate(F.col(c), decimals) for c in doubles}) if doubles else df


def build_gold(
    silver: DataFrame,
    configs: Mapping[str, PeriodConfig] | None = None,
    empty_bins: str = "drop",
) -> DataFrame:
    """Gold table of all periods, truncated to two places as it is stored.

    ``configs`` maps period codes to parameters; periods left out use the
    defaults. Periods with equal parameters share one plan, so in the usual case all
    seven go through a single grouped pass.
    """
    by_config: dict[PeriodConfig, list[Period]] = {}
    for p in PERIODS:
        by_config.setdefault((configs or {}).get(p.code, PeriodConfig()), []).append(p)
    gold: DataFrame | None = None
    for config, periods in by_config.items():
        part = analyse(period_series(silver, periods, empty_bins), config)
        gold = part if gold is None else gold.unionByName(part, allowMissingColumns=True)
    return truncate_measures(gold)
