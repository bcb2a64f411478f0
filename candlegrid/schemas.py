"""Declared schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

_DOUBLE, _STRING, _DATE, _BOOL, _LONG, _TS = (
    T.DoubleType(),
    T.StringType(),
    T.DateType(),
    T.BooleanType(),
    T.LongType(),
    T.TimestampType(),
)


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


SYMBOLS = _struct(
    ("cik", _LONG),
    ("ticker", _STRING),
    ("title", _STRING),
    ("last_updated", _TS),
    ("is_active", _BOOL),
)

# Measures of the fundamentals table, in stored order.
MEASURES = (
    "market_cap", "trailing_pe", "forward_pe", "price_to_sales", "current_ratio",
    "debt_to_equity", "roe", "roa_ttm", "eps_ttm", "eps_growth", "eps_forward",
    "net_income", "operating_cash_flow", "revenue_growth", "annual_revenue",
    "current_price", "low_52w", "high_52w", "change_52w", "all_time_high_ratio",
    "high_52w_ratio", "avg_daily_volume_3m", "institutional_pct", "analyst_rating_mean",
)
RATING_KEY = "analyst_rating_key"

FUNDAMENTALS = _struct(
    ("created_at", _DATE),
    ("ticker", _STRING),
    *((m, _DOUBLE) for m in MEASURES),
    (RATING_KEY, _STRING),
)

SCREEN = _struct(("created_at", _DATE), ("ticker", _STRING), ("is_selected", _STRING))

PRICE_COLUMNS = ("Open", "High", "Low", "Close", "Adj Close", "Volume")

BARS = _struct(
    ("Date", _DATE),
    *((c, _DOUBLE) for c in PRICE_COLUMNS),
    ("Dividends", _DOUBLE),
    ("Stock Splits", _DOUBLE),
    ("created_at", _TS),
    ("ticker", _STRING),
)

# Indicator and signal columns of the gold table, in stored order.
INDICATOR_COLUMNS = (
    "ADX", "MACD", "MACD_signal", "MACD_hist", "PLUS_DI", "MINUS_DI", "STOCH_slowk",
    "STOCH_slowd", "WILLR", "upperband", "middleband", "lowerband", "upper_1_7",
    "lower_1_7", "EMA13", "EMA26", "SMA50", "SMA200", "ATR", "FI", "FI_2", "FI_13",
    "Bull_Power", "Bear_Power",
)
SIGNAL_COLUMNS = (
    ("EMA_bullbear", _STRING), ("EMA13_slope", _DOUBLE), ("EMA13_trend", _STRING),
    ("price_Peak", _BOOL), ("price_Trough", _BOOL), ("Higher_Peak", _BOOL),
    ("Lower_Trough", _BOOL), ("price_search", _LONG), ("FI_2_Peak", _BOOL),
    ("FI_2_Trough", _BOOL), ("FI_13_diff", _DOUBLE), ("FI_13_Peak", _BOOL),
    ("FI_13_Trough", _BOOL), ("MACD_hist_trend", _STRING), ("FI_13_trend", _STRING),
    ("MACD_hist_trend_pair", _STRING), ("FI_13_trend_pair", _STRING),
    ("Bull_Power_trend", _STRING), ("Bear_Power_trend", _STRING),
    ("Bull_Power_trend_pair", _STRING), ("Bear_Power_trend_pair", _STRING),
    ("Side_1", _STRING), ("Side_2", _STRING), ("Side_3", _STRING),
)

GOLD = _struct(
    ("Date", _DATE),
    *((c, _DOUBLE) for c in PRICE_COLUMNS),
    ("Dividends", _DOUBLE),
    ("Stock Splits", _DOUBLE),
    ("created_at", _TS),
    ("ticker", _STRING),
    ("period", _STRING),
    *((c, _DOUBLE) for c in INDICATOR_COLUMNS),
    *SIGNAL_COLUMNS,
)
