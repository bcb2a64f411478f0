"""candlegrid: batch analytics on equity prices and fundamentals, as Spark plans."""

from candlegrid.config import (
    DEFAULT_INDICATORS,
    DEFAULT_SIGNALS,
    PERIODS,
    Band,
    IndicatorSpec,
    Period,
    SignalSpec,
)
from candlegrid.plans.conclusion import entry_conclusion
from candlegrid.plans.gold import build_gold, period_series
from candlegrid.operators.upsert import upsert
from candlegrid.session import build_session

__all__ = [
    "Band",
    "DEFAULT_INDICATORS",
    "DEFAULT_SIGNALS",
    "IndicatorSpec",
    "PERIODS",
    "Period",
    "SignalSpec",
    "build_gold",
    "build_session",
    "entry_conclusion",
    "period_series",
    "upsert",
]
