"""Rule-based screen of companies: ordered rules, first match wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A rule is a label and the conditions that must all hold, as SQL predicates over the
# fundamentals columns. Labels, thresholds and tickers, in rule order.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    (
        "HighGrowth",
        (
            "market_cap >= 1000000000D",
            "price_to_sales BETWEEN 2D AND 10D",
            "roe > 0.05D AND roe <= 0.25D",
            "current_ratio >= 2.5D",
            "debt_to_equity <= 10D",
            "roa_ttm > 0D",
            "eps_ttm > 0D",
            "operating_cash_flow > 0D",
            "institutional_pct >= 0.4D AND institutional_pct < 0.95D",
            "analyst_rating_mean <= 3D",
        ),
    ),
    (
        "SteadyGrowth",
        (
            "market_cap >= 400000000D",
            "price_to_sales BETWEEN 2D AND 7D",
            "roe > 0.15D AND roe <= 0.25D",
            "current_ratio >= 2D",
            "debt_to_equity <= 10D",
            "roa_ttm > 0D",
            "eps_ttm > 0D",
            "operating_cash_flow > 0D",
            "current_price >= 15D",
            "annual_revenue >= 50000000D",
            "institutional_pct >= 0.4D AND institutional_pct < 0.95D",
            "analyst_rating_mean <= 2D",
        ),
    ),
    (
        "Distressed",
        (
            "price_to_sales <= 1.5D",
            "roe > 0.15D AND roe <= 0.25D",
            "current_ratio >= 1.1D",
            "debt_to_equity <= 50D",
            "roa_ttm > 0D",
            "eps_ttm > 0D",
            "current_price > 0D",
            "annual_revenue >= 50000000D",
            "avg_daily_volume_3m >= 50000D",
            "institutional_pct >= 0.4D AND institutional_pct < 0.95D",
            "analyst_rating_mean >= 3D",
        ),
    ),
    (
        "Super",
        (
            "change_52w >= 3D",
            "high_52w_ratio >= 0.9D",
            "current_price >= 15D",
            "avg_daily_volume_3m >= 50000D",
            "institutional_pct >= 0.4D AND institutional_pct < 0.95D",
            "analyst_rating_mean <= 2D",
            "analyst_rating_key IS NOT NULL",
        ),
    ),
    ("Magnificent_8", ("ticker IN ('AAPL', 'MSFT', 'GOOGL', 'AMZN', 'NVDA', 'META', 'TSLA', 'NFLX')",)),
    ("ETF_1", ("ticker IN ('QQQ', 'SPY', 'DIA')",)),
)


def classify(rules: Sequence[tuple[str, Sequence[str]]] = RULES) -> Column:
    """Label of the first rule that holds; NULL when none does."""
    label: Column | None = None
    for name, conditions in rules:
        holds = F.expr(" AND ".join(f"({c})" for c in conditions))
        label = F.when(holds, name) if label is None else label.when(holds, name)
    return label


def screen(fundamentals: DataFrame, rules: Sequence[tuple[str, Sequence[str]]] = RULES) -> DataFrame:
    """Companies of one batch that a rule selects. A narrow plan: no exchange.

    Unmatched rows leave through the generator instead of a filter: a filter on the label
    would be pushed down with the whole rule text in it and evaluate every rule twice.
    """
    label = F.array_compact(F.array(classify(rules)))
    return fundamentals.select("created_at", "ticker", F.explode(label).alias("is_selected"))
