"""Price, symbol and fundamentals tables derived from the driver tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlegrid.config import PERIODS, Period
from candlegrid.plans.gold import period_series
from candlegrid.schemas import PRICE_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _trade_order() -> Column:
    """l_orderkey, l_linenumber, price and discount packed into one fixed-width number.

    Trades equal in all four are alike in every value taken from them. A fixed-width
    order keeps min_by and max_by in hash aggregation, which a struct would not.
    """
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    low = (F.col("l_linenumber").cast("bigint") * 10**9 + cents) * 100 + F.round(F.col("l_discount") * 100).cast("bigint")
    return F.col("l_orderkey").cast("decimal(19,0)") * F.lit(10**12).cast("decimal(13,0)") + low.cast("decimal(19,0)")


def _daily(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """The trades of a ticker are laid out by one exchange, in which the fold and all that goes by ticker after it take place.

    A day has little more than one trade of a ticker, so a fold before an exchange by (ticker, day) would save few rows, and
    write each of them wider and a second time.
    """
    lines = table(spark, sf_dir, "lineitem")
    keys = F.format_string("S%05d", "l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("Date")
    taken = "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    trades = lines.select(*keys, *taken).repartition("ticker").withColumn("_o", _trade_order())
    price, net = F.col("l_extendedprice"), F.col("l_extendedprice") * (1 - F.col("l_discount"))
    stamp = lines.select(F.max("l_shipdate")).scalar()
    folded = trades.groupBy("ticker", "Date").agg(
        F.min_by(price, "_o").alias("Open"),
        F.max(price * (1 + F.col("l_tax"))).alias("High"),
        F.min(net).alias("Low"),
        F.max_by(price, "_o").alias("Close"),
        F.max_by(net, "_o").alias("Adj Close"),
        F.sum("l_quantity").alias("Volume"),
        F.max("l_tax").alias("Dividends"),
        *extra,
    )
    return folded.withColumn("Stock Splits", F.lit(0.0)).withColumn("created_at", stamp)


BAR = ("Date", *PRICE_COLUMNS, "Dividends", "Stock Splits", "created_at", "ticker")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per supplier and ship date, folded from the line items and laid out by ticker."""
    return _daily(spark, sf_dir).select(*BAR)


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bars`` with holes: one price column NULL or NaN on some rows."""
    slot = F.col("_order") % 97

    def holed(i: int, c: str) -> Column:
        value = F.when(slot == i, F.lit(None).cast("double"))
        if c == "Close":
            value = value.when(slot == 6, F.lit(float("nan")))
        return value.otherwise(F.col(c)).alias(c)

    return _daily(spark, sf_dir, F.max("l_orderkey").alias("_order")).select(
        "Date",
        *(holed(i, c) for i, c in enumerate(PRICE_COLUMNS)),
        "Dividends",
        "Stock Splits",
        "created_at",
        "ticker",
    )


def bars_as_of(spark: SparkSession, sf_dir: str) -> Column:
    """Latest ship date, as an uncorrelated scalar subquery."""
    return table(spark, sf_dir, "lineitem").select(F.to_date(F.max("l_shipdate"))).scalar()


def all_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of all seven periods, without indicators."""
    return period_series(bars(spark, sf_dir))


def gold_sides(spark: SparkSession, sf_dir: str, periods: Iterable[Period] = PERIODS) -> DataFrame:
    """Periods with three simple sides, to exercise the as-of join on its own."""
    o, c = F.col("Open"), F.col("Close")

    def side(up: Column, down: Column) -> Column:
        return F.when(up, "Long").when(down, "Short")

    return period_series(bars(spark, sf_dir), periods).select(
        "ticker",
        "Date",
        "period",
        side(c > o, c < o).alias("Side_1"),
        side(c > o * 1.25, c < o * 0.75).alias("Side_2"),
        side(F.col("High") > 2 * F.col("Low"), F.col("Low") == c).alias("Side_3"),
    )


def symbols(spark: SparkSession, sf_dir: str, *, old: bool) -> DataFrame:
    """Symbol list of an earlier or a later day; the two overlap."""
    keep = (F.col("c_custkey") % 5 != 0) if old else (F.col("c_custkey") % 7 != 0)
    day = "2001-01-01" if old else "2001-06-01"
    return (
        table(spark, sf_dir, "customer")
        .where(keep)
        .select(
            F.col("c_custkey").alias("cik"),
            F.format_string("C%06d", "c_custkey").alias("ticker"),
            F.col("c_name").alias("title"),
            F.lit(day).cast("timestamp").alias("last_updated"),
            ((F.col("c_custkey") % 11 != 0) | F.lit(not old)).alias("is_active"),
        )
    )


# One passing profile per rule 1..4 (measure -> value by template).
PROFILE: dict[str, tuple[float, float, float, float]] = {
    "market_cap": (2e9, 5e8, 1e8, 3e8),
    "trailing_pe": (20.5, 18.25, 6.125, 80.0625),
    "forward_pe": (18.5, 16.0, 7.5, 60.0),
    "price_to_sales": (5.0, 4.0, 1.0, 12.0),
    "current_ratio": (3.0, 2.25, 1.5, 1.0),
    "debt_to_equity": (5.0, 6.0, 40.0, 120.0),
    "roe": (0.1, 0.2, 0.2, 0.01),
    "roa_ttm": (0.05, 0.04, 0.02, -0.01),
    "eps_ttm": (2.0, 1.5, 0.5, -0.25),
    "eps_growth": (0.2, 0.1, -0.3, 1.5),
    "eps_forward": (2.5, 1.75, 0.4, 0.1),
    "net_income": (3e8, 6e7, 2e6, -1e6),
    "operating_cash_flow": (4e8, 7e7, 3e6, -5e5),
    "revenue_growth": (0.3, 0.12, -0.05, 0.9),
    "annual_revenue": (6e8, 2e8, 9e7, 1e7),
    "current_price": (10.0, 25.0, 4.0, 60.0),
    "low_52w": (6.0, 18.0, 2.0, 11.0),
    "high_52w": (14.0, 30.0, 9.0, 62.0),
    "change_52w": (0.4, 0.2, -0.5, 4.0),
    "all_time_high_ratio": (0.5, 0.75, 0.25, 0.9),
    "high_52w_ratio": (0.7, 0.8, 0.4, 0.95),
    "avg_daily_volume_3m": (40000.0, 45000.0, 80000.0, 90000.0),
    "institutional_pct": (0.6, 0.7, 0.5, 0.45),
    "analyst_rating_mean": (2.5, 1.8, 3.5, 1.5),
}
# Per template, the measure put just outside its limit in slots 1..12.
BREAKS: tuple[tuple[tuple[str, float], ...], ...] = (
    (
        ("market_cap", 999999999.9999), ("price_to_sales", 1.9995), ("price_to_sales", 10.001),
        ("roe", 0.05), ("roe", 0.251), ("current_ratio", 2.4999), ("debt_to_equity", 10.001),
        ("roa_ttm", 0.0), ("eps_ttm", 0.0009), ("operating_cash_flow", 0.0),
        ("institutional_pct", 0.95), ("analyst_rating_mean", 3.001),
    ),
    (
        ("market_cap", 399999999.9999), ("price_to_sales", 1.999), ("price_to_sales", 7.001),
        ("roe", 0.15), ("current_ratio", 1.9999), ("debt_to_equity", 10.002),
        ("roa_ttm", 0.0), ("current_price", 14.9999), ("annual_revenue", 49999999.0),
        ("institutional_pct", 0.3999), ("institutional_pct", 0.951), ("analyst_rating_mean", 2.001),
    ),
    (
        ("price_to_sales", 1.501), ("roe", 0.15), ("roe", 0.2515), ("current_ratio", 1.099),
        ("debt_to_equity", 50.001), ("roa_ttm", 0.0), ("eps_ttm", -0.001),
        ("current_price", 0.0), ("annual_revenue", 49999999.9),
        ("avg_daily_volume_3m", 49999.0), ("institutional_pct", 0.95),
        ("analyst_rating_mean", 2.999),
    ),
    (
        ("change_52w", 2.999), ("high_52w_ratio", 0.899), ("current_price", 14.999),
        ("avg_daily_volume_3m", 49999.9), ("institutional_pct", 0.399),
        ("institutional_pct", 0.9501), ("analyst_rating_mean", 2.001),
        ("change_52w", 3.0), ("high_52w_ratio", 0.9), ("institutional_pct", 0.4),
        ("analyst_rating_mean", 2.0), ("avg_daily_volume_3m", 50000.0),
    ),
)
# Measure that is missing in slot 13, by template; tickers of rules 5 and 6.
MISSING = ("market_cap", "annual_revenue", "roe", "change_52w")
LISTED = ("AAPL", "MSFT", "GOOGL", "AMZN", "NVDA", "META", "TSLA", "NFLX", "QQQ", "SPY", "DIA")


def fundamentals(spark: SparkSession, sf_dir: str, day: str = "2001-06-01") -> DataFrame:
    """Company measures built from the customer key alone."""
    k = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k >= len(LISTED), k % 4).alias("template"),
        (F.floor(k / 4) % 14).alias("slot"),
    )
    ticker = F.format_string("C%06d", k)
    for i, name in enumerate(LISTED):
        ticker = F.when(k == i, F.lit(name)).otherwise(ticker)
    # 56 rows whatever the scale
    return customers.join(F.broadcast(_profiles(spark)), ["template", "slot"], "left").select(
        F.lit(day).cast("date").alias("created_at"),
        ticker.alias("ticker"),
        *PROFILE,
        F.when(k % 13 == 0, "none").when(k % 17 == 0, "None").otherwise("buy").alias("analyst_rating_key"),
        "c_custkey",
    )


def _profiles(spark: SparkSession) -> DataFrame:
    """Measures of each template in each slot."""
    rows = []
    for t in range(4):
        for slot in range(14):
            row: dict[str, float | None] = {m: v[t] for m, v in PROFILE.items()}
            if 1 <= slot <= 12:
                measure, value = BREAKS[t][slot - 1]
                row[measure] = value
            elif slot == 13:
                row[MISSING[t]] = None
            rows.append((t, slot, *row.values()))
    columns = ", ".join(f"{m} double" for m in PROFILE)
    return spark.createDataFrame(rows, f"template bigint, slot bigint, {columns}")


def fundamentals_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fundamentals`` as it arrives: measures as text, with words for missing values."""
    base = fundamentals(spark, sf_dir)
    slot = F.col("c_custkey") % 11
    words = {3: ("trailing_pe", "Infinity"), 5: ("forward_pe", "None"), 7: ("eps_growth", "none"), 9: ("revenue_growth", "n/a"), 10: ("trailing_pe", "-Infinity")}

    def text(m: str) -> Column:
        value = F.col(m).cast("string")
        for s, (name, word) in words.items():
            if name == m:
                value = F.when(slot == s, F.lit(word)).otherwise(value)
        return value.alias(m)

    return base.select("created_at", "ticker", *(text(m) for m in PROFILE), "analyst_rating_key")
