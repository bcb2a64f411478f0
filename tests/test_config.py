"""Parameters given as plain data, and sources and sinks that read or write as given."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlegrid.config import Band, IndicatorSpec, PeriodConfig, SignalSpec
from candlegrid.operators.signals import signal_names
from candlegrid.plans.gold import build_gold
from candlegrid.schemas import BARS
from candlegrid.sinks.tables import date_first, write_table
from candlegrid.sources.bars import bronze_bars, read_bars
from candlegrid.sources.tables import declare_external


def test_indicators_run_where_their_key_is():
    assert IndicatorSpec.from_mapping(None) == IndicatorSpec.none()
    assert IndicatorSpec.from_mapping({"DI": {}, "WILLR": {}, "STOCH": {}}) == IndicatorSpec(
        None, None, 14, (14, 3, 3), 14, None, None, (), (), None, None, None
    )
    made = IndicatorSpec.from_mapping(
        {"EMA": {"ema_period": [5]}, "BBANDS": {"timeperiod": 20, "nbdevup": 2, "nbdevdn": 3, "matype": 0}, "FI": {}, "MACD": {"fastperiod": 3}}
    )
    assert made.ema == (5,) and made.bands == Band(20, 2, 3, "sma") and made.force == (2, 13) and made.macd == (3, 26, 9)
    with pytest.raises(ValueError):
        IndicatorSpec.from_mapping({"STOCH": {"slowk_matype": 1}})


def test_signals_from_plain_data():
    assert SignalSpec.from_mapping(None) == SignalSpec.from_mapping({}) == SignalSpec()
    made = SignalSpec.from_mapping(
        {"input_price_1": "High", "extrema_FI_2_gap": 7, "search_quantity": 3, "pair_1_threshold": [20, 50], "side_pair_2": "Trend", "indicator_pair_3": ["Up", "Down"]}
    )
    assert (made.price, made.force_gap, made.lookback, made.price_gap) == ("High", 7, 3, 5)
    assert made.divergence_1 == (("MACD_hist", 20.0), ("FI_13", 50.0))
    assert made.sides == ("Side_1", "Trend", "Side_3") and (made.bull_column, made.bear_column) == ("Up", "Down")
    with pytest.raises(ValueError):
        SignalSpec.from_mapping({"extrema_gap": 5})


def a_year(spark):
    day = F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int"))
    wave = F.round(F.sin(F.col("id") / 9) * 20 + 100 + F.col("id") % 7, 2)
    prices = {c: wave + k for k, c in enumerate(("Open", "High", "Low", "Close", "Adj Close"))}
    rest = {"Volume": F.col("id") + 1.0, "Dividends": F.lit(0.0), "Stock Splits": F.lit(0.0), "ticker": F.lit("A")}
    bars = spark.range(300).select(day.alias("Date"), *(c.alias(n) for n, c in {**prices, **rest}.items()))
    return bars.withColumn("created_at", F.lit("2024-01-01").cast("timestamp_ntz"))


def test_gold_by_parameters_of_a_period(spark):
    signals = {"side_pair_1": "First", "extrema_price_gap": 1, "extrema_price_prominence": 0}
    daily = PeriodConfig.from_mapping(None, signals)
    assert "First" in signal_names(daily.signals)
    gold = build_gold(a_year(spark), {"D": daily})
    assert "First" in gold.columns and "Side_1" in gold.columns
    plain = build_gold(a_year(spark))
    many, few = (g.where("period = 'D' and price_Peak").count() for g in (gold, plain))
    assert many > few
    weekly = [g.where("period = 'W'").drop("First").sort("Date").select(plain.columns).collect() for g in (gold, plain)]
    assert weekly[0] == weekly[1]


def test_bars_from_delivery_to_a_named_table(spark, tmp_path):
    delivered = a_year(spark).withColumn("Date", F.col("Date").cast("timestamp")).drop("created_at")
    batch = F.lit(dt.datetime(2024, 2, 3)).cast("timestamp_ntz")
    bronze = bronze_bars(delivered, batch)
    assert dict(bronze.dtypes)["Date"] == "date" and bronze.first().created_at == dt.datetime(2024, 2, 3)
    path = str(tmp_path / "bars")
    write_table(bronze, path, ["ticker"])
    read = read_bars(spark, path)
    assert set(read.columns) == set(BARS.names) and read.where("ticker = 'A'").count() == 300
    assert date_first(read.withColumn("Date", F.col("Date").cast("string"))).dtypes[0] == ("Date", "date")
    declare_external(spark, "bars_by_name", path, BARS)
    assert spark.sql("SELECT count(*) FROM bars_by_name WHERE Date >= DATE '2023-10-01'").first()[0] == 27
    with pytest.raises(FileNotFoundError):
        declare_external(spark, "none", str(tmp_path / "none"))
