"""Cleaning, resampling, the series pass and the as-of join against pandas and brute force."""

import datetime as dt
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlegrid.config import PERIODS, IndicatorSpec, PeriodConfig
from candlegrid.operators.asof import asof_many
from candlegrid.operators.clean import clean_bars, clean_report, last_bar_per_day
from candlegrid.operators.indicators import indicators
from candlegrid.operators.resample import resample
from candlegrid.operators.signals import signals
from candlegrid.plans.conclusion import entry_conclusion
from candlegrid.plans.gold import analyse, build_gold, period_series
from candlegrid.schemas import BARS, GOLD

STARTS = {
    "SUN": dt.date(2023, 1, 1),  # a Sunday
    "EOM": dt.date(2023, 1, 31),
    "LEAP": dt.date(2024, 2, 29),
    "GAP": dt.date(2022, 12, 27),
}


def make_bars(days=140):
    rng = np.random.default_rng(7)
    rows = []
    for ticker, start in STARTS.items():
        for i in range(days):
            if ticker == "GAP" and 20 < i < 75:
                continue
            if rng.random() < 0.3 and i:
                continue
            o, c = rng.uniform(20, 90, 2).round(2).tolist()
            rows.append(
                (start + dt.timedelta(days=i), o, max(o, c) + 1, min(o, c) - 1, c, c / 2, float(rng.integers(1, 99)),
                 0.0, 0.0, dt.datetime(2024, 8, 1), ticker)
            )
    return rows


@pytest.fixture(scope="module")
def bars(spark):
    return spark.createDataFrame(make_bars(), BARS).cache()


def pandas_resample(pdf, code):
    parts = []
    for ticker, g in pdf.groupby("ticker"):
        g = g.set_index(pd.to_datetime(g["Date"])).sort_index()
        r = g.resample(code).agg(
            {"Open": "first", "High": "max", "Low": "min", "Close": "last", "Adj Close": "last", "Volume": "sum"}
        )
        parts.append(r.rename_axis("Date").reset_index().assign(ticker=ticker, period=code))
    return pd.concat(parts)


@pytest.mark.parametrize("empty", ["keep", "drop"])
def test_resample_matches_pandas(bars, empty):
    pdf = bars.toPandas()
    want = pd.concat([pandas_resample(pdf, p.code) for p in PERIODS[1:]])
    if empty == "drop":
        want = want[want["Close"].notna()]
    want["Date"] = want["Date"].dt.date
    cols = ["ticker", "period", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume"]
    want = want[cols].sort_values(cols[:3]).reset_index(drop=True)
    got = resample(bars, PERIODS, empty).select(*cols).toPandas().sort_values(cols[:3]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_resample_ignores_row_order_and_partitions(bars):
    a = resample(bars, PERIODS, "drop").toPandas()
    b = resample(bars.orderBy(F.rand(3)).repartition(13), PERIODS, "drop").toPandas()
    keys = ["ticker", "period", "Date"]
    pd.testing.assert_frame_equal(
        a.sort_values(keys).reset_index(drop=True), b.sort_values(keys).reset_index(drop=True)
    )


def test_clean_drops_null_and_nan(spark):
    good = (dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 1.5, 10.0, None, float("nan"), None, "A")
    rows = [good] + [tuple(None if i == k else v for i, v in enumerate(good)) for k in range(1, 7)]
    rows += [tuple(float("nan") if i == k else v for i, v in enumerate(good)) for k in range(1, 7)]
    raw = spark.createDataFrame(rows, BARS)
    kept = clean_bars(raw).collect()
    assert len(kept) == 1 and kept[0]["Dividends"] is None and kept[0]["Stock Splits"] is None
    assert clean_report(raw).collect()[0].asDict() == {
        "ticker": "A", "raw_count": 13, "cleaned_count": 1, "dropped_count": 12,
    }


def test_last_bar_per_day_keeps_the_latest_stamp(spark):
    def bar(close, hour):
        return (dt.date(2024, 1, 2), close, close, close, close, close, 1.0, 0.0, 0.0, dt.datetime(2024, 1, 3, hour), "A")

    got = last_bar_per_day(spark.createDataFrame([bar(1.0, 5), bar(2.0, 9), bar(3.0, 7)], BARS)).collect()
    assert [r["Close"] for r in got] == [2.0]


def test_gold_matches_its_schema_and_two_step_form(bars):
    gold = build_gold(bars)
    assert [(f.name, f.dataType) for f in gold.schema.fields] == [(f.name, f.dataType) for f in GOLD.fields]
    series = period_series(bars)
    keys = ["ticker", "period", "Date"]
    once = analyse(series).toPandas().sort_values(keys).reset_index(drop=True)
    twice = signals(indicators(series)).toPandas().sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(once, twice)
    assert once["Side_3"].notna().any()


def test_per_period_parameters(bars):
    daily_only = {"W": PeriodConfig(indicators=IndicatorSpec(sma=(2,)))}
    gold = build_gold(bars, daily_only)
    seen = gold.groupBy("period").agg(F.count("SMA2").alias("a"), F.count("EMA13").alias("b")).collect()
    by = {r["period"]: r for r in seen}
    assert by["W"]["a"] > 0 and by["D"]["a"] == 0 and by["D"]["b"] > 0


def test_warm_up_of_short_series(spark):
    rows = [r for r in make_bars() if r[-1] == "SUN"]
    for n in (1, 12, 13):
        df = spark.createDataFrame(rows[:n], BARS).withColumn("period", F.lit("D"))
        out = indicators(df)
        assert out.count() == n
        assert out.where("EMA13 IS NOT NULL").count() == max(n - 12, 0)
        assert out.where("upperband IS NOT NULL").count() == max(n - 12, 0)
        assert out.where("FI IS NOT NULL").count() == n


def test_flat_prices(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), *[5.0] * 5, 0.0, 0.0, 0.0, None, "A") for i in range(40)]
    out = indicators(spark.createDataFrame(rows, BARS).withColumn("period", F.lit("D")))
    last = out.orderBy(F.col("Date").desc()).first()
    assert (last["STOCH_slowk"], last["WILLR"], last["PLUS_DI"], last["ADX"], last["FI"]) == (0, 0, 0, 0, 0)
    assert last["upperband"] == last["lowerband"] == last["EMA13"] == 5


def test_series_may_span_arrow_batches(spark, bars):
    want = analyse(period_series(bars)).toPandas()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = analyse(period_series(bars)).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    keys = ["ticker", "period", "Date"]
    pd.testing.assert_frame_equal(
        got.sort_values(keys).reset_index(drop=True), want.sort_values(keys).reset_index(drop=True)
    )


def test_asof_edges(spark):
    day = dt.date(2024, 5, 10)
    probes = spark.createDataFrame([("A", day), ("B", day), ("A", dt.date(2024, 4, 1))], "ticker string, Date date")
    events = spark.createDataFrame(
        [
            ("A", "W", day + dt.timedelta(days=8), "at"),
            ("A", "W", day + dt.timedelta(days=9), "beyond"),
            ("A", "ME", dt.date(1999, 1, 31), "stale"),
            ("C", "W", day, "other"),
        ],
        "ticker string, period string, Date date, Side string",
    )
    got = {
        (r["ticker"], r["Date"]): r for r in asof_many(probes, events, {"W": 8, "ME": 32}, ("Side",)).collect()
    }
    assert len(got) == 3
    assert got["A", day]["W"]["Side"] == "at" and got["A", day]["ME"]["Side"] == "stale"
    assert got["A", dt.date(2024, 4, 1)]["W"] is None
    assert got["B", day]["W"] is None and got["B", day]["ME"] is None


def test_conclusion_has_29_columns_and_drops_the_latest_day(spark, bars):
    gold = build_gold(bars)
    as_of = F.lit(dt.date(2024, 8, 1))
    out = entry_conclusion(gold, as_of)
    assert len(out.columns) == 29
    latest = gold.where("period = 'D'").groupBy("ticker").agg(F.max("Date").alias("d"))
    assert out.join(latest, "ticker").where("Date_D >= d").count() == 0
    days = gold.where("period = 'D'").where(F.col("Date") >= dt.date(2022, 8, 1)).count()
    assert out.count() == days - 4


def test_one_exchange_feeds_daily_and_slow_periods(spark, bars):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = build_gold(bars)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert sum("ReusedExchange" in line for line in exchanges) == 1
    assert len(exchanges) == 2


def test_a_series_that_repeats_a_day_is_refused(spark):
    rows = [(dt.date(2024, 1, d), "A", "D", 2.0, 1.0, 1.5, 10.0) for d in (1, 2, 2)]
    series = spark.createDataFrame(rows, "Date date, ticker string, period string, High double, Low double, Close double, Volume double")
    with pytest.raises(Exception, match="repeats a day"):
        indicators(series, replace(IndicatorSpec.none(), sma=(2,))).collect()


def test_averages_and_stochastic_need_no_python(spark):
    series = spark.createDataFrame([], "Date date, ticker string, period string, High double, Low double, Close double, Volume double")
    spec = replace(IndicatorSpec.none(), sma=(50, 200), stoch=(5, 3, 3), willr=7)
    plan = indicators(series, spec)._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan and "Window" in plan
