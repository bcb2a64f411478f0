"""Every registered query, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlegrid.config import DEFAULT_INDICATORS, DEFAULT_SIGNALS, PERIODS, IndicatorSpec, PeriodConfig, period
from candlegrid.functions.calendar import local_date
from candlegrid.functions.numeric import truncate
from candlegrid.operators.clean import clean_bars, clean_report, last_bar_per_day
from candlegrid.operators.indicators import indicator_columns, indicators
from candlegrid.operators.resample import resample
from candlegrid.operators.screen import screen
from candlegrid.operators.signals import signal_names
from candlegrid.operators.upsert import MergeKeys, merge_counts, merge_report, observed_merge, upsert
from candlegrid.plans import reports
from candlegrid.plans.conclusion import asof_period, entry_conclusion
from candlegrid.plans.fundamentals import normalise, price_ratios
from candlegrid.plans.gold import analyse, build_gold, period_series
from candlegrid.plans.incremental import changed_tickers, refreshed, ticker_digests
from candlegrid.sinks.export import export_table
from candlegrid.sources.incremental import read_changed_files
from candlegrid.sources.symbols import symbols_from_json
from candlegrid.sources.tables import active_tickers, recent_screened_tickers
from workloads import derive
from workloads import oracle as o

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


# --- cleaning and resampling --------------------------------------------------------------
_SIX = '"Open", "High", "Low", "Close", "Adj Close" AS adj_close, "Volume"'


def _six(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, "Open", "High", "Low", "Close", F.col("Adj Close").alias("adj_close"), "Volume")


@register("clean_bars", f'WITH {o.RAW} SELECT ticker, "Date", {_SIX}, "Dividends" FROM raw WHERE {o._COMPLETE}')
def _(spark, sf):
    return _six(clean_bars(derive.raw_bars(spark, sf)), "ticker", "Date", "Dividends")


@register(
    "clean_report",
    f"""WITH {o.RAW} SELECT ticker, count(*) AS raw_count, count(*) FILTER ({o._COMPLETE}) AS cleaned_count,
    count(*) FILTER (NOT ({o._COMPLETE})) AS dropped_count FROM raw GROUP BY ticker""",
)
def _(spark, sf):
    return clean_report(derive.raw_bars(spark, sf))


def _resample_query(code: str) -> Query:
    def run(spark, sf):
        return _six(resample(derive.bars(spark, sf), [period(code)], "drop"), "ticker", "Date")

    return run


for _p in PERIODS[1:]:
    register(f"resample_{_p.code.lower()}", o.resample_sql(_p.code))(_resample_query(_p.code))


@register("resample_keep_empty", o.resample_keep_sql())
def _(spark, sf):
    kept = resample(derive.bars(spark, sf), PERIODS, "keep")
    return kept.select("ticker", "period", "Date", "Open", "High", "Low", "Close", "Volume")


@register(
    "truncate_numeric",
    f"""WITH {o.BARS} SELECT ticker, "Date", trunc("High" * 100) / 100 AS high_2, trunc("Low" * 1000) / 1000 AS low_3,
    trunc(("Close" - "Open") * 100) / 100 + 0.0 AS move_2, trunc("Volume" * 1e12 * 100) / 100 AS volume_2 FROM bars""",
)
def _(spark, sf):
    b = derive.bars(spark, sf)
    return b.select(
        "ticker",
        "Date",
        truncate(F.col("High"), 2).alias("high_2"),
        truncate(F.col("Low"), 3).alias("low_3"),
        truncate(F.col("Close") - F.col("Open"), 2).alias("move_2"),
        truncate(F.col("Volume") * 1e12, 2).alias("volume_2"),
    )


_LINES = """SELECT printf('S%05d', l_suppkey) AS ticker, CAST(l_shipdate AS DATE) AS "Date", l_extendedprice AS "Close",
    l_orderkey AS created_at, l_linenumber AS line, l_quantity AS quantity FROM lineitem"""


@register(
    "last_bar_per_day",
    f"""WITH lines AS ({_LINES}) SELECT ticker, "Date", "Close", created_at, line, quantity FROM lines
    QUALIFY row_number() OVER (PARTITION BY ticker, "Date" ORDER BY created_at DESC, "Close" DESC, line DESC, quantity DESC) = 1""",
)
def _(spark, sf):
    """A source that repeats days: every line item is a bar, the order it belongs to its stamp."""
    lines = derive.table(spark, sf, "lineitem").select(
        F.format_string("S%05d", "l_suppkey").alias("ticker"),
        F.to_date("l_shipdate").alias("Date"),
        F.col("l_extendedprice").alias("Close"),
        F.col("l_orderkey").alias("created_at"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
    )
    return last_bar_per_day(lines)


# --- indicators and signals, over all seven periods -----------------------------------------
def _indicator_query(columns: tuple[str, ...], digits: int, spec: IndicatorSpec) -> Query:
    def run(spark, sf):
        series = period_series(derive.bars(spark, sf)).select("ticker", "period", "Date", "High", "Low", "Close", "Volume")
        out = indicators(series, spec)
        return out.select("ticker", "period", "Date", *(F.round(c, digits).alias(c) for c in columns))

    return run


# what each query asks for; nothing else is computed
_FULL = IndicatorSpec()
INDICATOR_SPECS: dict[str, dict] = {
    "sma": {"sma": _FULL.sma},
    "willr": {"willr": _FULL.willr},
    "stoch": {"stoch": _FULL.stoch},
    "ema": {"ema": _FULL.ema},
    "macd": {"macd": _FULL.macd},
    "atr": {"atr": _FULL.atr},
    "di": {"di": _FULL.di},
    "adx": {"adx": _FULL.adx},
    "force_index": {"force": _FULL.force},
    "bull_bear": {"power": _FULL.power},
    "bbands": {"bands": _FULL.bands},
    "bbands_17": {"inner_bands": _FULL.inner_bands},
}
# name -> columns, decimals compared; six where means of cents fall on the half of four
INDICATOR_GROUPS: dict[str, tuple[tuple[str, ...], int]] = {
    "sma": (("SMA50", "SMA200"), 6),
    "willr": (("WILLR",), 4),
    "stoch": (("STOCH_slowk", "STOCH_slowd"), 4),
    "ema": (("EMA13", "EMA26"), 4),
    "macd": (("MACD", "MACD_signal", "MACD_hist"), 4),
    "atr": (("ATR",), 6),
    "di": (("PLUS_DI", "MINUS_DI"), 4),
    "adx": (("ADX",), 4),
    "force_index": (("FI", "FI_2", "FI_13"), 4),
    "bull_bear": (("Bull_Power", "Bear_Power"), 4),
    "bbands": (("upperband", "middleband", "lowerband"), 4),
    "bbands_17": (("upper_1_7", "lower_1_7"), 4),
}
for _name, (_columns, _digits) in INDICATOR_GROUPS.items():
    register(_name, o.indicator_sql(_columns, _digits))(
        _indicator_query(_columns, _digits, replace(IndicatorSpec.none(), **INDICATOR_SPECS[_name]))
    )


def _shape(c: str) -> Column:
    """Rounded or, for a position, as a double, so that both engines show it alike."""
    if c in ("EMA13_slope", "FI_13_diff"):
        return F.round(c, 4).alias(c)
    return F.col(c).cast("double").alias(c) if c == "price_search" else F.col(c)


#: Signals lean on averages, momentum, force and power; the other indicators aren't computed for them.
FOR_SIGNALS = PeriodConfig(
    IndicatorSpec(adx=None, di=None, stoch=None, willr=None, bands=None, inner_bands=None, sma=())
)


def _signals(spark: SparkSession, sf: str) -> DataFrame:
    series = period_series(derive.bars(spark, sf)).select("ticker", "period", "Date", "High", "Low", "Close", "Volume")
    return analyse(series, FOR_SIGNALS)


def _signal_query(columns: tuple[str, ...]) -> Query:
    def run(spark, sf):
        out = _signals(spark, sf)
        return out.select("ticker", "period", "Date", *(_shape(c) for c in columns))

    return run


SIGNAL_GROUPS: dict[str, tuple[str, ...]] = {
    "ema_cross": ("EMA_bullbear",),
    "ema_trend": ("EMA13_slope", "EMA13_trend"),
    "fi13_spike": ("FI_13_diff", "FI_13_Peak", "FI_13_Trough"),
    "price_extrema": ("price_Peak", "price_Trough"),
    "fi2_extrema": ("FI_2_Peak", "FI_2_Trough"),
    "higher_peaks": ("Higher_Peak", "Lower_Trough", "price_search"),
    "divergence_1": ("MACD_hist_trend", "FI_13_trend", "MACD_hist_trend_pair", "FI_13_trend_pair"),
    "divergence_3": ("Bull_Power_trend", "Bear_Power_trend", "Bull_Power_trend_pair", "Bear_Power_trend_pair"),
    "sides": ("Side_1", "Side_2", "Side_3"),
}
for _name, _columns in SIGNAL_GROUPS.items():
    register(_name, o.signal_sql(_columns))(_signal_query(_columns))

_GOLD_SHOWN = {"ADX": 4, "MACD_hist": 4, "ATR": 6, "EMA26": 4, "FI_13": 4, "upperband": 4, "EMA13_slope": 4}


FOR_GOLD = PeriodConfig()


def _gold_shown(gold: DataFrame) -> DataFrame:
    return gold.select(
        "ticker", "period", "Date", "Close", "Volume",
        *(F.round(c, d).alias(c) for c, d in _GOLD_SHOWN.items()),
        _shape("price_search"), "EMA_bullbear", "Side_1", "Side_2", "Side_3",
    )


@register(
    "gold",
    f"""WITH RECURSIVE {o.SIGNALS} SELECT ticker, period, "Date", c AS "Close", v AS "Volume",
    {", ".join(f'round("{c}", {d}) + 0.0 AS "{c}"' for c, d in _GOLD_SHOWN.items())},
    CAST("price_search" AS DOUBLE) AS "price_search", "EMA_bullbear", "Side_1", "Side_2", "Side_3" FROM signals""",
)
def _(spark, sf):
    return _gold_shown(analyse(period_series(derive.bars(spark, sf)), FOR_GOLD))


_PRICE_COLUMNS = ("Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends", "Stock Splits")
_MEANS = ("SMA50", "SMA200")
_CUT = tuple(c for c in (*indicator_columns(DEFAULT_INDICATORS), "EMA13_slope", "FI_13_diff") if c not in _MEANS)
_WORDS = tuple(c for c in signal_names(DEFAULT_SIGNALS) if c not in ("EMA13_slope", "FI_13_diff", "price_search"))


def _flat(column: str) -> str:
    return column.replace(" ", "_")


@register(
    "gold_stored",
    f"""WITH RECURSIVE {o.SIGNALS},
    bare AS (SELECT *, NULL::DOUBLE AS "Dividends", NULL::DOUBLE AS "Stock Splits" FROM series WHERE period <> 'D' UNION ALL
      SELECT s.*, b."Dividends", 0.0 FROM series s JOIN bars b ON b.ticker = s.ticker AND b."Date" = s.label WHERE s.period = 'D')
    SELECT s.ticker, s.period, s."Date", (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem) AS created_at,
      {", ".join(f'trunc(b."{c}" * 100) / 100 + 0.0 AS "{_flat(c)}"' for c in _PRICE_COLUMNS)},
      {", ".join(f'trunc(s."{c}" * 100) / 100 + 0.0 AS "{c}"' for c in _CUT)},
      {", ".join(f'round(s."{c}" / 100) AS "{c}"' for c in _MEANS)},
      CAST(s."price_search" AS DOUBLE) AS "price_search", {", ".join(f's."{c}"' for c in _WORDS)}
    FROM signals s JOIN bare b ON b.ticker = s.ticker AND b.period = s.period AND s."Date" = b.label""",
)
def _(spark, sf):
    """All 60 columns as they are stored, cut at two places.

    Means over 50 and 200 rows are shown in hundreds: prices have two places, so a mean often lies on a place itself, and
    a sum in another order then falls on the other side of the cut. ``sma`` compares them to six places, uncut.
    """
    gold = build_gold(derive.bars(spark, sf))
    return gold.select(
        "ticker", "period", "Date", F.to_date("created_at").alias("created_at"),
        *(F.col(c).alias(_flat(c)) for c in (*_PRICE_COLUMNS, *_CUT)),
        *(F.round(F.col(c) / 100).alias(c) for c in _MEANS),
        _shape("price_search"), *_WORDS,
    )


# --- gold by changed tickers ------------------------------------------------------------------
def _earlier_bars(spark: SparkSession, sf: str) -> DataFrame:
    """The bars as an earlier run saw them: some tickers lacked their first or last days, some weren't there, some are gone now.

    All are laid out by ticker, the few renamed ones by an exchange of their own, so that none of them is exchanged again."""
    bars = derive.bars(spark, sf)
    number = F.substr("ticker", F.lit(2)).cast("bigint")
    day = F.row_number().over(Window.partitionBy("ticker").orderBy("Date"))
    late = F.col("Date") > F.date_sub(derive.bars_as_of(spark, sf), 30)
    seen = bars.withColumn("_day", day).where(~((number % 7 == 0) & (F.col("_day") <= 5)) & ~((number % 7 == 1) & late)).drop("_day")
    gone = bars.where(number % 13 == 5).withColumn("ticker", F.concat(F.lit("X"), "ticker")).repartition("ticker")
    return seen.where(number % 11 != 3).unionByName(gone)


_EARLIER = f"""{o.BARS},
numbered AS (SELECT *, CAST(substr(ticker, 2) AS BIGINT) AS num, row_number() OVER (PARTITION BY ticker ORDER BY "Date") AS day FROM bars),
earlier AS (SELECT ticker, "Date", "Close", "Volume" FROM numbered WHERE NOT (num % 7 = 0 AND day <= 5) AND num % 11 <> 3
    AND NOT (num % 7 = 1 AND "Date" > (SELECT CAST(max(l_shipdate) AS DATE) - 30 FROM lineitem))
  UNION ALL SELECT 'X' || ticker, "Date", "Close", "Volume" FROM numbered WHERE num % 13 = 5),
later AS (SELECT ticker, "Date", "Close", "Volume" FROM bars),
firsts AS (SELECT ticker, min("Date") AS was FROM earlier GROUP BY ticker),
lasts AS (SELECT ticker, min("Date") AS now FROM later GROUP BY ticker),
differing AS (SELECT DISTINCT ticker FROM (
  (SELECT * FROM earlier EXCEPT ALL SELECT * FROM later) UNION ALL (SELECT * FROM later EXCEPT ALL SELECT * FROM earlier)))"""


@register(
    "changed_tickers",
    f"""WITH {_EARLIER} SELECT ticker, CASE WHEN was IS NULL THEN 'new' WHEN now IS NULL THEN 'gone' WHEN was <> now THEN 'moved' ELSE 'changed' END AS change
    FROM differing LEFT JOIN firsts USING (ticker) LEFT JOIN lasts USING (ticker)""",
)
def _(spark, sf):
    return changed_tickers(ticker_digests(_earlier_bars(spark, sf)), ticker_digests(derive.bars(spark, sf)))


@register("gold_refreshed", SQL["gold"])
def _(spark, sf):
    """The gold of an earlier run with only the changed tickers built anew is the gold of all bars."""

    def shown(bars):
        return analyse(period_series(bars), FOR_GOLD)

    now, before = derive.bars(spark, sf), _earlier_bars(spark, sf)
    changed = changed_tickers(ticker_digests(before), ticker_digests(now))
    return _gold_shown(refreshed(shown(before), now, changed, shown))


@register(
    "period_report",
    f"""WITH {o.SERIES} SELECT period, count(*) AS rows, count(DISTINCT ticker) AS tickers, max(label) AS latest
    FROM series GROUP BY period""",
)
def _(spark, sf):
    return reports.period_report(derive.all_periods(spark, sf))


# --- as-of and conclusion -------------------------------------------------------------------
def _asof_query(code: str) -> Query:
    def run(spark, sf):
        return asof_period(derive.gold_sides(spark, sf, [PERIODS[0], period(code)]), period(code), derive.bars_as_of(spark, sf))

    return run


for _p in PERIODS[1:]:
    register(f"asof_{_p.code.lower()}", o.asof_sql(_p.code))(_asof_query(_p.code))


def real_sides(spark: SparkSession, sf: str) -> DataFrame:
    out = _signals(spark, sf)
    return out.select("ticker", "Date", "period", "Side_1", "Side_2", "Side_3")


@register("entry_conclusion", f"{o.conclusion_body(o.REAL, True)} SELECT * FROM conclusion")
def conclusion_query(spark, sf):
    return entry_conclusion(real_sides(spark, sf), derive.bars_as_of(spark, sf))


_SUFFIXES = [p.suffix for p in PERIODS]
_CONCLUSION_TEXT = (
    ["ticker"]
    + [f"coalesce(strftime(\"Date_{s}\", '%Y-%m-%d'), 'None') AS \"Date_{s}\"" for s in _SUFFIXES]
    + [f"coalesce(\"Side_{i}_{s}\", 'None') AS \"Side_{i}_{s}\"" for i in (1, 2, 3) for s in _SUFFIXES]
)


@register("export_conclusion", f"{o.conclusion_body(o.TOY)} SELECT {', '.join(_CONCLUSION_TEXT)} FROM conclusion")
def _(spark, sf):
    return export_table(entry_conclusion(derive.gold_sides(spark, sf), derive.bars_as_of(spark, sf)), "Date_D")


# --- fundamentals and screen ------------------------------------------------------------------
def _normal(spark: SparkSession, sf: str) -> DataFrame:
    return normalise(derive.fundamentals_text(spark, sf))


@register("fundamentals_normalize", f"WITH {o.NORMALISED} SELECT * FROM normal")
def _(spark, sf):
    return _normal(spark, sf)


@register("screen", f"WITH {o.SCREENED} SELECT * FROM screened")
def _(spark, sf):
    return screen(_normal(spark, sf))


@register(
    "screen_summary",
    f"""WITH {o.SCREENED} SELECT created_at, is_selected, count(*) AS companies,
    CAST(sum(count(*)) OVER (PARTITION BY created_at) AS BIGINT) AS total FROM screened GROUP BY created_at, is_selected""",
)
def _(spark, sf):
    return reports.screen_summary(screen(_normal(spark, sf)))


@register(
    "export_screen",
    f"WITH {o.SCREENED} SELECT strftime(created_at, '%Y-%m-%d') AS created_at, ticker, is_selected FROM screened",
)
def _(spark, sf):
    return export_table(screen(_normal(spark, sf)), "created_at")


@register(
    "price_ratios",
    f"""WITH {o.BARS},
    quotes AS (SELECT printf('S%05d', s_suppkey) AS ticker, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS current_price,
      CASE WHEN s_suppkey % 5 = 0 THEN 0 WHEN s_suppkey % 7 <> 0 THEN s_acctbal * 1.5 END AS high_52w FROM supplier),
    levels AS (SELECT ticker, arg_max("Close", "Date") AS last_close, max("Close") AS top FROM bars GROUP BY ticker),
    priced AS (SELECT ticker, coalesce(current_price, last_close) AS p, top, high_52w FROM quotes LEFT JOIN levels USING (ticker))
    SELECT ticker, p AS current_price, trunc(p / nullif(top, 0) * 100) / 100 + 0.0 AS all_time_high_ratio,
      trunc(p / nullif(high_52w, 0) * 100) / 100 + 0.0 AS high_52w_ratio FROM priced WHERE p IS NOT NULL""",
)
def _(spark, sf):
    k = F.col("s_suppkey")
    quotes = derive.table(spark, sf, "supplier").select(
        F.format_string("S%05d", k).alias("ticker"),
        F.when(k % 3 != 0, F.col("s_acctbal")).alias("current_price"),
        F.when(k % 5 == 0, 0.0).when(k % 7 != 0, F.col("s_acctbal") * 1.5).alias("high_52w"),
    )
    return price_ratios(quotes, derive.bars(spark, sf))


# --- symbols ------------------------------------------------------------------------------------
_SYMBOLS = """
old_symbols AS (SELECT c_custkey AS cik, printf('C%06d', c_custkey) AS ticker, c_name AS title, DATE '2001-01-01' AS last_updated,
  c_custkey % 11 <> 0 AS is_active FROM customer WHERE c_custkey % 5 <> 0),
new_symbols AS (SELECT c_custkey AS cik, printf('C%06d', c_custkey) AS ticker, c_name AS title, DATE '2001-06-01' AS last_updated,
  true AS is_active FROM customer WHERE c_custkey % 7 <> 0)"""


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("last_updated", F.to_date("last_updated"))


@register("active_tickers", f"WITH {_SYMBOLS} SELECT DISTINCT ticker FROM old_symbols WHERE is_active")
def _(spark, sf):
    return active_tickers(derive.symbols(spark, sf, old=True))


@register(
    "recent_screened_tickers",
    f"""WITH {o.SCREENED}, dated AS (SELECT ticker, created_at - CAST(rowid_ * 30 AS INTEGER) AS created_at
      FROM (SELECT s.ticker, s.created_at, CASE WHEN s.ticker LIKE 'C%' THEN CAST(substr(s.ticker, 2) AS BIGINT) % 60 ELSE 0 END AS rowid_ FROM screened s))
    SELECT DISTINCT ticker FROM dated WHERE created_at >= DATE '2001-06-01' - INTERVAL 24 MONTH""",
)
def _(spark, sf):
    digits = F.when(F.col("ticker").startswith("C"), F.expr("try_cast(substr(ticker, 2) AS BIGINT) % 60")).otherwise(0)
    dated = screen(_normal(spark, sf)).withColumn(
        "created_at", F.date_sub("created_at", (digits * 30).cast("int"))
    )
    return recent_screened_tickers(dated, F.lit("2001-06-01").cast("date"))


@register("symbols_from_json", f"WITH {_SYMBOLS} SELECT * FROM new_symbols")
def _(spark, sf):
    # documents of at most 1000 records, however long the list
    record = F.struct(F.col("cik").alias("cik_str"), "ticker", "title")
    documents = (
        derive.symbols(spark, sf, old=False)
        .groupBy(F.floor(F.col("cik") / 1000).alias("part"))
        .agg(
            F.to_json(
                F.map_from_entries(F.collect_list(F.struct(F.col("cik").cast("string"), record)))
            ).alias("value")
        )
    )
    return _dated(symbols_from_json(documents, F.lit("2001-06-01").cast("timestamp")))


@register(
    "upsert_symbols",
    f"""WITH {_SYMBOLS} SELECT * FROM new_symbols UNION ALL
    SELECT cik, ticker, title, last_updated, false FROM old_symbols ANTI JOIN new_symbols USING (cik, ticker)""",
)
def _(spark, sf):
    merged = upsert(
        derive.symbols(spark, sf, old=True),
        derive.symbols(spark, sf, old=False),
        ("cik", "ticker"),
        "mark_inactive",
    )
    return _dated(merged)


# --- upserts --------------------------------------------------------------------------------------
def _fund_old_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    cols = ("created_at", "ticker", "market_cap", "roe", "current_price", "c_custkey")
    old = derive.fundamentals(spark, sf, "2001-05-15").select(*cols)
    day = F.when(F.col("c_custkey") % 3 == 0, F.col("created_at")).otherwise(F.lit("2001-06-01").cast("date"))
    new = (
        derive.fundamentals(spark, sf, "2001-05-15")
        .select(*cols)
        .where(F.col("c_custkey") % 4 != 1)
        .withColumn("created_at", day)
        .withColumn("current_price", F.col("current_price") * 2)
    )
    return old.drop("c_custkey"), new.drop("c_custkey")


_FUND = f"""{o.fundamentals_cte("2001-05-15")},
fund_old AS (SELECT created_at, ticker, market_cap, roe, current_price FROM fundamentals),
fund_new AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN created_at ELSE DATE '2001-06-01' END AS created_at, ticker, market_cap, roe,
  current_price * 2 AS current_price FROM fundamentals WHERE c_custkey % 4 <> 1)"""


@register(
    "upsert_fundamentals",
    f"""WITH {_FUND} SELECT * FROM fund_new
    UNION ALL SELECT * FROM fund_old ANTI JOIN fund_new USING (created_at, ticker)""",
)
def _(spark, sf):
    old, new = _fund_old_new(spark, sf)
    return upsert(old, new, ("created_at", "ticker"))


@register(
    "upsert_screen",
    f"""WITH {o.SCREENED},
    new_screen AS (SELECT * FROM screened),
    old_screen AS (SELECT CASE WHEN length(ticker) % 2 = 0 OR right(ticker, 1) < '5' THEN created_at ELSE created_at - 14 END AS created_at,
      ticker, 'Super' AS is_selected FROM screened)
    SELECT * FROM new_screen UNION ALL SELECT * FROM old_screen ANTI JOIN new_screen USING (created_at, ticker)""",
)
def _(spark, sf):
    new = screen(_normal(spark, sf))
    same = (F.length("ticker") % 2 == 0) | (F.expr("right(ticker, 1)") < "5")
    old = new.select(
        F.when(same, F.col("created_at")).otherwise(F.date_sub("created_at", 14)).alias("created_at"),
        "ticker",
        F.lit("Super").alias("is_selected"),
    )
    return upsert(old, new, ("created_at", "ticker"))


def _prices_old_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    number = F.substr("ticker", F.lit(2)).cast("bigint")
    full = derive.all_periods(spark, sf).select("Date", "ticker", "period", "Close", "Volume")
    cut: Column = F.date_sub(derive.bars_as_of(spark, sf), 30)
    old = full.where(F.col("Date") <= cut).withColumn(
        "Close", F.when(number % 10 == 0, F.col("Close") * 2).otherwise(F.col("Close"))
    )
    return old, full.where(number % 3 != 0)


_PRICES = f"""{o.SERIES},
numbered AS (SELECT label AS "Date", ticker, period, "Close", "Volume", CAST(substr(ticker, 2) AS BIGINT) AS num FROM series),
price_old AS (SELECT "Date", ticker, period, CASE WHEN num % 10 = 0 THEN "Close" * 2 ELSE "Close" END AS "Close", "Volume"
  FROM numbered WHERE "Date" <= (SELECT CAST(max(l_shipdate) AS DATE) - 30 FROM lineitem)),
price_new AS (SELECT "Date", ticker, period, "Close", "Volume" FROM numbered WHERE num % 3 <> 0)"""
_KEYS = ("Date", "ticker", "period")


def _keep_old_ctes(partition: str, ties: str) -> str:
    return f"""{_PRICES},
    touched AS (SELECT DISTINCT ticker FROM price_new),
    provisional AS (SELECT "Date", ticker, period FROM price_old SEMI JOIN touched USING (ticker)
      QUALIFY row_number() OVER (PARTITION BY {partition} ORDER BY "Date" DESC{ties}) <= 2),
    survivors AS (SELECT * FROM price_old ANTI JOIN provisional USING ("Date", ticker, period)),
    fresh AS (SELECT * FROM price_new ANTI JOIN survivors USING ("Date", ticker, period)),
    final AS (SELECT "Date", ticker, period, "Close", "Volume" FROM survivors
      UNION ALL SELECT "Date", ticker, period, "Close", "Volume" FROM fresh)"""


def _keep_old_sql(partition: str, ties: str) -> str:
    return f"WITH {_keep_old_ctes(partition, ties)} SELECT * FROM final"


@register("upsert_prices_keep_old", _keep_old_sql("ticker", ", period DESC"))
def _(spark, sf):
    old, new = _prices_old_new(spark, sf)
    return upsert(old, new, _KEYS, "keep_old")


@register("upsert_prices_keep_old_by_period", _keep_old_sql("ticker, period", ""))
def _(spark, sf):
    old, new = _prices_old_new(spark, sf)
    return upsert(old, new, _KEYS, "keep_old", tail_keys=("ticker", "period"))


_DOOMED = f"""{_PRICES},
mine AS (SELECT * FROM price_old WHERE (ticker, period) IN (SELECT (ticker, period) FROM price_new)),
tail AS (SELECT DISTINCT period, "Date" FROM mine
  QUALIFY row_number() OVER (PARTITION BY ticker, period ORDER BY "Date" DESC) <= 2),
doomed AS (SELECT * FROM mine WHERE (period, "Date") IN (SELECT (period, "Date") FROM tail)),
surviving AS (SELECT * FROM price_old ANTI JOIN doomed USING ("Date", ticker, period))"""


@register(
    "merge_prices",
    f"""WITH {_DOOMED} SELECT * FROM surviving ANTI JOIN price_new USING ("Date", ticker, period)
    UNION ALL SELECT * FROM price_new""",
)
def _(spark, sf):
    old, new = _prices_old_new(spark, sf)
    return upsert(old, new, _KEYS, "delete_tail_merge")


@register(
    "merge_report",
    f"""WITH {_DOOMED},
    merged AS (SELECT n.period, count(s.ticker) AS updated, count(*) - count(s.ticker) AS inserted, count(*) AS merged
      FROM price_new n LEFT JOIN surviving s USING ("Date", ticker, period) GROUP BY n.period),
    gone AS (SELECT period, count(*) AS deleted FROM doomed GROUP BY period)
    SELECT period, coalesce(deleted, 0) AS deleted, updated, inserted, merged FROM merged LEFT JOIN gone USING (period)""",
)
def _(spark, sf):
    return merge_report(*_prices_old_new(spark, sf))


@register("merge_observed", SQL["merge_report"])
def _(spark, sf):
    """The report as it falls out of the run that merges."""
    merged, seen = observed_merge(*_prices_old_new(spark, sf), "merge", [p.code for p in PERIODS])
    merged.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(merge_counts(seen), "period string, deleted long, updated long, inserted long, merged long")


@register(
    "merge_fundamentals",
    f"""WITH {_FUND},
    tail AS (SELECT DISTINCT created_at FROM (SELECT * FROM fund_old SEMI JOIN fund_new USING (ticker))
      QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY created_at DESC) <= 1),
    doomed AS (SELECT * FROM fund_old SEMI JOIN fund_new USING (ticker) SEMI JOIN tail USING (created_at))
    SELECT * FROM fund_new UNION ALL
    SELECT * FROM fund_old ANTI JOIN doomed USING (ticker, created_at) ANTI JOIN fund_new USING (ticker, created_at)""",
)
def _(spark, sf):
    """The same policy over other keys, given as data: no part, one series per ticker, ordered by created_at."""
    old, new = _fund_old_new(spark, sf)
    by = MergeKeys.from_mapping({"series": "ticker", "order": "created_at", "within": []})
    return upsert(old, new, by.keys, "delete_tail_merge", tail_n=1, merge=by)


@register(
    "union_report",
    f"""WITH {_keep_old_ctes("ticker", ", period DESC")}
    SELECT period, count(*) AS rows FROM final GROUP BY ROLLUP (period)""",
)
def _(spark, sf):
    old, new = _prices_old_new(spark, sf)
    return reports.union_report(upsert(old, new, _KEYS, "keep_old"))


# --- ingest ---------------------------------------------------------------------------------------
_INGEST = f"""{o.BARS},
expected AS (SELECT printf('S%05d', s_suppkey) AS ticker, s_suppkey % 2 = 0 AS later FROM supplier
  UNION ALL SELECT 'TSLAp', false UNION ALL SELECT 'LATER', true),
counted AS (SELECT ticker, count(*) AS bars FROM bars GROUP BY ticker),
outcome AS (SELECT ticker, coalesce(bars, 0) AS bars, CASE WHEN bars > 0 THEN 'success' WHEN later THEN 'retry' ELSE 'failed' END AS status
  FROM expected LEFT JOIN counted USING (ticker))"""


def _outcome(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = derive.table(spark, sf, "supplier").select(
        F.format_string("S%05d", "s_suppkey").alias("ticker"), (F.col("s_suppkey") % 2 == 0).alias("rate_limited")
    )
    extra = spark.createDataFrame([("TSLAp", False), ("LATER", True)], "ticker string, rate_limited boolean")
    expected = suppliers.unionByName(extra)
    return reports.ingest_outcome(expected, derive.bars(spark, sf), expected)


@register("ingest_outcome", f"WITH {_INGEST} SELECT * FROM outcome")
def _(spark, sf):
    return _outcome(spark, sf)


@register("ingest_status", f"WITH {_INGEST} SELECT status, count(*) AS tickers FROM outcome GROUP BY status")
def _(spark, sf):
    return reports.ingest_summary(_outcome(spark, sf))


_FILES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


@register(
    "incremental_files", " UNION ALL ".join(f"SELECT '{t}' AS file_stem, count(*) AS rows FROM {t}" for t in _FILES)
)
def _(spark, sf):
    """Rows per changed file, over all days on which a table was last changed."""
    at = [f"{sf}/{t}.parquet" for t in _FILES]
    zone = "UTC"
    stamp = F.col("_metadata.file_modification_time")
    newest = [spark.read.parquet(p).select(local_date(stamp, zone).alias("day")) for p in at]
    days = sorted({r["day"] for f in newest for r in f.distinct().collect()})
    out = None
    for day in days:
        # the tables have no columns in common, so each is read by itself
        for path in at:
            changed = read_changed_files(spark, path, day, zone).select("file_stem")
            out = changed if out is None else out.unionByName(changed)
    return out.groupBy("file_stem").agg(F.count("*").alias("rows"))
