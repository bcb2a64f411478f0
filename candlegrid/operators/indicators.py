"""Technical indicators per (ticker, period) series.

Ranges, moves and deviations are window expressions; averages that carry a running
state run in one pass over the series that follows on the same partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.config import DEFAULT_INDICATORS, Band, IndicatorSpec
from candlegrid.operators import recurrences as rec
from candlegrid.operators.series_pass import ROW, SERIES, Series, row_in_series, series_pass


def _ordered():
    return Window.partitionBy(*SERIES).orderBy("Date")


def _frame(n: int):
    return _ordered().rowsBetween(-(n - 1), Window.currentRow)


def _warm(n: int) -> Column:
    """At least ``n`` rows so far, none of them without a price."""
    return (F.col(ROW) >= n) & (F.col("_priced") == F.col(ROW))


def _add(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(columns)) if columns else df


def _position_in_range(top: Column, value: Column, low: Column) -> Column:
    return F.when(top == low, F.lit(0.0)).otherwise((value - low) / ((top - low) / 100.0))


def _bands(spec: IndicatorSpec) -> list[tuple[Band, str | None, str, str]]:
    """(band, middle column, upper column, lower column) of each band asked for."""
    out: list[tuple[Band, str | None, str, str]] = []
    if spec.bands:
        out.append((spec.bands, "middleband", "upperband", "lowerband"))
    if spec.inner_bands:
        out.append((spec.inner_bands, None, "upper_1_7", "lower_1_7"))
    return out


def window_columns(df: DataFrame, spec: IndicatorSpec) -> tuple[DataFrame, list[str]]:
    """Add every column that a window or row expression can give.

    Returns the frame and the names of the helper columns that only feed the
    recurrences. All frames share one partitioning and one ordering, so there is one
    exchange and one sort.
    """
    high, low, close = F.col("High"), F.col("Low"), F.col("Close")
    ordered = _ordered()
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = {c: F.lag(c, 1).over(ordered) for c in ("High", "Low", "Close")}
    helpers = [ROW, "_priced"]
    first: dict[str, Column] = {
        ROW: row_in_series(),
        "_priced": F.count(close).over(so_far),
    }
    if spec.atr or spec.di or spec.adx:
        first["_true_range"] = F.when(
            before["Close"].isNotNull(),
            F.greatest(high - low, F.abs(high - before["Close"]), F.abs(low - before["Close"])),
        )
        helpers.append("_true_range")
    if spec.di or spec.adx:
        up, down = high - before["High"], before["Low"] - low
        first["_plus_move"] = F.when((up > 0) & (up > down), up).when(up.isNotNull(), 0.0)
        first["_minus_move"] = F.when((down > 0) & (down > up), down).when(up.isNotNull(), 0.0)
        helpers += ["_plus_move", "_minus_move"]
    if spec.force is not None:
        first["FI"] = F.when(F.col(ROW) == 1, F.lit(0.0) * F.col("Volume")).otherwise(
            (close - before["Close"]) * F.col("Volume")
        )
    if spec.willr:
        top, bottom = F.max(high).over(_frame(spec.willr)), F.min(low).over(_frame(spec.willr))
        drop = (top - close) / ((top - bottom) / -100.0)
        first["WILLR"] = F.when(_warm(spec.willr), F.when(top == bottom, 0.0).otherwise(drop))
    if spec.stoch:
        n = spec.stoch[0]
        first["_fast_k"] = F.when(
            _warm(n),
            _position_in_range(F.max(high).over(_frame(n)), close, F.min(low).over(_frame(n))),
        )
        helpers.append("_fast_k")
    for n in {b.n for b, *_ in _bands(spec)}:
        first[f"_sd_{n}"] = F.when(_warm(n), F.stddev_pop(close).over(_frame(n)))
        helpers.append(f"_sd_{n}")
    for n in {b.n for b, *_ in _bands(spec) if b.average == "sma"}:
        first[f"_mean_{n}"] = F.when(_warm(n), F.avg(close).over(_frame(n)))
        helpers.append(f"_mean_{n}")

    for n in spec.sma:
        first[f"SMA{n}"] = F.when(_warm(n), F.avg(close).over(_frame(n)))

    # _row and _priced are read by the others, so they come first
    out = _add(df, {c: first.pop(c) for c in (ROW, "_priced")})
    out = _add(out, first)
    if spec.stoch:
        n, k, d = spec.stoch
        out = out.withColumn("_slow_k", F.when(_warm(n + k - 1), F.avg("_fast_k").over(_frame(k))))
        warm = _warm(n + k + d - 2)
        out = out.withColumns(
            {"STOCH_slowk": F.when(warm, F.col("_slow_k")), "STOCH_slowd": F.when(warm, F.avg("_slow_k").over(_frame(d)))}
        )
        helpers.append("_slow_k")
    return out, helpers


def recursive_step(spec: IndicatorSpec):
    """The recurrences as one step of the grouped pass, over all series of a batch."""

    def step(s: Series) -> dict[str, np.ndarray]:
        out: dict[str, np.ndarray] = {}
        lock = rec.Lockstep(s.rows, s.starts)
        lengths = list(dict.fromkeys(n for n in (spec.adx, spec.di) if n))
        if lengths:
            moves = (s["_plus_move"], s["_minus_move"], s["_true_range"])
            shares = dict(zip(lengths, rec.directions(*moves, lengths, lock), strict=True))
        if spec.adx:
            out["ADX"] = rec.adx_of(*shares[spec.adx], spec.adx, lock)
        if spec.di:
            out["PLUS_DI"], out["MINUS_DI"] = shares[spec.di]
        if spec.atr:
            out["ATR"] = rec.atr(s["_true_range"], spec.atr, lock=lock)
        named = {f"EMA{n}": rec.Ema(s["Close"], n) for n in _ema_lengths(spec)}
        named |= {f"FI_{n}": rec.Ema(s["FI"], n) for n in spec.force or ()}
        lines = rec.macd_lines(s["Close"], *spec.macd[:2]) if spec.macd else []
        if named or lines:
            averages = rec.emas([*named.values(), *lines], lock)
            out |= dict(zip(named, averages, strict=False))
        if spec.macd:
            fast, slow, signal = spec.macd
            out["MACD"], out["MACD_signal"] = rec.macd_signal(averages[-2] - averages[-1], max(fast, slow), signal, lock)
            out["MACD_hist"] = out["MACD"] - out["MACD_signal"]
        if spec.power:
            out["Bull_Power"] = s["High"] - out[f"EMA{spec.power}"]
            out["Bear_Power"] = s["Low"] - out[f"EMA{spec.power}"]
        return out

    return step


def _ema_lengths(spec: IndicatorSpec) -> tuple[int, ...]:
    """EMA lengths to compute: those shown, and those bands and powers lean on."""
    needed = [*spec.ema, *(b.n for b, *_ in _bands(spec) if b.average == "ema")]
    if spec.power:
        needed.append(spec.power)
    return tuple(dict.fromkeys(needed))


def recursive_fields(spec: IndicatorSpec) -> list[tuple[str, T.DataType]]:
    names: list[str] = []
    if spec.adx:
        names.append("ADX")
    if spec.di:
        names += ["PLUS_DI", "MINUS_DI"]
    if spec.atr:
        names.append("ATR")
    if spec.macd:
        names += ["MACD", "MACD_signal", "MACD_hist"]
    names += [f"EMA{n}" for n in _ema_lengths(spec)]
    names += [f"FI_{n}" for n in spec.force or ()]
    if spec.power:
        names += ["Bull_Power", "Bear_Power"]
    return [(n, T.DoubleType()) for n in names]


def band_columns(df: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """Bands around the average that the pass delivered."""
    for band, middle, upper, lower in _bands(spec):
        centre = F.col(f"EMA{band.n}" if band.average == "ema" else f"_mean_{band.n}")
        width = F.col(f"_sd_{band.n}")
        columns = {upper: centre + width * band.up, lower: centre - width * band.down}
        if middle:
            columns[middle] = F.when(width.isNotNull(), centre)
        df = df.withColumns(columns)
    return df


def indicator_columns(spec: IndicatorSpec) -> list[str]:
    """Names of the indicators a spec gives, in stored order."""
    names: list[str] = []
    names += ["ADX"] if spec.adx else []
    names += ["MACD", "MACD_signal", "MACD_hist"] if spec.macd else []
    names += ["PLUS_DI", "MINUS_DI"] if spec.di else []
    names += ["STOCH_slowk", "STOCH_slowd"] if spec.stoch else []
    names += ["WILLR"] if spec.willr else []
    names += ["upperband", "middleband", "lowerband"] if spec.bands else []
    names += ["upper_1_7", "lower_1_7"] if spec.inner_bands else []
    names += [f"EMA{n}" for n in spec.ema]
    names += [f"SMA{n}" for n in spec.sma]
    names += ["ATR"] if spec.atr else []
    if spec.force is not None:
        names += ["FI", *(f"FI_{n}" for n in spec.force)]
    names += ["Bull_Power", "Bear_Power"] if spec.power else []
    return names


def indicators(df: DataFrame, spec: IndicatorSpec = DEFAULT_INDICATORS) -> DataFrame:
    """The input columns followed by the indicators of ``spec``."""
    base = df.columns
    windowed, helpers = window_columns(df, spec)
    fields = recursive_fields(spec)
    if fields:
        unused = [h for h in helpers if not h.startswith(("_sd_", "_mean_"))]
        windowed = series_pass(windowed, [recursive_step(spec)], fields, dropped=unused)
    return band_columns(windowed, spec).select(*base, *indicator_columns(spec))
