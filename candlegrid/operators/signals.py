"""Signal columns per (ticker, period) series.

The grouped pass only finds positions: extrema, the earlier extremum each one is
compared with, and the rows a divergence leans on. Everything said about those
positions -- crosses, trends, spikes, pairs, sides -- is a row expression.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.config import DEFAULT_SIGNALS, SignalSpec
from candlegrid.functions.numeric import change_at_least
from candlegrid.functions.text import pair_text
from candlegrid.operators.extrema import earlier_match, find_peaks, steepest_change, two_largest
from candlegrid.operators.series_pass import ROW, Series, row_in_series, series_pass

LONG, SHORT, UP, DOWN = "Long", "Short", "Up", "Down"


def _previous(spec: SignalSpec) -> list[str]:
    """Columns whose value one row earlier is needed."""
    short, long = f"EMA{spec.ema_short}", f"EMA{spec.ema_long}"
    return list(dict.fromkeys([short, long, spec.divergence_1[1][0]]))


def position_fields(spec: SignalSpec) -> list[tuple[str, T.DataType]]:
    fields: list[tuple[str, T.DataType]] = [(f"_before_{c}", T.DoubleType()) for c in _previous(spec)]
    flags = ("price_Peak", "price_Trough", f"{spec.force_column}_Peak", f"{spec.force_column}_Trough")
    fields += [(c, T.BooleanType()) for c in flags]
    positions = ["_pos", "price_search", "_power_1", "_power_2"]
    positions += [f"_from_{name}" for name, _ in spec.divergence_1]
    return fields + [(c, T.LongType()) for c in positions]


def position_step(spec: SignalSpec):
    """Extrema and the rows they lean on, as one step of the grouped pass."""

    def step(s: Series) -> dict[str, np.ndarray]:
        n, at, thresholds = s.rows, s.starts, dict(spec.divergence_1)
        first = np.repeat(at, np.diff(np.r_[at, n]))
        out: dict[str, np.ndarray] = {"_pos": (np.arange(n) - first).astype(float)}
        for c in _previous(spec):
            before = np.r_[np.nan, s[c][:-1]][:n]
            before[at] = np.nan
            out[f"_before_{c}"] = before
        for c in ("price_search", "_power_1", "_power_2", *(f"_from_{name}" for name in thresholds)):
            out[c] = np.full(n, np.nan)

        price, force = s[spec.price], s[spec.force_column]
        # a trough is a peak of the mirrored series
        for sign, price_flag, force_flag, power in (
            (1.0, "price_Peak", "Peak", spec.bull_column),
            (-1.0, "price_Trough", "Trough", spec.bear_column),
        ):
            rows = find_peaks(sign * price, spec.price_gap, spec.price_prominence, at)
            out[price_flag] = _flags(n, rows)
            strong = find_peaks(sign * force, spec.force_gap, spec.force_prominence, at)
            out[f"{spec.force_column}_{force_flag}"] = _flags(n, strong[sign * force[strong] > 0])
            matches = earlier_match(rows, sign * price, s["ATR"], spec.lookback, at)
            mirrored = {c: sign * s[c] for c in (power, *thresholds)}
            # positions count from a series' own first row
            for i, start in matches.items():
                own = first[i]
                out["price_search"][i] = start - own
                for name, percent in thresholds.items():
                    j = steepest_change(mirrored[name], start, i, percent)
                    if j is not None:
                        out[f"_from_{name}"][i] = j - own
                pair = two_largest(mirrored[power], start, i)
                if pair is not None:
                    out["_power_1"][i], out["_power_2"][i] = pair[0] - own, pair[1] - own
        return out

    return step


def _flags(n: int, rows: np.ndarray) -> np.ndarray:
    out = np.zeros(n, dtype=bool)
    out[rows] = True
    return out


def signal_columns(df: DataFrame, spec: SignalSpec) -> DataFrame:
    """Turn the positions into the signal columns; row expressions only."""
    short, long = f"EMA{spec.ema_short}", f"EMA{spec.ema_long}"
    spike, percent = spec.divergence_1[1]
    gap, gap_before = F.col(short) - F.col(long), F.col(f"_before_{short}") - F.col(f"_before_{long}")
    slope = F.col(short) - F.col(f"_before_{short}")
    before, now = F.col(f"_before_{spike}"), F.col(spike)
    large = change_at_least(now, before, percent)
    df = df.withColumns(
        {
            "EMA_bullbear": F.when((gap > 0) & (gap_before < 0), LONG).when((gap < 0) & (gap_before > 0), SHORT),
            f"{short}_slope": slope,
            f"{short}_trend": F.when(slope > 0, UP).when(slope < 0, DOWN),
            "Higher_Peak": F.col("price_Peak") & F.col("price_search").isNotNull(),
            "Lower_Trough": F.col("price_Trough") & F.col("price_search").isNotNull(),
            f"{spike}_diff": now - before,
            f"{spike}_Peak": _true((now > 0) & (now > before) & large),
            f"{spike}_Trough": _true((now < 0) & (now < before) & large),
        }
    )
    higher, lower = F.col("Higher_Peak"), F.col("Lower_Trough")
    trends: dict[str, Column] = {}
    for name, _ in spec.divergence_1:
        found = F.col(f"_from_{name}").isNotNull()
        trends[f"{name}_trend"] = F.when(found & higher, DOWN).when(found & lower, UP)
        trends[f"{name}_trend_pair"] = pair_text(F.col(f"_from_{name}"), F.col("_pos"))
    fading = F.col("_power_1") < F.col("_power_2")  # the largest came first
    for name, at, word in ((spec.bull_column, higher, DOWN), (spec.bear_column, lower, UP)):
        trends[f"{name}_trend"] = F.when(fading & at, word)
        trends[f"{name}_trend_pair"] = F.when(fading & at, pair_text(F.col("_power_1"), F.col("_power_2")))
    return df.withColumns(trends).withColumns(side_columns(spec))


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def side_columns(spec: SignalSpec) -> dict[str, Column]:
    """The three sides."""
    both_up = both_down = F.lit(True)
    for name, _ in spec.divergence_1:
        both_up = both_up & (F.col(f"{name}_trend") == UP)
        both_down = both_down & (F.col(f"{name}_trend") == DOWN)
    trend = F.col(f"{spec.trend_column}_trend")
    bull, bear = F.col(f"{spec.bull_column}_trend"), F.col(f"{spec.bear_column}_trend")
    first, second, third = spec.sides
    return {
        first: F.when(both_up, LONG).when(both_down, SHORT),
        second: F.when((trend == UP) & F.col(f"{spec.force_column}_Trough"), LONG).when(
            (trend == DOWN) & F.col(f"{spec.force_column}_Peak"), SHORT
        ),
        third: F.when((bear == UP) & F.col("Lower_Trough"), LONG).when(
            (bull == DOWN) & F.col("Higher_Peak"), SHORT
        ),
    }


def signal_names(spec: SignalSpec) -> list[str]:
    """Names of the signal columns, in stored order."""
    short, spike, force = f"EMA{spec.ema_short}", spec.divergence_1[1][0], spec.force_column
    first, powers = [n for n, _ in spec.divergence_1], (spec.bull_column, spec.bear_column)
    return [
        "EMA_bullbear", f"{short}_slope", f"{short}_trend",
        "price_Peak", "price_Trough", "Higher_Peak", "Lower_Trough", "price_search",
        f"{force}_Peak", f"{force}_Trough", f"{spike}_diff", f"{spike}_Peak", f"{spike}_Trough",
        *(f"{n}_trend" for n in first), *(f"{n}_trend_pair" for n in first),
        *(f"{n}_trend" for n in powers), *(f"{n}_trend_pair" for n in powers),
        *spec.sides,
    ]


def signals(df: DataFrame, spec: SignalSpec = DEFAULT_SIGNALS) -> DataFrame:
    """The input columns, which must hold the indicators, followed by the signals."""
    base = df.columns
    laid_out = df.withColumn(ROW, row_in_series())
    passed = series_pass(laid_out, [position_step(spec)], position_fields(spec), dropped=[ROW])
    return signal_columns(passed, spec).select(*base, *signal_names(spec))
