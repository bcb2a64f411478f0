"""Recursive averages on many series at once, for use inside a grouped pass.

A value depends on the value before it, which no window frame expresses. All series of a
batch, and all averages of a kind, advance in lockstep: one array operation per row number. Every value is
thus rounded as by the plain recurrence, and a batch costs as many operations as its longest series has rows.
(Composing the steps of a series to larger ones is cheaper still, but its last digits are others, and
indicators are compared to more digits than that leaves.)

Each function takes the series one after the other in an array, with ``series``, the first row
of each (one series if left out), and returns an array of the same length, NaN until a series has warmed up.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np

_ZERO = 1e-14  # below this a range or a directional sum counts as zero


def _blank(x: np.ndarray) -> np.ndarray:
    return np.full(len(x), np.nan)


def running_mean(x: np.ndarray, n: int, start: int = 0) -> np.ndarray:
    """Mean of the last ``n`` values from a running total: add the new value, read, drop the oldest.

    Kept as one total, in that order, so that its rounding is that of the usual
    moving average and its cost does not grow with ``n``.
    """
    out = _blank(x)
    first = start + n - 1
    if len(x) > first:
        seed = x[start:first]
        moves = np.empty(2 * (len(x) - first))
        moves[0::2] = x[first:]
        moves[1::2] = -x[start : len(x) - n + 1]
        totals = np.cumsum(np.r_[seed, moves])
        out[first:] = totals[len(seed) :: 2] / n
    return out


class Lockstep:
    """Rows of a batch by their number in their series: first all first rows, then all second ones, longer series first."""

    def __init__(self, rows: int, series: np.ndarray | None) -> None:
        series = np.zeros(min(rows, 1), dtype=np.int64) if series is None else np.asarray(series)
        self.ends = np.r_[series[1:], rows][: len(series)]
        lengths = self.ends - series
        longest_first = np.argsort(-lengths, kind="stable")
        self.series, self.ends = series[longest_first], self.ends[longest_first]
        self.row = np.arange(rows) - np.repeat(series, lengths)
        place = np.empty(len(series), dtype=np.int64)
        place[longest_first] = np.arange(len(series))
        self.order = np.lexsort((np.repeat(place, lengths), self.row))
        self.bounds = np.r_[0, np.cumsum(np.bincount(self.row))].tolist() if rows else [0]

    def seeds(self, x: np.ndarray, first: int, n: int) -> np.ndarray:
        """Per series the plain sum of the ``n`` values up to row ``first``; NaN where it has no such row."""
        last = self.series + first
        there = last < self.ends
        sums = np.full(len(last), np.nan)
        if n:
            sums[there] = np.cumsum(x[last[there, None] - np.arange(n - 1, -1, -1)], axis=1)[:, -1]
        else:
            sums[there] = 0.0
        return sums

    def run(self, values: Sequence[np.ndarray], firsts: Sequence[int], seeds: Sequence[np.ndarray], step: Callable, keep: Sequence[np.ndarray] | None = None) -> np.ndarray:
        """A row per average: its seed in row ``firsts``, ``step(before, value)`` from there on, NaN before.

        Where ``keep`` is set, the value before stays.
        """
        told = np.stack(values)[:, self.order]
        kept = None if keep is None else np.stack(keep)[:, self.order]
        done = np.empty_like(told)
        now = np.zeros((len(told), len(self.series)))
        begins: dict[int, list[int]] = {}
        for r, first in enumerate(firsts):
            begins.setdefault(first, []).append(r)
        with np.errstate(all="ignore"):
            for t, (a, b) in enumerate(zip(self.bounds, self.bounds[1:], strict=False)):
                before = now[:, : b - a]
                after = step(before, told[:, a:b])
                if kept is not None:
                    after = np.where(kept[:, a:b], before, after)
                for r in begins.get(t, ()):
                    after[r] = seeds[r][: b - a]
                done[:, a:b] = before[:] = after
        out = np.empty_like(done)
        out[:, self.order] = done
        return np.where(self.row >= np.array(firsts)[:, None], out, np.nan)


class Ema(NamedTuple):
    """An exponential average of ``x`` over ``n`` rows, seeded with the mean of the ``n`` values from ``start`` on."""

    x: np.ndarray
    n: int
    start: int = 0


def emas(asked: Sequence[Ema], lock: Lockstep) -> np.ndarray:
    """A row per average asked for."""
    firsts = [e.start + e.n - 1 for e in asked]
    seeds = [lock.seeds(e.x, first, e.n) / e.n for e, first in zip(asked, firsts, strict=True)]
    k = np.array([[2.0 / (e.n + 1)] for e in asked])
    return lock.run([e.x for e in asked], firsts, seeds, lambda before, value: (value - before) * k + before)


def ema(x: np.ndarray, n: int, start: int = 0, series: np.ndarray | None = None) -> np.ndarray:
    """Exponential average seeded with the mean of the ``n`` values from ``start`` on."""
    return emas([Ema(x, n, start)], Lockstep(len(x), series))[0]


def macd_lines(x: np.ndarray, fast: int, slow: int) -> list[Ema]:
    """The two averages of a MACD line.

    Both start on the same row, so the fast one is seeded on the last ``fast`` rows of the slow one's seed.
    """
    fast, slow = min(fast, slow), max(fast, slow)
    return [Ema(x, fast, slow - fast), Ema(x, slow)]


def macd_signal(line: np.ndarray, slow: int, signal: int, lock: Lockstep) -> tuple[np.ndarray, np.ndarray]:
    """The line and its signal; both are blank until the signal exists."""
    average = emas([Ema(line, signal, slow - 1)], lock)[0]
    return np.where(np.isnan(average), np.nan, line), average


def macd(x: np.ndarray, fast: int, slow: int, signal: int, series: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Fast minus slow average and its signal line."""
    lock = Lockstep(len(x), series)
    quick, steady = emas(macd_lines(x, fast, slow), lock)
    return macd_signal(quick - steady, max(fast, slow), signal, lock)


def _wilder(values: Sequence[np.ndarray], n: Sequence[int], firsts: Sequence[int], seeds: Sequence[np.ndarray], lock: Lockstep, keep: Sequence[np.ndarray] | None = None) -> np.ndarray:
    """Averages that take 1/n of each new value, from the mean of the ``n`` values up to their first row."""
    many = np.array(n, dtype=float)[:, None]
    return lock.run(values, firsts, seeds, lambda before, value: (before * (many - 1) + value) / many, keep)


def atr(true_range: np.ndarray, n: int, series: np.ndarray | None = None, lock: Lockstep | None = None) -> np.ndarray:
    """Wilder average of the true range, which exists from row 1 on."""
    lock = lock or Lockstep(len(true_range), series)
    return _wilder([true_range], [n], [n], [lock.seeds(true_range, n, n) / n], lock)[0]


def _wilder_sums(values: Sequence[np.ndarray], n: Sequence[int], lock: Lockstep) -> np.ndarray:
    """Decayed sums: rows 1..n-1 are added up, later rows decay them by 1/n."""
    many = np.array(n, dtype=float)[:, None]
    seeds = [lock.seeds(x, k - 1, k - 1) for x, k in zip(values, n, strict=True)]
    sums = lock.run(values, [k - 1 for k in n], seeds, lambda before, value: before - before / many + value)
    return np.where(lock.row >= np.array(n)[:, None], sums, np.nan)


def directions(
    plus_move: np.ndarray, minus_move: np.ndarray, true_range: np.ndarray, n: Sequence[int], lock: Lockstep
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per length the plus and minus directional indicators, zero while the summed range is zero."""
    sums = _wilder_sums([x for _ in n for x in (plus_move, minus_move, true_range)], [k for k in n for _ in range(3)], lock)
    out = []
    for plus, minus, total in zip(sums[0::3], sums[1::3], sums[2::3], strict=True):
        flat = np.abs(total) < _ZERO
        safe = np.where(flat, 1.0, total)
        out.append((np.where(flat, 0.0, 100.0 * (plus / safe)), np.where(flat, 0.0, 100.0 * (minus / safe))))
    return out


def directional(
    plus_move: np.ndarray, minus_move: np.ndarray, true_range: np.ndarray, n: int, series: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Plus and minus directional indicators, zero while the summed range is zero."""
    return directions(plus_move, minus_move, true_range, [n], Lockstep(len(true_range), series))[0]


def adx_of(plus: np.ndarray, minus: np.ndarray, n: int, lock: Lockstep) -> np.ndarray:
    """Average directional index; rows without any directional share leave it unchanged."""
    both = minus + plus
    idle = np.abs(both) < _ZERO
    dx = np.where(idle, 0.0, 100.0 * (np.abs(minus - plus) / np.where(idle, 1.0, both)))
    first = 2 * n - 1
    return _wilder([dx], [n], [first], [lock.seeds(dx, first, n) / n], lock, [idle])[0]


def adx(plus_move: np.ndarray, minus_move: np.ndarray, true_range: np.ndarray, n: int, series: np.ndarray | None = None) -> np.ndarray:
    """Average directional index from directional moves and the true range."""
    lock = Lockstep(len(true_range), series)
    return adx_of(*directions(plus_move, minus_move, true_range, [n], lock)[0], n, lock)
