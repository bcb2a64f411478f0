"""Peaks of many series at once and what lies between them, for use inside a grouped pass.

Arrays hold series one after the other; ``series`` has the first row of each (one series if left out).
"""

from __future__ import annotations

import numpy as np


def _first_rows(n: int, series: np.ndarray | None) -> np.ndarray:
    """Per row the first row of its series."""
    if series is None:
        return np.zeros(n, dtype=np.int64)
    return np.repeat(series, np.diff(np.r_[series, n]))


def local_maxima(x: np.ndarray, series: np.ndarray | None = None) -> np.ndarray:
    """Rows higher than both neighbours; a plateau counts once, at its middle row."""
    if len(x) < 3:
        return np.empty(0, dtype=np.int64)
    first = _first_rows(len(x), series)
    starts = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (first[1:] != first[:-1])])
    ends = np.r_[starts[1:] - 1, len(x) - 1]
    v, of = x[starts], first[starts]
    inside = (of[:-2] == of[1:-1]) & (of[2:] == of[1:-1])
    inner = np.flatnonzero(inside & (v[:-2] < v[1:-1]) & (v[2:] < v[1:-1])) + 1
    return (starts[inner] + ends[inner]) // 2


def _keep_apart(rows: np.ndarray, height: np.ndarray, gap: int) -> np.ndarray:
    """Drop peaks nearer than ``gap`` rows to a higher kept one; of equals the later stays.

    In each round all peaks that outrank every open one near them are kept, and what is near these is dropped.
    """
    n = len(rows)
    rank = np.empty(n, dtype=np.int64)
    rank[np.argsort(height, kind="stable")] = np.arange(n)
    reach = 1
    while reach < n and np.any(rows[reach:] - rows[:-reach] < gap):
        reach += 1
    near = [(k, rows[k:] - rows[:-k] < gap) for k in range(1, reach)]
    open_, kept = np.ones(n, dtype=bool), np.zeros(n, dtype=bool)
    while open_.any():
        now = np.where(open_, rank, -1)
        best = np.full(n, -1)
        for k, close in near:
            np.maximum(best[:-k], np.where(close, now[k:], -1), out=best[:-k])
            np.maximum(best[k:], np.where(close, now[:-k], -1), out=best[k:])
        top = open_ & (now > best)
        kept |= top
        open_ &= ~top
        for k, close in near:
            open_[:-k] &= ~(close & top[k:])
            open_[k:] &= ~(close & top[:-k])
    return kept


def _lows(x: np.ndarray, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each of the rows, the lowest value to its left before one that is higher, or missing, or another series'; its own included.

    Tables hold the greatest and least of 1, 2, 4 .. values; each row goes left by the longest stretches that stay below it.
    """
    highest, lowest = [np.where(np.isnan(x), np.inf, x)], [x]
    longest = int((rows - first[rows]).max(initial=0))
    while 2 << len(highest) - 1 <= longest:
        half = 1 << len(highest) - 1
        # the value at t covers the stretch that ends with t
        highest.append(np.r_[highest[-1][:half], np.maximum(highest[-1][half:], highest[-1][:-half])])
        lowest.append(np.r_[lowest[-1][:half], np.fmin(lowest[-1][half:], lowest[-1][:-half])])
    at, least, begin, own = rows - 1, x[rows].copy(), first[rows], x[rows]
    for level in range(len(highest) - 1, -1, -1):
        span = 1 << level
        fits = at - span + 1 >= begin
        goes = fits & (highest[level][np.where(fits, at, 0)] <= own)
        least = np.where(goes, np.minimum(least, lowest[level][np.where(goes, at, 0)]), least)
        at = np.where(goes, at - span, at)
    return least


def find_peaks(x: np.ndarray, gap: int, prominence: float, series: np.ndarray | None = None) -> np.ndarray:
    """Rows of local maxima at least ``gap`` apart and ``prominence`` above their surroundings.

    Spacing is applied first, over all local maxima, then prominence. A missing
    value compares false and ends a walk.
    """
    first = _first_rows(len(x), series)
    rows = local_maxima(x, series)
    if series is None:
        apart = rows
    else:
        # series are moved so far apart that their peaks are never near each other
        apart = rows + np.searchsorted(series, rows, "right") * gap
    rows = rows[_keep_apart(apart, x[rows], gap)]
    if not len(rows):
        return rows
    # the right side is the left one of the mirrored rows
    n = len(x)
    last = n - 1 - _last_rows(n, series)
    before, after = _lows(x, rows, first), _lows(x[::-1], n - 1 - rows, last[::-1])
    return rows[(x[rows] - before >= prominence) & (x[rows] - after >= prominence)]


def _last_rows(n: int, series: np.ndarray | None) -> np.ndarray:
    """Per row the last row of its series."""
    if series is None:
        return np.full(n, n - 1, dtype=np.int64)
    ends = np.r_[series[1:], n]
    return np.repeat(ends - 1, ends - series)


def earlier_match(
    rows: np.ndarray, price: np.ndarray, reach: np.ndarray, lookback: int, series: np.ndarray | None = None
) -> dict[int, int]:
    """Peak row -> earliest of the ``lookback`` peaks before it that it tops by at most ``reach``."""
    rows, price, reach = np.asarray(rows, dtype=np.int64), np.asarray(price), np.asarray(reach)
    of = np.zeros(len(rows)) if series is None else np.searchsorted(series, rows, "right")
    found = np.full(len(rows), -1)
    k = np.arange(lookback, len(rows))
    k = k[of[k - lookback] == of[k]]
    for back in range(1, lookback + 1):  # an earlier match replaces a later one
        i, j = rows[k], rows[k - back]
        higher = price[i] - price[j]
        ok = (higher > 0) & (np.abs(higher) <= reach[i])
        found[k[ok]] = j[ok]
    hit = found >= 0
    return dict(zip(rows[hit].tolist(), found[hit].tolist(), strict=True))


def steepest_change(x: np.ndarray, start: int, i: int, percent: float) -> int | None:
    """Row j in [start, i) above x[i] from which x fell relatively most, if by ``percent`` at least.

    A fall from zero is infinite; the earliest row wins ties.
    """
    now, then = x[i], np.asarray(x[start:i], dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        change = np.where(then != 0, np.abs(now - then) / np.abs(then) * 100, np.inf)
    change = np.where((now < then) & (change >= percent), change, -1.0)
    j = int(np.argmax(change)) if len(change) else 0
    return start + j if len(change) and change[j] >= 0 else None


def two_largest(x: np.ndarray, start: int, i: int) -> tuple[int, int] | None:
    """Rows of the largest and second largest positive values in [start, i), earlier first on ties."""
    values = np.asarray(x[start:i], dtype=float)
    positive = np.flatnonzero(values > 0)
    if len(positive) < 2:
        return None
    first, second = (start + positive[np.argsort(-values[positive], kind="stable")[:2]]).tolist()
    return first, second
