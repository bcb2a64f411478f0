"""Peaks against a plain restatement of their definition, and hand-made edges."""

import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from candlegrid.operators.extrema import (
    earlier_match,
    find_peaks,
    local_maxima,
    steepest_change,
    two_largest,
)


def test_plateaus_count_once_in_the_middle():
    assert local_maxima(np.array([0.0, 2, 2, 2, 0, 3, 3, 1])).tolist() == [2, 5]
    assert local_maxima(np.array([5.0, 1, 5])).tolist() == []
    assert local_maxima(np.array([1.0, 2])).tolist() == []


def test_equal_peaks_the_later_stays():
    x = np.zeros(12)
    x[[2, 6]] = 9.0
    assert find_peaks(x, 5, 1).tolist() == [6]
    y = np.zeros(12)
    y[[2, 7]] = 9.0
    assert find_peaks(y, 5, 1).tolist() == [2, 7]


def test_missing_value_ends_a_walk():
    x = np.array([np.nan, 1.0, 5, 4.5, 0])
    assert find_peaks(x, 1, 4).tolist() == [2]
    assert find_peaks(x, 1, 4.5).tolist() == []


def restated(x, gap, prominence):
    n = len(x)
    rows, i = [], 1
    while i < n - 1:
        j = i
        while j + 1 < n and x[j + 1] == x[i]:
            j += 1
        if x[i - 1] < x[i] and j < n - 1 and x[j + 1] < x[i]:
            rows.append((i + j) // 2)
        i = j + 1
    kept: list[int] = []
    for p in sorted(rows, key=lambda r: (-x[r], -r)):
        if all(abs(p - q) >= gap for q in kept):
            kept.append(p)

    def low(p, step):
        least, j = x[p], p
        while 0 <= j < n and x[j] <= x[p]:
            least = min(least, x[j])
            j += step
        return least

    return sorted(p for p in kept if x[p] - max(low(p, -1), low(p, 1)) >= prominence)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=60), st.integers(1, 6), st.integers(0, 6))
def test_peaks_follow_the_definition(values, gap, prominence):
    x = np.array(values, dtype=float)
    assert find_peaks(x, gap, prominence).tolist() == restated(x, gap, prominence)


def test_third_peak_higher_by_exactly_the_reach():
    price = [0.0, 10.0, 0, 11.0, 0, 13.0, 0]
    rows = [1, 3, 5]
    assert earlier_match(rows, price, [3.0] * 7, 2) == {5: 1}
    assert earlier_match(rows, price, [2.5] * 7, 2) == {5: 3}
    assert earlier_match(rows, price, [1.9] * 7, 2) == {}
    assert earlier_match(rows, price, [float("nan")] * 7, 2) == {}
    assert earlier_match(rows[:2], price, [9.0] * 7, 2) == {}


def test_steepest_change_edges():
    assert steepest_change([10.0, 10.0, 6.0], 0, 2, 30) == 0  # equal falls: the earlier row
    assert steepest_change([10.0, 7.0], 0, 1, 30) == 0
    assert steepest_change([10.0, 7.01], 0, 1, 30) is None
    assert steepest_change([0.0, 5.0, -1.0], 0, 2, 30) == 0  # a fall from zero is infinite
    assert steepest_change([float("nan"), 1.0], 0, 1, 30) is None


def test_two_largest_order():
    assert two_largest([3.0, 9.0, 5.0, 0.0], 0, 3) == (1, 2)
    assert two_largest([3.0, 5.0, 9.0, 0.0], 0, 3) == (2, 1)
    assert two_largest([4.0, 4.0, 1.0], 0, 3) == (0, 1)
    assert two_largest([4.0, -1.0, 0.0], 0, 3) is None


def test_peaks_of_a_slowly_rising_series_take_linear_time():
    n = 16_000
    x = np.arange(n) * 1e-5 + np.tile([0.0, 1e-3], n // 2)
    start = time.perf_counter()
    assert len(find_peaks(x, 1, 1.0)) == 0
    assert time.perf_counter() - start < 1.0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=1, max_size=40), min_size=1, max_size=6), st.integers(1, 6), st.integers(0, 6))
def test_many_series_at_once_are_each_as_alone(many, gap, prominence):
    starts = np.cumsum([0, *map(len, many)])[:-1]
    x = np.array([v if v != 9 else np.nan for s in many for v in s], dtype=float)
    found = find_peaks(x, gap, prominence, starts).tolist()
    alone = [a + r for a, s in zip(starts.tolist(), many, strict=True) for r in find_peaks(x[a : a + len(s)], gap, prominence).tolist()]
    assert found == alone
    reach = np.full(len(x), 3.0)
    matches = earlier_match(np.array(found, dtype=np.int64), x, reach, 2, starts)
    each = {}
    for a, s in zip(starts.tolist(), many, strict=True):
        rows = [r - a for r in found if a <= r < a + len(s)]
        each |= {a + i: a + j for i, j in earlier_match(rows, x[a : a + len(s)], reach, 2).items()}
    assert matches == each
