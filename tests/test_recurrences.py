"""Hand-worked values for the running averages."""

import numpy as np
import pytest

from candlegrid.operators import recurrences as rec

NAN = np.nan


def same(got, want):
    np.testing.assert_allclose(got, want, rtol=1e-12, equal_nan=True)


def test_running_mean_warm_up():
    same(rec.running_mean(np.array([1.0, 2, 3, 4]), 3), [NAN, NAN, 2, 3])
    same(rec.running_mean(np.array([1.0, 2]), 3), [NAN, NAN])
    same(rec.running_mean(np.array([NAN, 3.0, 5, 9]), 2, start=1), [NAN, NAN, 4, 7])
    same(rec.running_mean(np.array([7.0, 8]), 1), [7, 8])


def test_ema_seeds_with_the_mean():
    # seed (1+2+3)/3 = 2, k = 1/2: 2 + (6-2)/2 = 4, 4 + (0-4)/2 = 2
    same(rec.ema(np.array([1.0, 2, 3, 6, 0]), 3), [NAN, NAN, 2, 4, 2])
    same(rec.ema(np.array([9.0, 1, 3]), 2, start=1), [NAN, NAN, 2])
    same(rec.ema(np.array([1.0]), 2), [NAN])


def test_macd_starts_both_averages_together():
    x = np.arange(1.0, 9)  # fast 2, slow 4: fast seeded on rows 2 and 3
    line, signal = rec.macd(x, 2, 4, 2)
    fast = [3.5, 4.5, 5.5, 6.5, 7.5]  # rows 3.. of a straight line, both averages lag constantly
    slow = [2.5, 3.5, 4.5, 5.5, 6.5]
    want = np.array(fast) - np.array(slow)
    same(line, [NAN] * 4 + list(want[1:]))
    same(signal, [NAN] * 4 + [1.0] * 4)
    assert np.isnan(rec.macd(np.arange(33.0), 12, 26, 9)[0]).all()
    assert np.isfinite(rec.macd(np.arange(34.0), 12, 26, 9)[0]).sum() == 1


def test_atr_skips_the_first_row():
    tr = np.array([NAN, 1.0, 3, 5, 9])
    same(rec.atr(tr, 2), [NAN, NAN, 2, (2 * 1 + 5) / 2, (3.5 + 9) / 2])


def test_directional_sums_then_decays():
    up, down, tr = np.array([NAN, 1.0, 0, 2]), np.array([NAN, 0.0, 1, 0]), np.array([NAN, 2.0, 2, 2])
    plus, minus = rec.directional(up, down, tr, 2)
    # row 2: sums 1, 0, 2 decay by half and take the row: 0.5, 1, 3
    same(plus, [NAN, NAN, 100 * 0.5 / 3, 100 * 2.25 / 3.5])
    same(minus, [NAN, NAN, 100 * 1 / 3, 100 * 0.5 / 3.5])


def test_flat_series_has_no_direction():
    zero = np.r_[NAN, np.zeros(39)]
    plus, minus = rec.directional(zero, zero, zero, 13)
    assert plus[13] == 0 and minus[39] == 0
    adx = rec.adx(zero, zero, zero, 14)
    assert np.isnan(adx[26]) and adx[27] == 0 and adx[39] == 0


def test_adx_keeps_its_value_over_idle_rows():
    up = np.r_[NAN, np.ones(3), 0, 0]
    down, tr = np.r_[NAN, np.zeros(5)], np.r_[NAN, np.ones(5)]
    adx = rec.adx(up, down, tr, 2)
    same(adx, [NAN, NAN, NAN, 100, 100, 100])


@pytest.mark.parametrize("n", [1, 13, 27, 28])
def test_adx_first_row(n):
    x = np.r_[NAN, np.ones(max(n - 1, 0))][:n]
    assert np.isfinite(rec.adx(x, np.zeros(n), x, 14)).sum() == (1 if n == 28 else 0)


def test_many_series_at_once_are_each_as_alone():
    rng = np.random.default_rng(4)
    lengths = [1, 2, 3, 13, 14, 15, 27, 28, 29, 40, 300, 1, 64]
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    total = int(np.sum(lengths))
    close = rng.normal(100, 5, total)
    up, down = np.abs(rng.normal(0, 1, total)), np.abs(rng.normal(0, 1, total))
    up[rng.random(total) < 0.4] = 0
    down[rng.random(total) < 0.4] = 0
    tr = np.where(rng.random(total) < 0.1, 0, np.abs(rng.normal(0, 2, total)))
    close[starts[10] + 150] = NAN  # a missing value blanks the rest of its own series only
    for move in (up, down, tr):
        move[starts] = NAN
    calls = [
        lambda s, at: rec.ema(close[s], 13, series=at),
        lambda s, at: rec.macd(close[s], 12, 26, 9, series=at)[1],
        lambda s, at: rec.atr(tr[s], 13, series=at),
        lambda s, at: rec.directional(up[s], down[s], tr[s], 13, series=at)[0],
        lambda s, at: rec.adx(up[s], down[s], tr[s], 14, series=at),
    ]
    for call in calls:
        alone = [call(slice(a, a + n), None) for a, n in zip(starts, lengths, strict=True)]
        np.testing.assert_array_equal(call(slice(None), starts), np.concatenate(alone))


def test_values_are_rounded_as_by_the_plain_recurrence():
    x = np.random.default_rng(2).normal(100, 5, 400)
    e = np.cumsum(x[:13])[-1] / 13
    want = [e]
    for v in x[13:].tolist():
        e = (v - e) * (2.0 / 14) + e
        want.append(e)
    assert rec.ema(x, 13)[12:].tolist() == want
    a = np.cumsum(x[1:14])[-1] / 13
    want = [a]
    for v in x[14:].tolist():
        a = (a * 12 + v) / 13
        want.append(a)
    assert rec.atr(x, 13)[13:].tolist() == want
