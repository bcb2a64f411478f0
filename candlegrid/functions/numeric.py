"""Scalar rules on numbers. NaN is turned into NULL before anything is compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def truncate(x: Column, decimals: int) -> Column:
    """Cut toward zero after ``decimals`` places; NaN and infinities are left out of the cut.

    The product is the plain double product, so 1.15 becomes 1.14 at two places.
    """
    scale = F.lit(float(10**decimals))
    scaled = F.nanvl(x, F.lit(None)) * scale
    # the cast to BIGINT cuts toward zero; what does not fit has no fraction to cut
    return F.coalesce(scaled.try_cast("bigint").cast("double"), scaled) / scale


def to_number(x: Column) -> Column:
    """Text to double; what is not a number becomes NULL."""
    return x.try_cast("double")


def finite_or_null(x: Column) -> Column:
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(INFINITY)), x)


def null_if_in(x: Column, sentinels: tuple[str, ...] = ("None", "none")) -> Column:
    return F.when(~x.isin(*sentinels), x)


def ratio_to_high(price: Column, high: Column) -> Column:
    """price / high cut at two places; NULL when the high is missing or zero."""
    return truncate(F.try_divide(price, high), 2)


def change_at_least(now: Column, base: Column, percent: float) -> Column:
    """|now - base| / |base| * 100 >= percent, where x/0 is infinite and 0/0 is no change."""
    move = now - base
    return F.when(base == 0, move != 0).otherwise(F.abs(move / base) * 100 >= percent)
