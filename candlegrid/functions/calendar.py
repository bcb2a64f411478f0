"""Calendar bins. Bins are right-closed and labelled by their last day.

Multi-unit bins are anchored at the first date of each ticker, so every label
takes that first date as an argument.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlegrid.config import Period


def week_end(d: Column) -> Column:
    """Sunday on or after ``d`` (weekday() is 0 on Monday)."""
    return F.date_add(d, 6 - F.weekday(d))


def month_index(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d) - 1


def month_index_end(m: Column) -> Column:
    """Last day of the month with running index ``m``."""
    year = F.floor(m / F.lit(12)).cast("int")
    month = (F.pmod(m, F.lit(12)) + 1).cast("int")
    return F.last_day(F.make_date(year, month, F.lit(1)))


def _steps(distance: Column, n: int) -> Column:
    """Smallest multiple of ``n`` that is not below the (non-negative) distance."""
    return (F.floor((distance + F.lit(n - 1)) / F.lit(n)) * n).cast("int")


def bin_label(d: Column, first: Column, p: Period) -> Column:
    """Label of the bin of period ``p`` that holds date ``d``."""
    if p.unit == "day":
        return d
    if p.unit == "week":
        start = week_end(first)
        return F.date_add(start, _steps(F.datediff(week_end(d), start), 7 * p.n))
    start = month_index(first)
    return month_index_end(start + _steps(month_index(d) - start, p.n))


def label_after(label: Column, bins: Column, p: Period) -> Column:
    """The label ``bins`` bins after ``label``."""
    if p.unit == "week":
        return F.date_add(label, (bins * (7 * p.n)).cast("int"))
    return F.last_day(F.add_months(label, (bins * p.n).cast("int")))


def bins_between(earlier: Column, later: Column, p: Period) -> Column:
    """Number of bins from one label to a later one."""
    if p.unit == "week":
        return F.floor(F.datediff(later, earlier) / F.lit(7 * p.n)).cast("int")
    return F.floor((month_index(later) - month_index(earlier)) / F.lit(p.n)).cast("int")


def local_date(ts: Column, zone: str) -> Column:
    """Date of a UTC instant in ``zone``."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def within_years(d: Column, as_of: Column, years: int) -> Column:
    """``d`` is not older than ``years`` before ``as_of``."""
    return d >= F.add_months(as_of, -12 * years)
