"""Scalar rules on text and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_text(x: Column) -> Column:
    """yyyy-MM-dd, or NULL for what is not a date."""
    return F.date_format(x.try_cast("date"), "yyyy-MM-dd")


def text_or(x: Column, missing: str = "None") -> Column:
    return F.coalesce(x.cast("string"), F.lit(missing))


def file_stem(path: Column) -> Column:
    """Last path segment without its extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?$", 1)


def second_part(stem: Column) -> Column:
    """Text between the first and the second underscore: us_2W -> 2W."""
    return F.get(F.split(stem, "_"), F.lit(1))


def pair_text(left: Column, right: Column) -> Column:
    """"left_right", NULL when either side is missing."""
    return F.when(left.isNotNull() & right.isNotNull(), F.concat_ws("_", left, right))
