"""Delivery of a table as ordered text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlegrid.functions.text import date_text, text_or

DATE_WORDS = ("Date_", "created_at")


def as_text(df: DataFrame, missing: str = "None", date_words: Sequence[str] = DATE_WORDS) -> DataFrame:
    """Every column as text: dates as yyyy-MM-dd, missing values as a word."""

    def text(c: str):
        x = F.col(f"`{c}`")
        return date_text(x) if any(w in c for w in date_words) else x

    return df.select(*(text_or(text(c), missing).alias(c) for c in df.columns))


def export_table(df: DataFrame, newest: str, path: str | None = None, missing: str = "None") -> DataFrame:
    """Rows newest first, then by ticker, as text; also written as CSV when ``path`` is given.

    The sort is a range exchange, so part files in name order hold the rows in order.
    """
    out = as_text(df.orderBy(F.col(newest).desc(), F.col("ticker").asc()), missing)
    if path is not None:
        out.write.mode("overwrite").option("header", "true").csv(path)
    return out
