"""Gold kept up to date by ticker: only series whose bars changed are computed again.

A ticker's gold rows depend on its bars alone. Beside the gold table lies a digest per ticker of the bars it was built from;
a ticker whose digest differs is built anew from all its bars and replaces its old rows whole. So a first date that
moves, and with it the labels of its two- and three-month bins, leaves no row of the old labels behind, and a ticker
that is gone loses its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlegrid.sinks.tables import read_buckets, replace_keys, write_buckets
from candlegrid.sources.tables import _hadoop_path

#: Partitions of the stored tables, each a part of the tickers.
BUCKETS = 64
MEASURES = ("Open", "High", "Low", "Close", "Adj Close", "Volume", "Dividends", "Stock Splits")


def ticker_digests(silver: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Per ticker its first and last date, its number of bars, and two sums of row hashes that any changed bar changes.

    Partial sums are formed where the bars lie; a row per ticker and task is exchanged. created_at does not count.
    """
    bar = [F.col(c) for c in ("Date", *measures)]

    def total(seed: int):
        # 32 bits of a hash each: such sums don't overflow
        return F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(seed), *bar), 32))

    return silver.groupBy("ticker").agg(
        F.min("Date").alias("first_date"),
        F.max("Date").alias("last_date"),
        F.count("*").alias("bars"),
        total(1).alias("digest_1"),
        total(2).alias("digest_2"),
    )


def changed_tickers(before: DataFrame, now: DataFrame) -> DataFrame:
    """(ticker, change): new, gone, moved (another first date, so other bins) or changed."""
    told = before.select("ticker", F.struct(*before.columns[1:]).alias("was")).join(
        now.select("ticker", F.struct(*now.columns[1:]).alias("is")), "ticker", "full_outer"
    )
    change = (
        F.when(F.col("was").isNull(), "new")
        .when(F.col("is").isNull(), "gone")
        .when(F.col("was.first_date") != F.col("is.first_date"), "moved")
        .otherwise("changed")
    )
    return told.where(~F.col("was").eqNullSafe(F.col("is"))).select("ticker", change.alias("change"))


def refreshed(old: DataFrame, silver: DataFrame, changed: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``old`` with the rows of changed tickers replaced by what ``build`` makes of their bars.

    The changed tickers, at most as many as are listed, are sent to every task: a join by exchange would lay out all gold rows again.
    """
    tickers = F.broadcast(changed.select("ticker"))
    return old.join(tickers, "ticker", "left_anti").unionByName(build(silver.join(tickers, "ticker", "left_semi")))


def refresh_gold(
    spark: SparkSession, path: str, silver: DataFrame, build: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS
) -> list[int] | None:
    """Bring the gold table under ``path`` up to date with ``silver``; returns the rewritten buckets, None after the first build.

    Buckets without a changed ticker keep their files. Digests are written last, so that a run lost on the way is
    repeated for the same tickers by the next one.
    """
    gold, digests = f"{path}/gold", f"{path}/digests"
    now = ticker_digests(silver)
    first = not _exists(spark, digests)
    if first:
        write_buckets(build(silver), gold, "ticker", buckets, ("ticker", "period", "Date"))
        write_buckets(now, digests, "ticker", buckets)
        return None
    # both are read several times: what changed is small, and written once
    beside = f"{path}/changed"
    changed_tickers(read_buckets(spark, digests), now).write.mode("overwrite").parquet(beside)
    changed = spark.read.parquet(beside)
    tickers = changed.select("ticker")
    held = replace_keys(
        spark, gold, build(silver.join(tickers, "ticker", "left_semi")), changed, "ticker", buckets, ("ticker", "period", "Date")
    )
    replace_keys(spark, digests, now, changed, "ticker", buckets)
    return held


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop_path(spark, path)
    return fs.exists(at)
