"""Upsert policies: what happens to old rows when a new batch arrives.

``overwrite`` and ``mark_inactive`` are anti joins on key columns. The two policies that look at the latest rows of a
series lay old and new rows out by series in one exchange and read everything else off windows over it, so that
each side is read once or twice however many rules look at it. A series has at most a row per calendar day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

PRICE_KEYS = ("Date", "ticker", "period")


@dataclass(frozen=True)
class MergeKeys:
    """What ``delete_tail_merge`` goes by: a series' columns, the column that orders it, and the columns within which a
    series' latest values are deleted for all series of the batch (a part of the series' columns, none for all rows)."""

    series: tuple[str, ...] = ("ticker", "period")
    order: str = "Date"
    within: tuple[str, ...] = ("period",)

    def __post_init__(self) -> None:
        if not self.series or self.order in self.series or not set(self.within) <= set(self.series):
            raise ValueError(f"unusable merge keys: {self}")

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.order, *self.series)

    @staticmethod
    def from_mapping(given: Mapping[str, object]) -> MergeKeys:
        """From plain data, as in a settings file: series (one name or several), order, within."""
        unknown = set(given) - {"series", "order", "within"}
        if unknown:
            raise ValueError(f"unknown merge keys: {sorted(unknown)}")
        names = {k: ((v,) if isinstance(v, str) else tuple(v)) if k != "order" else v for k, v in given.items()}
        return MergeKeys(**names)


PRICE_MERGE = MergeKeys()
#: Calendar days of 150 years: no period can have more dates.
MOST_DAYS = 55_000
POLICIES = ("overwrite", "keep_old", "mark_inactive", "delete_tail_merge")


def _unless_missing(keys: Sequence[str], side: str, value: bool) -> Column:
    """``value``, failing at run time on a row with a missing key."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    message = F.lit(f"NULL in key columns {', '.join(keys)} of the {side} rows")
    return F.when(missing, F.raise_error(message).cast("boolean")).otherwise(F.lit(value))


def with_keys(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """``df``, failing at run time on a row with a missing key.

    A tuple NOT IN would drop old rows next to a NULL key in the batch and an anti-join
    would keep them, so such rows are refused rather than resolved either way.
    """
    return df.where(_unless_missing(keys, side, True))


def upsert(
    old: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    policy: str = "overwrite",
    tail_n: int = 2,
    tail_keys: Sequence[str] = ("ticker",),
    active_column: str = "is_active",
    merge: MergeKeys = PRICE_MERGE,
) -> DataFrame:
    """Old rows and a new batch merged under ``policy``; ``old=None`` is the first run.

    * ``overwrite``: a new row replaces the old rows with its keys.
    * ``mark_inactive``: as overwrite, and old rows not in the batch become inactive.
    * ``keep_old``: the latest ``tail_n`` old rows of each ticker in the batch are
      provisional and dropped; otherwise an old row wins over a new one.
    * ``delete_tail_merge``: per period, old rows of batch tickers on any of those
      tickers' latest ``tail_n`` dates are dropped; otherwise a new row wins. ``merge`` says
      what stands for period, ticker and date; its columns are the keys.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}, expected one of {POLICIES}")
    if old is not None and policy == "delete_tail_merge":
        asked = tuple(dict.fromkeys((*merge.keys, *keys)))
        return _survivors(_merge_frame(old, new, merge, tail_n, asked), old.columns)
    new = with_keys(new, keys, "new")
    if old is None:
        return new
    old = with_keys(old, keys, "old")
    if policy == "keep_old":
        return _keep_old(old, new, keys, tail_n, tail_keys)
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    if policy == "mark_inactive":
        kept = kept.withColumn(active_column, F.lit(False))
    return kept.unionByName(new)


def _merge_frame(old: DataFrame, new: DataFrame, by: MergeKeys, tail_n: int, asked: Sequence[str] = ()) -> DataFrame:
    """Old and new rows by series, with what a merge asks of them.

    _new; _touched: the batch has rows of the series; _met: the other side has a row of this key; _doomed: a batch series
    of the row's part has one of its latest ``tail_n`` old rows on this day.

    There are at most as many days in a part as calendar days; that bound is checked as the query runs, and the
    days are sent to every task, so that the rows of one day, which all tickers share, need not meet in one task.

    All windows share one layout, latest day first, so a rank grows by a row at a time. The days are worked out once, from
    the key columns alone. Rows that lack a value in ``asked`` are refused as they get their mark: a filter would be pushed
    into some of the branches that a side is built from, and these would no longer share an exchange.
    """
    both = old.withColumn("_new", _unless_missing(asked, "old", False)).unionByName(new.withColumn("_new", _unless_missing(asked, "new", True)))
    by_day = Window.partitionBy(*by.series).orderBy(F.col(by.order).desc())
    series = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same_day = by_day.rangeBetween(Window.currentRow, Window.currentRow)
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = both.withColumns(
        {
            "_touched": F.bool_or("_new").over(series),
            "_met": F.when(F.col("_new"), ~F.bool_and("_new").over(same_day)).otherwise(F.bool_or("_new").over(same_day)),
            "_rank": F.count_if(~F.col("_new")).over(so_far),
        }
    )
    tail = laid.where(~F.col("_new") & F.col("_touched") & (F.col("_rank") <= tail_n))
    days = tail.groupBy(*by.within, by.order).agg(F.lit(True).alias("_doomed"))
    counted = days.withColumn("_days", F.count("*").over(Window.partitionBy(*by.within)))
    few = F.when(F.col("_days") > MOST_DAYS, F.raise_error(F.lit("more dates than calendar days")).cast("boolean")).otherwise(True)
    bounded = counted.where(few).drop("_days")
    joined = laid.join(F.broadcast(bounded), [*by.within, by.order], "left")
    return joined.withColumn("_doomed", F.coalesce("_doomed", F.lit(False)))


def _survivors(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    gone = F.col("_met") | (F.col("_touched") & F.col("_doomed"))
    return frame.where(F.col("_new") | ~gone).select(*columns)


def _outcomes() -> dict[str, Column]:
    """Per row of a merge frame, whether it counts as deleted, updated or inserted."""
    is_new, doomed = F.col("_new"), F.col("_doomed")
    updated = is_new & F.col("_met") & ~doomed
    return {"deleted": ~is_new & F.col("_touched") & doomed, "updated": updated, "inserted": is_new & ~updated}


def observed_merge(
    old: DataFrame, new: DataFrame, name: str, values: Sequence[str], tail_n: int = 2, merge: MergeKeys = PRICE_MERGE, by: str = "period"
) -> tuple[DataFrame, Observation]:
    """``delete_tail_merge`` and its report as a by-product: counters run along as the merged rows are written.

    ``values`` are the values of ``by`` that are reported. After the write, ``merge_counts`` reads the observation.
    """
    observation = Observation(name)
    counters = []
    for value in values:
        here = F.coalesce(F.col(by) == value, F.lit(False))
        counters += [F.count_if(here & told).alias(f"{value}.{what}") for what, told in _outcomes().items()]
    frame = _merge_frame(old, new, merge, tail_n, merge.keys)
    return _survivors(frame.observe(observation, *counters), old.columns), observation


def merge_counts(observation: Observation) -> list[tuple[str, int, int, int, int]]:
    """(value, deleted, updated, inserted, merged) of a finished merge; values without new rows are left out."""
    told: dict[str, dict[str, int]] = {}
    for name, count in observation.get.items():
        value, _, what = name.rpartition(".")
        told.setdefault(value, {})[what] = count
    rows = [(v, c["deleted"], c["updated"], c["inserted"], c["updated"] + c["inserted"]) for v, c in told.items()]
    return [r for r in rows if r[4]]


def _keep_old(
    old: DataFrame, new: DataFrame, keys: Sequence[str], tail_n: int, tail_keys: Sequence[str]
) -> DataFrame:
    """One exchange, on ``tail_keys``: the provisional rows are the latest of their group, and of what is left of a key
    the old row comes first, then the greatest in the order of the other columns, so that equal inputs give equal tables."""
    both = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    group = Window.partitionBy(*tail_keys)
    ties = [F.col(k).desc() for k in keys if k not in ("Date", *tail_keys)]
    # old rows before new ones, so that the rank of an old row counts old rows only
    latest = group.orderBy("_new", F.col("Date").desc(), *ties)
    ranked = both.withColumns({"_touched": F.bool_or("_new").over(group), "_rank": F.row_number().over(latest)})
    stays = F.col("_new") | ~F.col("_touched") | (F.col("_rank") > tail_n)
    rest = [F.col(c).desc_nulls_last() for c in both.columns if c not in keys and c != "_new"]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("_new", *rest))
    left = ranked.where(stays).drop("_touched", "_rank").withColumn("_copy", first)
    return left.where(F.col("_copy") == 1).drop("_copy", "_new")


def merge_report(
    old: DataFrame, new: DataFrame, keys: Sequence[str] = PRICE_KEYS, tail_n: int = 2
) -> DataFrame:
    """Rows deleted, updated and inserted per period by ``delete_tail_merge``, without merging."""
    frame = _merge_frame(old.select(*keys), new.select(*keys), PRICE_MERGE, tail_n)
    return (
        frame.groupBy("period")
        .agg(*(F.count_if(told).alias(what) for what, told in _outcomes().items()))
        .withColumn("merged", F.col("updated") + F.col("inserted"))
        .where("merged > 0")
    )
