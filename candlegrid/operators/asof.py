"""As-of join of several slower series onto one faster series."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_many(
    probes: DataFrame,
    events: DataFrame,
    tolerance_days: Mapping[str, int],
    values: tuple[str, ...],
    *,
    key: str = "ticker",
    date: str = "Date",
    kind: str = "period",
) -> DataFrame:
    """For each probe row and each kind, the latest event dated up to probe date + tolerance.

    ``tolerance_days`` maps each kind to its look-ahead. The result holds the probe
    columns and, per kind, one struct column named by the kind with the event's
    ``date`` and ``values``; NULL where nothing qualifies.

    Every kind is served by one exchange and one sort: an event is moved back by
    its own tolerance, so "event date <= probe date + tolerance" becomes "moved
    date <= probe date", and a running last-non-null over the merged rows finds
    the match. Events sort before probes on equal dates. No pairs are formed, so
    the work is linear in the rows of a key.
    """
    event_rows = events.where(F.col(kind).isin(*tolerance_days)).select(
        F.col(key),
        F.date_sub(F.col(date), _by_kind(F.col(kind), tolerance_days)).alias("_at"),
        F.lit(0).alias("_probe"),
        F.col(kind).alias("_kind"),
        F.struct(F.col(date), *(F.col(v) for v in values)).alias("_event"),
    )
    probe_rows = probes.select(
        F.col(key),
        F.col(date).alias("_at"),
        F.lit(1).alias("_probe"),
        F.struct(*(F.col(c) for c in probes.columns)).alias("_row"),
    )
    merged = event_rows.unionByName(probe_rows, allowMissingColumns=True)
    found = _latest(key, F.col("_kind"), F.col("_event"), tolerance_days)
    # exchanged here, before the window splits the event into one column per kind
    return merged.repartition(key).select("_probe", "_row", *found).where(F.col("_probe") == 1).select(
        *(F.col("_row")[c].alias(c) for c in probes.columns), *tolerance_days
    )


def asof_within(
    rows: DataFrame,
    is_probe: Column,
    tolerance_days: Mapping[str, int],
    values: tuple[str, ...],
    *,
    key: str = "ticker",
    date: str = "Date",
    kind: str = "period",
) -> DataFrame:
    """As ``asof_many`` where one frame holds both: its probe rows, and events as the rest.

    The frame is read once. The result holds the probe rows' key, date and values.
    """
    moved = F.date_sub(F.col(date), _by_kind(F.col(kind), tolerance_days))
    merged = rows.select(
        key,
        date,
        *values,
        F.when(is_probe, F.col(date)).otherwise(moved).alias("_at"),
        F.when(is_probe, 1).otherwise(0).alias("_probe"),
        F.when(~is_probe, F.col(kind)).alias("_kind"),
    )
    event = F.struct(F.col(date), *(F.col(v) for v in values))
    found = _latest(key, F.col("_kind"), event, tolerance_days)
    shown = [key, date, *values]
    return merged.repartition(key).select(*shown, "_probe", *found).where(F.col("_probe") == 1).drop("_probe")


def _latest(key: str, kind: Column, event: Column, kinds: Iterable[str]) -> list[Column]:
    """Per kind, the last event at or before each row of the merged timeline.

    Rows travel with one event column; it is told apart by kind behind the exchange on ``key``.
    """
    timeline = (
        Window.partitionBy(key)
        .orderBy("_at", "_probe")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return [F.last(F.when(kind == k, event), ignorenulls=True).over(timeline).alias(k) for k in kinds]


def _by_kind(kind: Column, days: Mapping[str, int]) -> Column:
    chosen = None
    for k, d in days.items():
        chosen = F.when(kind == k, d) if chosen is None else chosen.when(kind == k, d)
    return chosen
