"""One Arrow pass over all (ticker, period) series, many at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import candlegrid

# Executors need not have this package installed: its functions travel with the task.
cloudpickle.register_pickle_by_value(candlegrid)

SERIES = ("ticker", "period")
ROW = "_row"
#: Rows of a batch of series. Averages advance row by row over all of them, so many series are worked on at once.
BATCH_ROWS = 200_000


def row_in_series() -> Column:
    """1-based row of a series in date order. Its window also lays the series out for a pass.

    A series that repeats a day is refused as the query runs: a day a row is what bounds a
    series, and with two rows of a day their order would be chance. ``last_bar_per_day``
    thins such a source before anything is shuffled.
    """
    ordered = Window.partitionBy(*SERIES).orderBy("Date")
    repeated = F.lag("Date").over(ordered) == F.col("Date")
    message = F.lit("a series repeats a day; see last_bar_per_day")
    return F.when(repeated, F.raise_error(message).cast("int")).otherwise(F.row_number().over(ordered))


class Series(Mapping):
    """Columns of series that stand one after the other, as arrays, converted when first used; missing numbers are NaN.

    ``starts`` has the first row of each series.
    """

    def __init__(self, table: pa.Table, starts: np.ndarray) -> None:
        self._table, self.starts = table, starts
        self._arrays: dict[str, np.ndarray] = {}

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self._arrays:
            self._arrays[name] = self._table.column(name).to_numpy()
        return self._arrays[name]

    def __iter__(self) -> Iterator[str]:
        return iter(dict.fromkeys([*self._table.column_names, *self._arrays]))

    def __len__(self) -> int:
        return sum(1 for _ in self)

    @property
    def rows(self) -> int:
        return self._table.num_rows

    def add(self, columns: Mapping[str, np.ndarray]) -> None:
        self._arrays.update(columns)


Step = Callable[[Series], Mapping[str, np.ndarray]]


def _arrow(values: np.ndarray, kind: T.DataType) -> pa.Array:
    if isinstance(kind, T.LongType):  # positions travel as doubles, NaN for none
        missing = np.isnan(values)
        return pa.array(np.where(missing, 0, values).astype(np.int64), mask=missing)
    return pa.array(values, from_pandas=True)


def whole_series(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Regroup ordered batches so that none splits a series; also gives each series' first row.

    Batches are joined up to about ``BATCH_ROWS`` rows; beyond these only the unfinished last
    series is held back, so memory is bounded by them and one series, and a series by the calendar.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def checked(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(parts)
        row = table.column(ROW).to_numpy()
        if row[0] != 1 or np.any((row[1:] != row[:-1] + 1) & (row[1:] != 1)):
            raise ValueError("rows of a series are not together and in date order")
        return table, np.flatnonzero(row == 1)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows += batch.num_rows
        starts = np.flatnonzero(batch.column(ROW).to_numpy() == 1) if rows >= BATCH_ROWS else ()
        if len(starts) and (starts[-1] > 0 or held):
            cut = int(starts[-1])
            done = [*held, batch.slice(0, cut)] if cut else held
            yield checked(done)
            held = [batch.slice(cut)]
            rows = held[0].num_rows
        else:
            held.append(batch)
    if held:
        yield checked(held)


def series_pass(
    df: DataFrame,
    steps: Sequence[Step],
    added: Sequence[tuple[str, T.DataType]],
    dropped: Sequence[str] = (),
) -> DataFrame:
    """Run ``steps`` in order on batches of whole (ticker, period) series, in date order.

    ``df`` must carry ``row_in_series()`` as its ``_row`` column: the window behind it
    keeps a series in one partition and in order, and the pass checks that it did.
    A series has at most one row per calendar day, so no task holds an unbounded
    group. Steps see the columns made by the steps before them. ``dropped`` input
    columns are not sent back.
    """
    kept = [f for f in df.schema.fields if f.name not in dropped]
    schema = T.StructType(kept + [T.StructField(name, kind, True) for name, kind in added])
    kept_names = [f.name for f in kept]
    names = kept_names + [name for name, _ in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_series(batches):
            series = Series(table.combine_chunks(), starts)
            for step in steps:
                series.add(step(series))
            columns = [table.column(c) for c in kept_names]
            columns += [_arrow(series[name], kind) for name, kind in added]
            yield from pa.table(columns, names=names).to_batches()

    return df.mapInArrow(run, schema)
