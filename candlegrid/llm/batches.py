"""Running a per-text function over Arrow batches, and writing intermediate tables."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are handed over in slices of about so many bytes; one longer text makes a slice of its own.
SLICE_BYTES = 4_000_000


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of the batch whose texts hold about `limit` bytes, whole texts only."""
    sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(
    docs: DataFrame,
    make: Callable[[], Callable[[list[str | None]], Sequence[Sequence]]],
    columns: Sequence[T.StructField],
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of docs as (id, keep.., columns): make() builds, once per task, a function from a list of texts to one list per column.

    The text itself comes along, after the others, if keep names it.
    """
    with_text = text_col in keep
    keep = [k for k in keep if k != text_col]
    picked = docs.select(F.col(id_col), *[F.col(k) for k in keep], F.col(text_col).cast("string").alias(text_col))
    n_kept = len(picked.columns) - 1
    n_out = n_kept + with_text
    schema = T.StructType([*picked.schema.fields[:n_out], *columns])
    types = [_arrow(c.dataType) for c in columns]
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for whole in batches:
            for part in slices(whole, n_kept):
                made = apply(part.column(n_kept).to_pylist())
                arrays = [pa.array(values, kind) for values, kind in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_out], *arrays], names=names)
                del made, arrays
        del apply
        give_back()

    return picked.mapInArrow(run, schema)


def give_back() -> None:
    """Returns what a task has freed to the system: workers live on, and idle ones count against an executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind.fields])
    return {
        "string": pa.string(),
        "binary": pa.binary(),
        "bigint": pa.int64(),
        "int": pa.int32(),
        "smallint": pa.int16(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
    }[kind.simpleString()]


def shared_folder(spark: SparkSession) -> str:
    """The folder of the cluster's checkpoints; without one, as on one machine in tests, a folder of this run's own."""
    setting = spark.conf.get("spark.checkpoint.dir", None)
    if not setting:
        setting = tempfile.mkdtemp(prefix="candlegrid-")
        spark.conf.set("spark.checkpoint.dir", setting)
    return setting


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet into the shared folder and read from there, so that nothing above it runs again."""
    path = os.path.join(shared_folder(frame.sparkSession), f"{name}-{uuid.uuid4().hex}")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def digest_key(text: str = "text"):
    """A key by which equal texts are equal: 128 bits of two hashes; null has one of its own."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit("\u0000null"))
    return F.struct(F.xxhash64(whole).alias("a"), F.xxhash64(whole, F.lit(1)).alias("b"))


class Memo(dict):
    """A dict that computes what it lacks. At `limit` entries the older half's role is taken by what is in use."""

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found
