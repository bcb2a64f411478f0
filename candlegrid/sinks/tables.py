"""Writing tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.sources.tables import _hadoop_path

VERSION = "version="
CLAIM = "_claim="
BUCKET = "_bucket"
#: Ending of the folder in which replaced buckets are prepared.
BESIDE = "__replaced"


def date_first(df: DataFrame, column: str = "Date") -> DataFrame:
    return df.select(F.to_date(column).alias(column), *(c for c in df.columns if c != column))


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), whole: bool = False
) -> None:
    """Overwrite a snappy Parquet table.

    With ``partition_by`` only the partitions in ``df`` are replaced, unless ``whole``, and rows
    are brought together by partition first, so that a partition is written as few files.
    ``sort_by`` orders rows within files, so that reads by those columns skip row groups.
    """
    writer = df
    if partition_by:
        # REBALANCE splits a partition that is too large for one file and joins small ones
        writer = df.hint("rebalance", *(F.col(c) for c in partition_by))
    if sort_by:
        writer = writer.sortWithinPartitions(*partition_by, *sort_by)
    out = writer.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        # only a static overwrite leaves the marker of a finished job
        mode = "static" if whole else "dynamic"
        out = out.option("partitionOverwriteMode", mode).partitionBy(*partition_by)
    out.parquet(path)


def _versions(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """(version, complete) of every version under ``path``, oldest first."""
    fs, root = _hadoop_path(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(VERSION):
            marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            found.append((int(name[len(VERSION) :]), fs.exists(marker)))
    return sorted(found)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Path of the newest complete version of a staged table, None before the first."""
    done = [v for v, complete in _versions(spark, path) if complete]
    return f"{path}/{VERSION}{done[-1]:08d}" if done else None


def read_current(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    at = current_version(spark, path)
    if at is None:
        return None
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(at)


def _claims(fs, root) -> list[str]:
    return [s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith(CLAIM)]


def _claim(spark: SparkSession, path: str) -> int:
    """The number of the next version, held by a marker that only one writer can create.

    A table has one writer at a time: with another's marker there is no version to build on. What was listed before
    the marker may be stale by then, so both are looked at again once it is there.
    """
    fs, root = _hadoop_path(spark, path)
    fs.mkdirs(root)
    following = max([0, *(v for v, _ in _versions(spark, path))]) + 1
    own = f"{CLAIM}{following:08d}"
    busy = f"version {following} of {path} or one before it is being written; remove its {CLAIM} marker if the writer was lost"
    if _claims(fs, root):
        raise FileExistsError(busy)
    marker = spark._jvm.org.apache.hadoop.fs.Path(root, own)
    fs.create(marker, False).close()
    if _claims(fs, root) != [own] or following <= max([0, *(v for v, _ in _versions(spark, path))]):
        fs.delete(marker, False)
        raise FileExistsError(busy)
    return following


def staged_update(
    spark: SparkSession,
    path: str,
    update: Callable[..., DataFrame],
    partition_by: Sequence[str] = (),
    keep: int = 2,
    schema: T.StructType | None = None,
    batch: DataFrame | None = None,
    sort_by: Sequence[str] = (),
) -> str:
    """Write ``update(current table)`` as the next version; returns its path.

    A table cannot be overwritten while it is read, so each update writes a fresh
    version. The marker that a finished job leaves makes it current; a job lost half-way
    leaves nothing current behind. Older versions beyond ``keep`` are removed, and what lost
    writers left. While a table is being written, other writers fail.

    With ``batch`` the batch is written once beside the table and ``update`` gets
    (current table, stored batch): a merge reads its batch several times, and would
    compute it as often.
    """
    fs, root = _hadoop_path(spark, path)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    following = _claim(spark, path)
    target, beside = f"{path}/{VERSION}{following:08d}", f"{path}/batch={following:08d}"
    try:
        old = read_current(spark, path, schema)
        if batch is None:
            merged = update(old)
        else:
            write_table(batch, beside)
            merged = update(old, spark.read.schema(batch.schema).parquet(beside))
        write_table(merged, target, partition_by, sort_by, whole=True)
    finally:
        fs.delete(path_of(beside), True)
        fs.delete(path_of(root, f"{CLAIM}{following:08d}"), False)
    versions = _versions(spark, path)
    done = [v for v, complete in versions if complete]
    lost = [v for v, complete in versions if not complete and v < following]
    for v in [*done[: -max(keep, 1)], *lost]:
        fs.delete(path_of(f"{path}/{VERSION}{v:08d}"), True)
    return target


def bucket_of(column: str, buckets: int) -> Column:
    """The bucket of a key: a partition that holds all its rows."""
    return F.pmod(F.xxhash64(F.col(column)), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int, sort_by: Sequence[str] = ()) -> None:
    """A whole table partitioned by the bucket of ``key``."""
    write_table(df.withColumn(BUCKET, bucket_of(key, buckets)), path, [BUCKET], sort_by, whole=True)


def read_buckets(spark: SparkSession, path: str, held: Sequence[int] | None = None) -> DataFrame:
    """A table written in buckets; with ``held`` only those are listed and read."""
    df = spark.read.parquet(path)
    if held is not None:
        df = df.where(F.col(BUCKET).isin(list(held)))
    return df.drop(BUCKET)


def replace_keys(
    spark: SparkSession, path: str, rows: DataFrame, changed: DataFrame, key: str, buckets: int, sort_by: Sequence[str] = ()
) -> list[int]:
    """Replace all rows of the keys in ``changed`` by ``rows``, and rewrite only the buckets they are in; returns these.

    The other buckets are neither read nor written. The touched ones are written beside the table first, since a
    table can't be overwritten while it is read, and then moved over them one by one; a call that was lost while moving is
    finished by the next. ``rows`` may depend on the table. At most ``buckets`` numbers come to the driver.
    """
    fs, root = _hadoop_path(spark, path)
    beside = f"{path}{BESIDE}"
    _move_buckets(spark, beside, path)  # what a lost call had prepared
    changed = changed.select(key).distinct()
    held = sorted(r[0] for r in changed.select(bucket_of(key, buckets)).distinct().collect())
    if not held:
        return held
    kept = read_buckets(spark, path, held).join(changed, key, "left_anti")
    merged = kept.unionByName(rows.join(changed, key, "left_semi"))
    write_buckets(merged, beside, key, buckets, sort_by)
    full = _move_buckets(spark, beside, path)
    for b in held:
        if b not in full:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(root, f"{BUCKET}={b}"), True)
    return held


def _move_buckets(spark: SparkSession, beside: str, path: str) -> set[int]:
    """Move the buckets of a finished write over those of a table; each stays beside it until it is there."""
    fs, root = _hadoop_path(spark, path)
    at = spark._jvm.org.apache.hadoop.fs.Path(beside)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    moved = set()
    if fs.exists(path_of(at, "_SUCCESS")):
        for status in fs.listStatus(at):
            name = status.getPath().getName()
            if name.startswith(f"{BUCKET}="):
                fs.delete(path_of(root, name), True)
                if not fs.rename(status.getPath(), path_of(root, name)):
                    raise OSError(f"{name} of {beside} could not be moved")
                moved.add(int(name[len(BUCKET) + 1 :]))
    fs.delete(at, True)
    return moved


def write_jdbc_staging(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Load a warehouse staging table, replacing it. Needs the driver jar; not exercised here."""
    df.write.mode("overwrite").format("jdbc").options(url=url, dbtable=table, **options).save()
