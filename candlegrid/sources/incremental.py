"""Only the Parquet files that changed on a given local day."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.functions.calendar import local_date
from candlegrid.functions.text import file_stem, second_part
from candlegrid.sources.tables import _hadoop_path

def read_changed_files(
    spark: SparkSession,
    paths: str | list[str],
    day: date,
    zone: str,
    excluded: tuple[str, ...] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows of the ``.parquet`` files last changed on ``day`` in ``zone``.

    ``modifiedAfter`` and ``modifiedBefore`` drop other files when the source is
    listed, a day wider than needed; the file metadata then decides exactly. Adds file_stem
    (the ticker in a per-ticker layout) and file_period (2W in us_2W.parquet). Files whose path
    below the root that was read contains an ``excluded`` part are left out.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    start = datetime.combine(day, time.min, ZoneInfo(zone)).astimezone(ZoneInfo("UTC"))
    reader = spark.read if schema is None else spark.read.schema(schema)
    found = (
        reader.option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("modifiedAfter", _stamp(start - timedelta(days=1)))
        .option("modifiedBefore", _stamp(start + timedelta(days=2)))
        .option("timeZone", "UTC")
        .parquet(*paths)
    )
    path = F.col("_metadata.file_path")
    below = _below(spark, path, paths)
    keep = local_date(F.col("_metadata.file_modification_time"), zone) == F.lit(day)
    for part in excluded:
        keep = keep & ~below.contains(part)
    stem = file_stem(path)
    return found.where(keep).select(
        "*", stem.alias("file_stem"), second_part(stem).alias("file_period")
    )


def _below(spark: SparkSession, path: Column, roots: list[str]) -> Column:
    """The part of a file's path that lies below the root it was found under."""
    # file_path is a URI; a root may be given with or without scheme and host
    local = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    below = F.element_at(F.split(local, "/"), -1)
    for root in sorted(roots, key=len):
        at = _hadoop_path(spark, root)[1].toUri().getPath()
        below = F.when(local.startswith(at), F.substring(local, F.lit(len(at) + 1), F.length(local))).otherwise(below)
    return below


def _stamp(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%S")
