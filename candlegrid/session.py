"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "candlegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; cluster settings are left to the cluster.

    ``conf`` takes Spark keys with dots written as double underscores.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        # the gold table is wide: generated methods over 8000 bytes are not compiled by the JVM
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
