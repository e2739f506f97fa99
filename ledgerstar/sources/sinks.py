"""Parquet sinks of the staging: small dimensions and the day-partitioned
fact. The warehouse's own tables are written by ``snapshots``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; none there is no error."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_dimension(df: DataFrame, path: str, single_file: bool = True) -> None:
    """Full overwrite. One file for the small dimensions; size-balanced
    files (AQE rebalance) for a dimension that grows with the data."""
    out = df.coalesce(1) if single_file else df.hint("rebalance")
    out.write.mode("overwrite").parquet(path)


def write_fact(df: DataFrame, path: str, replace_days_only: bool = True,
               layout: str = "day") -> None:
    """Day-partitioned fact.

    ``rebalance(partition_date)`` gives about one file per day but lets AQE
    split a day that is much larger than the advisory partition size, so a
    hot day does not end up in one task. With ``replace_days_only`` the
    write uses dynamic partition overwrite: only the days present in ``df``
    are replaced, all other days stay (replace-by-partition). ``layout="week"``
    stores weekly folders instead (fewer, larger files for small daily volumes).
    """
    part = "partition_date"
    if layout == "week":  # weekly folders (Monday start) in place of daily ones
        part = "partition_week"
        df = df.withColumn(part, F.date_trunc("week", F.col("partition_date")).cast("date"))
    elif layout != "day":
        raise ValueError(f"unknown layout {layout!r}")
    w = df.hint("rebalance", part).write.mode("overwrite").partitionBy(part)
    if replace_days_only:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
