"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_spark(app_name: str = "ledgerstar", master: str | None = None,
                shuffle_partitions: int | None = None,
                advisory_partition_bytes: str | None = None,
                max_partition_bytes: str | None = None) -> SparkSession:
    """Session with UTC, AQE (coalescing + skew join) and no web UI.

    ``shuffle_partitions`` is an upper bound; AQE coalesces small partitions
    at runtime toward ``advisory_partition_bytes`` and splits skewed ones, so
    the same setting works for small and large inputs.
    ``max_partition_bytes`` sizes input splits of the file scans.
    """
    b = (SparkSession.builder.appName(app_name)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if advisory_partition_bytes:
        b = b.config("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory_partition_bytes)
    if max_partition_bytes:
        b = b.config("spark.sql.files.maxPartitionBytes", max_partition_bytes)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (or a directory set on the context). Only
    in local mode, where nothing is shared anyway, a private folder is
    created when none is configured; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master.startswith("local"):
        d = tempfile.mkdtemp(prefix="ledgerstar-ckpt-")
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
