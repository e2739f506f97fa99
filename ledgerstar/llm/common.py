"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: what follows never recomputes ``df``, also when an
    executor that computed it is lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are out of scope.

    Spark cleans them when the driver's JVM collects its garbage, which on a
    driver with little to do may not happen for hours.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def arrow_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches, one at a time, so that a batch of long texts is
    never held twice."""
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            yield tuple(v.as_py() for v in row)


def arrow_out(schema: pa.Schema, rows: Iterator[tuple], size: int = 4096,
              weight: Callable[[tuple], int] | None = None, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Group rows into Arrow batches of ``size`` rows, or fewer when the sum
    of their ``weight`` (bytes) passes ``most``."""
    held: list[tuple] = []
    total = 0
    for row in rows:
        held.append(row)
        total += weight(row) if weight else 0
        if len(held) >= size or total >= most:
            yield _batch(schema, held)
            held, total = [], 0
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
