"""Incremental runs as a Structured Streaming job (X10).

New raw files landing in a folder are picked up by a file-source stream;
each micro-batch runs the transform and load jobs (``foreachBatch``). With
``Trigger.AvailableNow`` a scheduler can start the job periodically: it
processes everything that arrived since the last run and stops. The stream
checkpoint records which files are done, so a restarted run neither skips
nor repeats files, and the loads themselves are idempotent (a replayed
micro-batch finds its rows stored and no account changes).
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import jobs
from ..schemas import RAW_COLUMNS, RAW_SCHEMA
from ..sources import sinks
from ..sources.raw import events_as_transactions, with_defects
from ..session import checkpoint_dir

BASE_BATCH_TS = "2024-02-01 00:00:00"


def batch_ts_for(batch_id: int) -> str:
    """Deterministic load timestamp of a micro-batch (a replay gets the same):
    the base timestamp plus one hour per batch id."""
    base = datetime.datetime.fromisoformat(BASE_BATCH_TS)
    return (base + datetime.timedelta(hours=int(batch_id))).strftime("%Y-%m-%d %H:%M:%S")


def load_each_batch(root: str, salt: str,
                    to_raw: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Transform the micro-batch and append what the warehouse does not hold
    yet to its days. A day may so arrive in any number of drops, and each
    drop reads, moves and writes only rows of its own hours. A micro-batch
    that runs again finds its rows stored."""
    r = root.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staging = f"{r}/staging/batch={batch_id}"
        report = jobs.run_transform(to_raw(batch).select(*RAW_COLUMNS), staging, salt)
        if report["rows_out"]:
            jobs.run_load(spark, jobs.read_staged(spark, staging), f"{r}/warehouse", batch_ts_for(batch_id), append=True)
        rejected = f"{r}/rejected/batch={batch_id}"
        sinks.remove(spark, rejected)
        jobs.read_rejected(spark, staging).write.parquet(rejected)
        sinks.remove(spark, staging)
    return run


def start_incremental(spark: SparkSession, source_dir: str, root: str, salt: str,
                      fmt: str = "csv", glob: str | None = None,
                      to_raw: Callable[[DataFrame], DataFrame] | None = None,
                      schema=None, available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; returns the StreamingQuery. ``max_files_per_trigger``
    bounds a micro-batch; without it, one takes all that has arrived."""
    reader = spark.readStream.format(fmt).schema(schema or RAW_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # each drop may arrive as its own folder of part files
    reader = reader.option("recursiveFileLookup", "true")
    stream = reader.load(source_dir)
    w = (stream.writeStream
         .foreachBatch(load_each_batch(root, salt, to_raw or (lambda df: df)))
         .option("checkpointLocation", f"{root.rstrip('/')}/_stream_checkpoint"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_events_incremental(spark: SparkSession, sf_dir: str, salt: str, root: str | None = None) -> str:
    """Drive the incremental job over ``{sf_dir}/events.parquet`` (dirty
    variant) until everything available is loaded; returns the root."""
    root = root or f"{checkpoint_dir(spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    q = start_incremental(
        spark, sf_dir, root, salt, fmt="parquet", glob="events.parquet", schema=schema,
        to_raw=lambda df: with_defects(events_as_transactions(df, keep_event_id=True)).drop("event_id"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return root


def run_events_in_drops(spark: SparkSession, sf_dir: str, salt: str, drops: int = 8) -> str:
    """The same events dealt over several drops by id: every day arrives in
    each of them. Returns the root."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/drops-{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    for n in range(drops):
        events.where(F.col("event_id") % drops == n).write.parquet(f"{base}/source/drop={n}")
        q = start_incremental(
            spark, f"{base}/source", f"{base}/run", salt, fmt="parquet", glob="*.parquet", schema=events.schema,
            to_raw=lambda df: with_defects(events_as_transactions(df, keep_event_id=True)).drop("event_id"))
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return f"{base}/run"
