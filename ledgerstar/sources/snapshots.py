"""Snapshots of a warehouse: folders that never change and one manifest.

A load writes only new folders, each under its own run id, and then one small
manifest that names the folders of all tables. The manifest is the only thing
that a reader looks for, so the tables change together or not at all: a load
that ends early leaves folders that nothing names. Manifests are numbered and
created only if the number is free; of two loads that started from the same
snapshot, the second to finish is refused. A manifest that was cut off while
it was written is no snapshot.

A table is a set of named parts (part name -> folder). Append-only tables add
a part per load; tables in hash buckets have a part per bucket, of which a
load replaces those it touches; the fact has a part per day.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import sinks

MANIFESTS = "_snapshots"
BUCKET = "bucket"


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    batch_ts: str | None = None
    #: Start of the newest stored account version.
    newest_version: str | None = None
    buckets: int = 0
    #: table -> part name -> folder below the warehouse's root
    parts: dict[str, dict[str, str]] = field(default_factory=dict)
    #: table -> part name -> rows, where the load counted them
    rows: dict[str, dict[str, int]] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {path for parts in self.parts.values() for path in parts.values()}


class LoadConflict(RuntimeError):
    """Another load published a snapshot in the meantime."""


def new_run() -> str:
    return f"r{uuid.uuid4().hex}"


def _manifest(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}/{number:010d}.json"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers taken, in order; one may belong to a manifest that was cut off."""
    fs, p = sinks._fs(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read(spark: SparkSession, root: str, number: int) -> Snapshot | None:
    fs, p = sinks._fs(spark, _manifest(root, number))
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return Snapshot(**json.loads(text))
    except ValueError:
        return None


def latest(spark: SparkSession, root: str) -> Snapshot | None:
    for n in reversed(numbers(spark, root)):
        found = read(spark, root, n)
        if found is not None:
            return found
    return None


def publish(spark: SparkSession, root: str, snapshot: Snapshot, before: Snapshot | None) -> Snapshot:
    """Make ``snapshot`` the newest, if ``before`` (what it was built from) still is."""
    now = latest(spark, root)
    if (now.number if now else 0) != (before.number if before else 0):
        raise LoadConflict(f"snapshot {now.number if now else 0} was published while this load ran")
    taken = numbers(spark, root)
    numbered = Snapshot(**{**asdict(snapshot), "number": (taken[-1] if taken else 0) + 1})
    fs, p = sinks._fs(spark, _manifest(root, numbered.number))
    try:
        out = fs.create(p, False)  # fails if the number has been taken
    except Py4JJavaError as e:
        raise LoadConflict(f"snapshot {numbered.number} was published while this load ran") from e
    try:
        out.write(bytearray(json.dumps(asdict(numbered)).encode()))
    finally:
        out.close()
    return numbered


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write(df: DataFrame, path: str) -> None:
    """Every write of a load goes through here, into a folder of its own run."""
    df.write.parquet(path)


def write_parts(df: DataFrame, path: str, by: str, cluster: str | None = None, bloom: Iterable[str] = ()) -> None:
    """One folder per value of ``by``, written once; a large value is split into several files.

    The rows of a file are sorted by ``cluster``, so that a lookup by it skips
    row groups and pages by their statistics; columns in ``bloom`` get Bloom
    filters, sized by what a row group holds, for lookups the order does not serve.
    """
    out = df.hint("rebalance", by)
    if cluster:
        out = out.sortWithinPartitions(by, cluster)
    w = out.write.partitionBy(by)
    for c in bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    w.parquet(path)


def read_parts(spark: SparkSession, root: str, paths: Iterable[str], schema: StructType) -> DataFrame:
    """The rows of the given folders; no folder, no rows."""
    r = root.rstrip("/")
    full = [f"{r}/{p}" for p in paths]
    return spark.read.schema(schema).parquet(*full) if full else spark.createDataFrame([], schema)


def table(spark: SparkSession, root: str, snapshot: Snapshot | None, name: str, schema: StructType,
          only: Iterable | None = None) -> DataFrame:
    """A table of the snapshot, or the parts in ``only`` of it."""
    parts = snapshot.parts.get(name, {}) if snapshot else {}
    wanted = parts if only is None else {str(k) for k in only} & set(parts)
    return read_parts(spark, root, sorted({parts[k] for k in wanted}), schema)


def by_day(spark: SparkSession, root: str, snapshot: Snapshot | None, name: str, schema: StructType, day: str) -> DataFrame:
    """A table with a part ``<name>/load=<run>/<day>=<value>`` per day. Filters
    on the day prune folders, whichever load wrote them."""
    paths = sorted(set(snapshot.parts.get(name, {}).values())) if snapshot else []
    if not paths:
        return spark.createDataFrame([], schema)
    r = root.rstrip("/")
    read = spark.read.schema(schema).option("basePath", f"{r}/{name}").parquet(*[f"{r}/{p}" for p in paths])
    return read.select([f.name for f in schema.fields])


def upsert_buckets(spark: SparkSession, root: str, before: Snapshot | None, name: str, schema: StructType, key: str,
                   changed: DataFrame, run: str, buckets: int) -> dict[str, str]:
    """Put the rows of ``changed`` in place of those with their keys. Only the
    buckets of these keys are read and written; returns their new folders."""
    tagged = changed.withColumn(BUCKET, bucket_of(key, buckets))
    touched = sorted(x[0] for x in tagged.select(BUCKET).distinct().collect())  # at most ``buckets``
    if not touched:
        return {}
    path = f"{name}/load={run}"
    old = table(spark, root, before, name, schema, touched).join(changed.select(key), key, "left_anti").withColumn(BUCKET, bucket_of(key, buckets))
    cols = [f.name for f in schema.fields]
    write_parts(old.select(*cols, BUCKET).unionByName(tagged.select(*cols, BUCKET)), f"{root.rstrip('/')}/{path}", BUCKET)
    return {str(b): f"{path}/{BUCKET}={b}" for b in touched}


def expire(spark: SparkSession, root: str, keep: int, debris: bool = False) -> list[str]:
    """Remove all but the newest ``keep`` snapshots, with the folders that only
    they name; the newest always stays. ``debris`` also removes folders that
    no snapshot names: what failed loads left, but also what a load still
    running has written. Returns the folders removed."""
    r = root.rstrip("/")
    found = {n: read(spark, r, n) for n in numbers(spark, r)}
    whole = [n for n in sorted(found) if found[n] is not None]
    stay = set(whole[-max(1, keep):])
    gone = [n for n in found if n not in stay]
    needed = {p for n in stay for p in found[n].folders()}
    removed = sorted({p for n in gone if found[n] for p in found[n].folders()} - needed)
    for n in gone:  # first the names, so that no snapshot names a folder that is gone
        sinks.remove(spark, _manifest(r, n))
    if debris:
        fs, base = sinks._fs(spark, r)
        runs = [(t.getPath().getName(), s.getPath().getName()) for t in fs.listStatus(base) if t.isDirectory() and t.getPath().getName() != MANIFESTS
                for s in fs.listStatus(t.getPath()) if s.getPath().getName().startswith("load=")]
        removed += [f"{t}/{s}" for t, s in runs if not any(p == f"{t}/{s}" or p.startswith(f"{t}/{s}/") for p in needed)]
    for path in removed:
        sinks.remove(spark, f"{r}/{path}")
    return removed
