"""The two batch jobs: transform (raw -> validated staging Parquet) and load
(staging -> warehouse state), each writing every table once."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality as Q
from ..operators import warehouse as W
from ..operators.clean import CORRUPT_COLUMN, REJECTED_BY, accepted, judged, judged_counts
from ..operators.dimensions import (account_dimension, date_dimension, dim_transaction_type,
                                    fact_staging, merchant_dimension)
from ..operators.enrich import enrich
from ..schemas import (DIM_ACCOUNT, DIM_ACCOUNT_STAGING, DIM_DATE, DIM_MERCHANT, DIM_MERCHANT_STAGING,
                       DIM_TRANSACTION_TYPE, FACT_STAGING, FACT_TRANSACTIONS, RAW_SCHEMA)
from ..sources import sinks, snapshots
from ..sources.conform import conform
from .star import Staged, Warehouse


VALIDATED_MARKER = "_validated"
#: Ids that hold many rows of the staged facts.
HOT = "hot_ids"
#: Raw rows by outcome; of a finished transform only the rejected ones are left.
ROWS = "rows"


def run_transform(raw: DataFrame, out: str, salt: str, validate: bool = True,
                  strict_types: bool = False) -> dict:
    """Clean, enrich and write the fact staging, then build, write and
    validate the dimensions derived from it.

    The raw input is read once. Its rows are written as they are, each with
    the first rule that it fails; the staging is built from those without
    one, and the others stay in ``rejected``. The counts by rule are taken
    from the same files.

    The ``_validated`` marker of an earlier run is removed first and written
    last: whatever fails in between leaves a folder that the load refuses to
    read. The dimensions are read from the written fact, only the columns they
    need, and what is validated is what was written. Counts are taken from
    the written tables; rows dropped by rule from one aggregate over the raw
    rows. Neither counts a task twice that had to run again.
    """
    spark = raw.sparkSession
    o = out.rstrip("/")
    sinks.remove(spark, f"{o}/{VALIDATED_MARKER}")
    corrupt = CORRUPT_COLUMN in raw.columns
    split = judged(raw, strict_types).withColumn("outcome", F.when(F.col(REJECTED_BY).isNull(), "accepted").otherwise("rejected"))
    split.write.mode("overwrite").partitionBy("outcome").parquet(f"{o}/{ROWS}")
    rows = spark.read.schema(split.schema).parquet(f"{o}/{ROWS}")
    txn = enrich(accepted(rows.where("outcome = 'accepted'"), strict_types), salt)
    # staging holds exactly this batch: static overwrite of the folder
    sinks.write_fact(fact_staging(txn), f"{o}/fact_transactions", replace_days_only=False)
    fact = _read(spark, f"{o}/fact_transactions", FACT_STAGING)

    _together(lambda: sinks.write_dimension(account_dimension(fact), f"{o}/dim_account", single_file=False),
              lambda: sinks.write_dimension(merchant_dimension(fact), f"{o}/dim_merchant", single_file=False),
              lambda: sinks.write_dimension(date_dimension(fact), f"{o}/dim_date"),
              lambda: sinks.write_dimension(W.hot_ids(fact), f"{o}/{HOT}"))
    tables = {"fact": fact, "dim_account": _read(spark, f"{o}/dim_account", DIM_ACCOUNT_STAGING),
              "dim_merchant": _read(spark, f"{o}/dim_merchant", DIM_MERCHANT_STAGING), "dim_date": _read(spark, f"{o}/dim_date", DIM_DATE)}
    *counted, rules = _together(*[df.count for df in tables.values()], lambda: judged_counts(rows, corrupt).first().asDict())
    counts = dict(zip(tables, counted, strict=True))
    passed = rules.pop("passed")
    report = {**rules, "dropped_duplicates": passed - counts["fact"], "rows_out": counts["fact"],
              "dropped": rules["rows_in"] - counts["fact"], "rows": counts}
    sinks.remove(spark, f"{o}/{ROWS}/outcome=accepted")
    if validate:
        report["validation"] = Q.assert_ok(Q.validate_staging(fact, tables["dim_account"]))
    spark.createDataFrame([(str(report),)], "report string").coalesce(1) \
        .write.mode("overwrite").text(f"{o}/{VALIDATED_MARKER}")
    return report


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The raw rows that a transform left out, with the first rule that each failed."""
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(REJECTED_BY, T.StringType()), T.StructField("corrupt", T.BooleanType()), T.StructField("outcome", T.StringType())])
    rows = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{ROWS}")
    return rows.where("outcome = 'rejected'").drop("outcome")


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that a job wrote; an empty one has no files to take a schema from."""
    return spark.read.schema(schema).parquet(path)


def read_staged(spark: SparkSession, path: str) -> Staged:
    p = path.rstrip("/")
    if not sinks.path_exists(spark, f"{p}/{VALIDATED_MARKER}"):
        raise FileNotFoundError(f"{p} is not a complete, validated staging folder")

    def table(name: str, schema) -> DataFrame:
        return conform(_read(spark, f"{p}/{name}", schema), schema)

    return Staged(table("dim_account", DIM_ACCOUNT_STAGING), table("dim_merchant", DIM_MERCHANT_STAGING),
                  table("dim_date", DIM_DATE), table("fact_transactions", FACT_STAGING),
                  _read(spark, f"{p}/{HOT}", W.HOT_SCHEMA) if sinks.path_exists(spark, f"{p}/{HOT}") else None)


HISTORY = "dim_account_closed"
CHANGES = "dim_account_changes"
ACCOUNT_CHANGES = T.StructType([
    T.StructField("account_id", T.StringType()), T.StructField("action", T.StringType()),
    T.StructField("closed", DIM_ACCOUNT), T.StructField("opened", DIM_ACCOUNT)])
#: Accounts per hash bucket of the account and merchant dimensions at a
#: warehouse's first load, which sets the number of buckets for good: a power
#: of two from 4 to 4096.
BUCKET_ACCOUNTS = 50_000
#: Snapshots that a load leaves readable, its own included.
KEEP_SNAPSHOTS = 20


def read_warehouse(spark: SparkSession, root: str, number: int | None = None) -> Warehouse:
    """The tables of the newest snapshot, or of an older one that is kept."""
    found = snapshots.latest(spark, root) if number is None else snapshots.read(spark, root, number)
    if found is None:
        raise FileNotFoundError(f"no warehouse at {root}" if number is None else f"no snapshot {number} at {root}")
    return warehouse_of(spark, root, found)


def warehouse_of(spark: SparkSession, root: str, found: snapshots.Snapshot) -> Warehouse:
    def table(name: str, schema) -> DataFrame:
        return snapshots.table(spark, root, found, name, schema)

    return Warehouse(snapshots.by_day(spark, root, found, "fact_transactions", FACT_TRANSACTIONS, "partition_date"),
                     table("dim_account", DIM_ACCOUNT).unionByName(table(HISTORY, DIM_ACCOUNT)),
                     table("dim_merchant", DIM_MERCHANT), table("dim_date", DIM_DATE), table("dim_transaction_type", DIM_TRANSACTION_TYPE))


def run_load(spark: SparkSession, staged: Staged, root: str, batch_ts: str, buckets: int | None = None,
             keep: int = KEEP_SNAPSHOTS, append: bool = False) -> dict:
    """Date (insert-if-new) -> merchant (type 1) -> account (type 2) -> fact
    (resolve keys, replace the staged days), published as one snapshot.

    Written are only new folders: the dates that are new, the buckets with
    merchants or accounts that change, the versions that are closed, and the
    staged days. Nothing that is stored is written again. What can be wrong
    after that lies in these folders, so the constraints are checked there
    (and keys against the dimensions); a batch that breaks one, or a job that
    ends before the manifest is written, leaves the snapshot before it as it
    was. A ``batch_ts`` earlier than a stored version is refused; the same one
    again is allowed if it changes no version that started with it (a replay).

    With ``append`` the staged rows are added to their days instead: rows
    that are stored already are left out (``already_stored``), the others
    become one more folder of the day. The surrogate key of a fact is the
    digest of its row and the row names its hour, so only the keys stored for
    the batch's hours are read: what the day holds beside them costs nothing.
    """
    r, run = root.rstrip("/"), snapshots.new_run()
    before = snapshots.latest(spark, r)
    if before and before.newest_version and _later(before.newest_version, batch_ts):
        raise ValueError(f"batch {batch_ts} is earlier than the newest stored version, {before.newest_version}")
    n_buckets = before.buckets if before else buckets or min(4096, max(4, 1 << (staged.dim_account.count() // BUCKET_ACCOUNTS).bit_length()))
    parts = {name: dict(before.parts.get(name, {})) if before else {} for name in
             ("dim_date", "dim_transaction_type", "dim_merchant", "dim_account", HISTORY, CHANGES, "fact_transactions")}
    folder = {name: f"{name}/load={run}" for name in parts}

    def stored(name: str, schema, only=None) -> DataFrame:
        return snapshots.table(spark, r, before, name, schema, only)

    def added(name: str, df: DataFrame, schema) -> DataFrame:
        """Write ``df`` as a new part; an empty one is not named."""
        snapshots.write(df, f"{r}/{folder[name]}")
        return _read(spark, f"{r}/{folder[name]}", schema)

    def part(name: str, schema) -> DataFrame:
        return snapshots.read_parts(spark, r, sorted(set(parts[name].values())), schema)

    already = 0
    if append:
        scratch = f"{r}/fact_fresh/load={run}"
        snapshots.write(fresh_facts(spark, r, before, staged.fact), scratch)
        fresh = _read(spark, scratch, FACT_STAGING)
        already = staged.fact.count() - fresh.count()
        staged = Staged(staged.dim_account, staged.dim_merchant, staged.dim_date, fresh, staged.hot)

    def load_types() -> None:
        if not parts["dim_transaction_type"]:
            added("dim_transaction_type", dim_transaction_type(spark).coalesce(1), DIM_TRANSACTION_TYPE)
            parts["dim_transaction_type"][run] = folder["dim_transaction_type"]

    def load_dates() -> int:
        new = W.insert_if_new(stored("dim_date", DIM_DATE), staged.dim_date, "date_key").inserted
        inserted = added("dim_date", new.coalesce(1), DIM_DATE).count()
        if inserted:
            parts["dim_date"][run] = folder["dim_date"]
        return inserted

    def load_merchants() -> dict[str, str]:
        scratch = f"{r}/dim_merchant_changes/load={run}"
        snapshots.write(W.type1_delta(W.shuffled_if_large(stored("dim_merchant", DIM_MERCHANT)), staged.dim_merchant), scratch)
        changed = W.shuffled_if_large(_read(spark, scratch, DIM_MERCHANT))
        return snapshots.upsert_buckets(spark, r, before, "dim_merchant", DIM_MERCHANT, "merchant_id", changed, run, n_buckets)

    def load_accounts() -> tuple[dict, dict[str, str], DataFrame]:
        delta = added(CHANGES, W.scd2_delta(W.shuffled_if_large(stored("dim_account", DIM_ACCOUNT)), staged.dim_account, batch_ts), ACCOUNT_CHANGES)
        changes, closed = W.change_report(delta).first().asDict(), spark.createDataFrame([], DIM_ACCOUNT)
        if not any(changes.values()):
            return changes, {}, closed
        parts[CHANGES][run] = folder[CHANGES]
        if changes["closed_and_reopened"]:
            closed = added(HISTORY, delta.where("closed is not null").select("closed.*"), DIM_ACCOUNT)
            parts[HISTORY][run] = folder[HISTORY]
        return changes, snapshots.upsert_buckets(spark, r, before, "dim_account", DIM_ACCOUNT, "account_id", W.shuffled_if_large(delta.select("opened.*")), run, n_buckets), closed

    _, date_inserted, merchants, (changes, accounts, closed) = _together(load_types, load_dates, load_merchants, load_accounts)
    sinks.remove(spark, f"{r}/dim_merchant_changes/load={run}")
    parts["dim_merchant"] |= merchants
    parts["dim_account"] |= accounts
    types = part("dim_transaction_type", DIM_TRANSACTION_TYPE)
    current, all_merchants = (W.shuffled_if_large(part(n, s)) for n, s in (("dim_account", DIM_ACCOUNT), ("dim_merchant", DIM_MERCHANT)))

    def load_facts() -> DataFrame:
        hot = W.hot_ids(staged.fact) if staged.hot is None else staged.hot
        hot = spark.createDataFrame(hot.collect(), W.HOT_SCHEMA)  # at most 3 x HOT_IDS
        facts = W.resolve_fact(staged.fact, current, all_merchants, types, batch_ts, hot, W.few_ids(staged.fact))
        snapshots.write_parts(facts, f"{r}/{folder['fact_transactions']}", "partition_date", "orig_account_key", ["dest_account_key"])
        return _read(spark, f"{r}/{folder['fact_transactions']}", FACT_TRANSACTIONS)

    incoming, audit, days = _together(
        load_facts, lambda: W.unresolved_counts(staged.fact, current, types).first().asDict(),
        lambda: [str(d[0]) for d in staged.fact.select("partition_date").distinct().collect()])  # at most 31

    dim_date = part("dim_date", DIM_DATE)
    # a key has one bucket, so keys that clash do so inside the buckets written
    written = {"dim_date": dim_date, "dim_transaction_type": types, "fact_transactions": incoming,
               "dim_account": snapshots.read_parts(spark, r, accounts.values(), DIM_ACCOUNT).unionByName(closed),
               "dim_merchant": snapshots.read_parts(spark, r, merchants.values(), DIM_MERCHANT)}
    checks = (Q.domain_checks(dim_date, incoming), Q.uniqueness_checks(written), Q.not_null_checks(written),
              Q.foreign_key_checks({**written, "dim_account": current, "dim_merchant": all_merchants}))
    _, by_day = _together(lambda: Q.assert_ok(reduce(DataFrame.unionByName, checks)),
                          lambda: {str(d[0]): d[1] for d in incoming.groupBy("partition_date").count().collect()})  # at most 31
    audit["inserted"] = sum(by_day.values())
    audit["fan_out"] = audit["inserted"] + audit["unresolved_type"] + audit["unresolved_account"] - audit["staged"]
    if audit["fan_out"]:
        raise ValueError(f"facts multiply in the key lookup: {audit}")

    counted = dict(before.rows.get("fact_transactions", {})) if before else {}
    audit["deleted"] = 0
    if append:
        sinks.remove(spark, scratch)
        audit["already_stored"] = already
        by_day = {f"{d} {run}": n for d, n in by_day.items()}
    else:  # a staged day replaces the stored one, also when none of its rows could be resolved
        for name in [p for p in parts["fact_transactions"] if p.split(" ")[0] in days]:
            del parts["fact_transactions"][name]
            audit["deleted"] += counted.pop(name, 0)
    parts["fact_transactions"] |= {d: f"{folder['fact_transactions']}/partition_date={d.split(' ')[0]}" for d in by_day}
    snapshots.publish(spark, r, snapshots.Snapshot(
        batch_ts=batch_ts, newest_version=batch_ts if any(changes.values()) else before and before.newest_version,
        buckets=n_buckets, parts=parts, rows={"fact_transactions": counted | by_day}), before)
    named = {p for table in parts.values() for p in table.values()}
    for path in folder.values():  # written without a row
        if not any(p == path or p.startswith(f"{path}/") for p in named):
            sinks.remove(spark, f"{r}/{path}")
    snapshots.expire(spark, r, keep)
    return {"dates_inserted": date_inserted, "accounts": changes, "fact": audit}


def fresh_facts(spark: SparkSession, root: str, stored: snapshots.Snapshot | None, staging: DataFrame) -> DataFrame:
    """The staged rows that the snapshot does not hold."""
    if stored is None or not stored.parts.get("fact_transactions"):
        return staging
    hours = staging.select("partition_date", "source_step").distinct().collect()  # at most 744
    days, steps = sorted({h[0] for h in hours}), sorted({h[1] for h in hours})
    names = [p for p in stored.parts["fact_transactions"] if p.split(" ")[0] in {str(d) for d in days}]
    if not names:
        return staging
    held = snapshots.table(spark, root, stored, "fact_transactions", FACT_TRANSACTIONS, names)
    # rows of one drop share their hours, so files of other hours are skipped by their statistics
    keys = held.where(F.col("source_step").isin(steps)).select("transaction_key")
    return staging.withColumn("transaction_key", W.transaction_key()).join(keys, "transaction_key", "left_anti").select([f.name for f in FACT_STAGING.fields])


def _together(*tasks: Callable):
    """Results of tasks that do not need each other, run as Spark jobs at the
    same time; if one fails, its error is raised when all have ended."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def account_changes(spark: SparkSession, root: str, number: int) -> DataFrame:
    """account_id and action of the load that published the snapshot."""
    now, earlier = snapshots.read(spark, root, number), snapshots.read(spark, root, number - 1)
    if now is None:
        raise FileNotFoundError(f"no snapshot {number} at {root}")
    new = set(now.parts.get(CHANGES, {})) - set(earlier.parts.get(CHANGES, {}) if earlier else {})
    return snapshots.table(spark, root, now, CHANGES, ACCOUNT_CHANGES, new).select("account_id", "action")


def _later(a: str, b: str) -> bool:
    """Whether timestamp ``a`` lies after ``b``."""
    return datetime.datetime.fromisoformat(a) > datetime.datetime.fromisoformat(b)


def write_dashboard_mart(wh: Warehouse, path: str) -> None:
    """The pre-aggregated dashboard feed (day x region x type), one folder per
    day; a rerun replaces only the days present in the warehouse."""
    from .extras import x8_dashboard_mart
    (x8_dashboard_mart(wh).hint("rebalance", "calendar_date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("calendar_date").parquet(path))
