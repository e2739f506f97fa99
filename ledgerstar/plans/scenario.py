"""Five-batch load scenario over the events-derived transactions.

1. days 1-15, 2024-02-01: everything is new
2. all days with attribute overrides, 2024-03-01: changed accounts are closed
   and reopened, unseen accounts are new, merchants are overwritten
3. batch 2 again, 2024-04-01: nothing changes (idempotent)
4. day 10 only, amounts doubled, same overrides, 2024-05-01: only day 10 of
   the fact is replaced; accounts absent from the batch stay current
5. day 1 with unknown originators and an unknown type, 2024-06-01: counted
   by cause in the audit, day 1 replaced by the resolved rows

Overrides (fixed rule on hex digits 9-10 of the masked id, h): h % 5 = 0 ->
region Prairies; h % 7 = 0 -> status DORMANT; h % 11 = 0 -> region NULL
(applied last, so it wins). Merchants get the two region rules.
Unknown originators: h % 13 = 0; unknown type: h % 17 = 0.

The batches go through the load job into a warehouse in the shared folder;
the state after a batch is the snapshot that its load published.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.masking import mask_id
from ..functions.numeric import round_double
from ..operators import warehouse as W
from ..operators.dimensions import fact_staging
from ..oracle import ACCOUNT_SQL, TEST_SALT
from ..session import checkpoint_dir
from ..sources.raw import raw_transactions
from . import analytics, jobs, mart
from .lookups import account_transactions
from .star import Staged, Warehouse, enriched, stage

BATCH_TS = ["2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00",
            "2024-05-01 00:00:00", "2024-06-01 00:00:00"]
OVERRIDE_REGION = "Prairies"
OVERRIDE_STATUS = "DORMANT"


def _h(col: str) -> Column:
    return F.conv(F.substring(F.col(col), 9, 2), 16, 10).cast("int")


def with_account_overrides(dim_account: DataFrame) -> DataFrame:
    h = _h("account_id")
    region = (F.when(h % 11 == 0, F.lit(None).cast("string"))
               .when(h % 5 == 0, F.lit(OVERRIDE_REGION)).otherwise(F.col("region")))
    status = F.when(h % 7 == 0, F.lit(OVERRIDE_STATUS)).otherwise(F.col("account_status"))
    return dim_account.select("account_id", region.alias("region"), status.alias("account_status"))


def with_merchant_overrides(dim_merchant: DataFrame) -> DataFrame:
    h = _h("merchant_id")
    region = (F.when(h % 11 == 0, F.lit(None).cast("string"))
               .when(h % 5 == 0, F.lit(OVERRIDE_REGION)).otherwise(F.col("region")))
    return dim_merchant.select("merchant_id", "merchant_category", region.alias("region"))


def _day(n: int) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), n - 1)


def batches(txn: DataFrame) -> list[Staged]:
    def staged(t: DataFrame, overrides: bool) -> Staged:
        out = stage(fact_staging(t))
        if overrides:
            out.dim_account = with_account_overrides(out.dim_account)
            out.dim_merchant = with_merchant_overrides(out.dim_merchant)
        return out

    b1 = staged(txn.filter(F.col("calendar_date") <= _day(15)), False)
    b2 = staged(txn, True)
    b4 = staged(txn.filter(F.col("calendar_date") == _day(10)), True)
    b4.fact = b4.fact.withColumn("amount", F.col("amount") * 2)
    b5 = staged(txn.filter(F.col("calendar_date") == _day(1)), True)
    h = _h("orig_account_id")
    b5.fact = b5.fact.select(
        *[F.when(h % 13 == 0, F.concat(F.lit("unknown-"), F.col(c))).otherwise(F.col(c)).alias(c)
          if c == "orig_account_id" else
          F.when(h % 17 == 0, F.lit("BOGUS")).otherwise(F.col(c)).alias(c)
          if c == "type_code" else F.col(c) for c in b5.fact.columns])
    return [b1, b2, b2, b4, b5]


@dataclass
class ScenarioRun:
    root: str
    reports: list[dict]

    def state(self, spark: SparkSession, batch: int) -> Warehouse:
        return jobs.read_warehouse(spark, self.root, batch)


_RUNS: dict[tuple[str, str, str], ScenarioRun] = {}


def _loaded(spark: SparkSession, sf_dir: str, name: str, staged: Callable[[], list[Staged]], times: list[str]) -> ScenarioRun:
    """Load the batches once per Spark application and input folder; the keys below share the warehouse."""
    key = (name, spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _RUNS:
        root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        reports, before, files = [], None, None
        for n, (batch, ts) in enumerate(zip(staged(), times, strict=True)):
            if batch is not before:  # one that is loaded again is read from the same files
                before, files = batch, written_staging(batch, f"{root}-staging/{n}")
            reports.append(jobs.run_load(spark, files, root, ts))
        _RUNS[key] = ScenarioRun(root, reports)
    return _RUNS[key]


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched rows, written once for all batches."""
    txn = enriched(raw_transactions(spark, sf_dir), TEST_SALT)
    path = f"{checkpoint_dir(spark).rstrip('/')}/transactions-{uuid.uuid4().hex}"
    txn.write.parquet(path)
    return spark.read.schema(txn.schema).parquet(path)


def written_staging(staged: Staged, path: str) -> Staged:
    """The batch as a transform would leave it: every table written once."""
    spark, out = staged.fact.sparkSession, {}
    for name in ("dim_account", "dim_merchant", "dim_date", "fact"):
        df = getattr(staged, name)
        df.write.parquet(f"{path}/{name}")
        out[name] = spark.read.schema(df.schema).parquet(f"{path}/{name}")
    return Staged(**out)


def run_scenario(spark: SparkSession, sf_dir: str) -> ScenarioRun:
    return _loaded(spark, sf_dir, "scenario", lambda: batches(_transactions(spark, sf_dir)), BATCH_TS)


def run_versions(spark: SparkSession, sf_dir: str) -> ScenarioRun:
    """Days 1-15 as they are, then days 16-31 with the overrides: an account
    that changed has facts on both of its versions."""
    def staged() -> list[Staged]:
        txn = _transactions(spark, sf_dir)
        late = stage(fact_staging(txn.filter(F.col("calendar_date") > _day(15))))
        late.dim_account, late.dim_merchant = with_account_overrides(late.dim_account), with_merchant_overrides(late.dim_merchant)
        return [stage(fact_staging(txn.filter(F.col("calendar_date") <= _day(15)))), late]
    return _loaded(spark, sf_dir, "versions", staged, BATCH_TS[:2])


def _per_batch(spark: SparkSession, rows: list[dict], columns: list[str]) -> DataFrame:
    ddl = ", ".join(f"{c} long" for c in ["batch", *columns])
    return spark.createDataFrame([(n, *(r[c] for c in columns)) for n, r in enumerate(rows, start=1)], ddl)


# -- driver keys -------------------------------------------------------------
def load_insert_if_new(spark, sf_dir):
    reports = run_scenario(spark, sf_dir).reports
    return _per_batch(spark, [{"inserted": r["dates_inserted"]} for r in reports], ["inserted"])


def load_type1_upsert(spark, sf_dir):
    return run_scenario(spark, sf_dir).state(spark, 3).dim_merchant.select(
        "merchant_id", "merchant_category", "region")


_HIST = ["account_id", "region", "account_status", "effective_start", "effective_end", "is_current"]


def scd2_history(spark, sf_dir):
    return run_scenario(spark, sf_dir).state(spark, 4).dim_account.select(*_HIST)


def scd2_current(spark, sf_dir):
    st = run_scenario(spark, sf_dir).state(spark, 5).dim_account
    return W.current_versions(st).select("account_id", "region", "account_status", "effective_start")


def scd2_changes(spark, sf_dir):
    return _per_batch(spark, [r["accounts"] for r in run_scenario(spark, sf_dir).reports], ["closed_and_reopened", "inserted_new"])


def natural_fact(wh: Warehouse) -> DataFrame:
    """Resolved facts with natural keys looked up again (for comparison)."""
    acct = wh.dim_account.select("account_key", "account_id")
    f = wh.fact_transactions
    o = acct.select(F.col("account_key").alias("orig_account_key"),
                    F.col("account_id").alias("orig_account_id"))
    d = acct.select(F.col("account_key").alias("dest_account_key"),
                    F.col("account_id").alias("dest_account_id"))
    m = wh.dim_merchant.select(F.col("merchant_key").alias("dest_merchant_key"),
                               F.col("merchant_id").alias("dest_merchant_id"))
    t = F.broadcast(wh.dim_transaction_type.select("transaction_type_key", "type_code"))
    return (f.join(o, "orig_account_key").join(d, "dest_account_key", "left")
            .join(m, "dest_merchant_key", "left").join(t, "transaction_type_key")
            .select("orig_account_id", "dest_account_id", "dest_merchant_id", "date_key",
                    "partition_date", "type_code",
                    *[F.col(c).cast("double").alias(c) for c in
                      ["amount", "balance_before_orig", "balance_after_orig",
                       "balance_before_dest", "balance_after_dest"]],
                    "is_fraud", "is_flagged_by_system", "source_step"))


def fact_resolved(spark, sf_dir):
    """All days, after the load that changed account and merchant attributes."""
    return natural_fact(run_scenario(spark, sf_dir).state(spark, 2))


def fact_replace_partitions(spark, sf_dir):
    f = run_scenario(spark, sf_dir).state(spark, 5).fact_transactions
    return f.groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("amount").cast("double").alias("total_amount"),
        F.countDistinct("loaded_at").cast("long").alias("loads"),
        F.max("loaded_at").alias("loaded_at"))


def load_audit_q(spark, sf_dir):
    return _per_batch(spark, [r["fact"] for r in run_scenario(spark, sf_dir).reports],
                      ["staged", "inserted", "deleted", "unresolved_type", "unresolved_account"])


def _on_versions(name: str):
    """An account query over a warehouse whose accounts have facts on several versions."""
    def run(spark, sf_dir):
        return analytics.QUERIES[name](run_versions(spark, sf_dir).state(spark, 2))
    run.__name__ = f"{name}_versions"
    return run


def _with_mart(spark, sf_dir):
    """The warehouse with all days, and its mart, written beside it."""
    run = run_scenario(spark, sf_dir)
    wh, path = run.state(spark, 2), f"{run.root}-mart-{uuid.uuid4().hex}"
    mart.write_mart(wh, path)
    return wh, mart.read_mart(spark, path)


RANGE = datetime.date(2024, 1, 8), datetime.date(2024, 1, 21)


def q2_3_range(spark, sf_dir):
    """Percentiles per type over two weeks, from the mart's histograms."""
    wh, m = _with_mart(spark, sf_dir)
    names = ["median", "p90", "p99", "max_amount"]
    p = mart.range_percentiles(wh, m, *RANGE, [0.5, 0.9, 0.99, 1.0], names)
    return p.select("type_code", *[round_double(F.col(n), 2).alias(n) for n in names])


def x8_filtered_feed(spark, sf_dir):
    """The feed by type over two weeks: exact distinct numbers, and whether the
    sketches' estimates lie within their stated error."""
    wh, m = _with_mart(spark, sf_dir)
    days = F.col("partition_date").between(*map(F.lit, RANGE))
    feed = mart.filtered_feed(m, days, ["type_code"]).withColumnsRenamed({"accounts": "est_accounts", "merchants": "est_merchants"})
    return feed.join(mart.exact_distinct(wh, days, ["type_code"]), "type_code").select(
        "type_code", "txns", "total_value", "fraud_txns", "accounts", "merchants",
        mart.within_error(F.col("est_accounts"), F.col("accounts")).alias("accounts_within"),
        mart.within_error(F.col("est_merchants"), F.col("merchants")).alias("merchants_within"))


def account_lookup(spark, sf_dir):
    """Every day's transactions of one account, sent and received."""
    wh = run_scenario(spark, sf_dir).state(spark, 2)
    focus = spark.range(1).select(mask_id(F.lit("C7"), TEST_SALT)).first()[0]
    rows = account_transactions(wh, focus).join(F.broadcast(wh.dim_transaction_type.select("transaction_type_key", "type_code")), "transaction_type_key")
    return (rows.groupBy("direction", F.col("partition_date").alias("calendar_date"), "type_code")
            .agg(F.count(F.lit(1)).alias("txns"), round_double(F.sum("amount"), 2).alias("total_value")))


SCENARIO_QUERIES = {
    **{f"{name}_versions": _on_versions(name) for name in ACCOUNT_SQL},
    "load_insert_if_new": load_insert_if_new,
    "load_type1_upsert": load_type1_upsert,
    "scd2_history": scd2_history,
    "scd2_current": scd2_current,
    "scd2_changes": scd2_changes,
    "fact_resolved": fact_resolved,
    "fact_replace_partitions": fact_replace_partitions,
    "load_audit": load_audit_q,
    "q2_3_range": q2_3_range,
    "x8_filtered_feed": x8_filtered_feed,
    "account_lookup": account_lookup,
}
