"""Distributed ranking keys (W-G1) and the operators the design documents
describe beyond the eighteen queries (X1-X9), over the same star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.masking import mask_id
from ..functions.numeric import avg_half_up, pct, round_double
from ..operators.ranking import global_ntiles, global_ranks
from ..oracle import TEST_SALT
from .star import Warehouse, star_from_testdata

# Fixed parameters of the extra reports.
ROLLING_HOURS = 24          # X1 trailing window, in steps (hours)
SPIKE_BASELINE_HOURS = 24   # X2 trailing baseline, in hours
SPIKE_Z = 3.0               # X2 spike threshold (standard deviations)
OFF_HOURS = (0, 5)          # X2 off-hours: 00:00-05:59
OFF_HOURS_MIN_TXNS = 5
OFF_HOURS_SHARE = 0.5
RULE_THRESHOLD = 200.0      # X7 TRANSFER amount threshold (scaled to the data)
FOCUS_RAW_ID = "C7"         # X5 account (raw id before masking)
FOCUS_DAYS = 7              # X5 trailing days


def _accounts_by_value(wh: Warehouse) -> DataFrame:
    per_key = wh.fact_transactions.groupBy("orig_account_key").agg(
        F.sum("amount").alias("_value"), F.count(F.lit(1)).alias("txns"))
    acct = wh.dim_account.select(F.col("account_key").alias("orig_account_key"), "account_id")
    return per_key.join(acct, "orig_account_key").groupBy("account_id").agg(
        F.sum("_value").alias("_value"), F.sum("txns").cast("long").alias("txns"))


def global_ntile_q(wh: Warehouse) -> DataFrame:
    """NTILE(10) of every account by total value, distributed (W-G1)."""
    base = _accounts_by_value(wh)
    d = global_ntiles(base, {"value_decile": -F.col("_value")}, ["account_id"], 10)
    return d.select("account_id", round_double(F.col("_value"), 2).alias("total_value"),
                    F.col("value_decile").cast("long").alias("value_decile"))


def global_rank_q(wh: Warehouse) -> DataFrame:
    """RANK() of every account by transaction count (ties share a rank)."""
    base = _accounts_by_value(wh).select("account_id", "txns")
    return global_ranks(base, {"txn_rank": -F.col("txns")}, ["account_id"])


def rank_with_nulls(wh: Warehouse) -> DataFrame:
    """RANK() of every account by fraud value, largest first; accounts without
    fraud have none (NULL) and come last, together (T4)."""
    per_key = wh.fact_transactions.groupBy("orig_account_key").agg(F.sum(F.when(F.col("is_fraud"), F.col("amount"))).alias("_value"))
    acct = wh.dim_account.select(F.col("account_key").alias("orig_account_key"), "account_id")
    base = per_key.join(acct, "orig_account_key").groupBy("account_id").agg(F.sum("_value").alias("_value"))
    # NULLs would come first in the ascending order of the negative values
    last = -F.coalesce(F.col("_value"), F.lit(-1))
    return global_ranks(base, {"fraud_rank": last}, ["account_id"]).select("account_id", round_double(F.col("_value"), 2).alias("fraud_value"), "fraud_rank")


def x1_rolling_counts(wh: Warehouse) -> DataFrame:
    """Per originator and hour: transactions in that hour and in the trailing
    24 hours. Facts are first reduced to one row per (account, step), so a
    window partition holds at most 744 rows whatever the account's volume."""
    acct = wh.dim_account.select(F.col("account_key").alias("orig_account_key"), "account_id")
    hourly = (wh.fact_transactions.groupBy("orig_account_key", "source_step")
              .agg(F.count(F.lit(1)).alias("txns_in_hour"))
              .join(acct, "orig_account_key")
              .groupBy("account_id", F.col("source_step").alias("step"))
              .agg(F.sum("txns_in_hour").cast("long").alias("txns_in_hour")))
    w = Window.partitionBy("account_id").orderBy("step").rangeBetween(-(ROLLING_HOURS - 1), 0)
    return hourly.select("account_id", "step", "txns_in_hour",
                         F.sum("txns_in_hour").over(w).cast("long").alias("txns_last_24h"))


def x2_hourly_spikes(wh: Warehouse) -> DataFrame:
    """Hourly volume against the mean and standard deviation of the previous
    24 observed hours (at most 744 rows: one ordered pass is fine)."""
    hourly = (wh.fact_transactions.groupBy("date_key").agg(F.count(F.lit(1)).alias("txns"))
              .join(F.broadcast(wh.dim_date.select("date_key", "step")), "date_key"))
    w = Window.orderBy("step").rowsBetween(-SPIKE_BASELINE_HOURS, -1)
    s = hourly.select("date_key", "step", "txns",
                      F.avg("txns").over(w).alias("_mean"), F.stddev_samp("txns").over(w).alias("_sd"))
    z = (F.col("txns") - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))
    return s.select("date_key", "step", "txns",
                    F.round(F.col("_mean"), 3).alias("baseline_mean"),
                    F.round(z, 3).alias("z_score"),
                    F.coalesce(z > SPIKE_Z, F.lit(False)).alias("is_spike"))


def x2_off_hours_accounts(wh: Warehouse) -> DataFrame:
    """Share of each active originator's transactions between 00:00 and
    05:59; flagged when that is most of its business."""
    off = F.col("hour_of_day").between(*OFF_HOURS)
    per_key = (wh.fact_transactions.select("orig_account_key", "date_key")
               .join(F.broadcast(wh.dim_date.select("date_key", "hour_of_day")), "date_key")
               .groupBy("orig_account_key")
               .agg(F.count_if(off).alias("off_hours"), F.count(F.lit(1)).alias("total")))
    acct = wh.dim_account.select(F.col("account_key").alias("orig_account_key"), "account_id")
    g = per_key.join(acct, "orig_account_key").groupBy("account_id").agg(
        F.sum("off_hours").cast("long").alias("off_hours_txns"), F.sum("total").cast("long").alias("txns"))
    return g.filter(F.col("txns") >= OFF_HOURS_MIN_TXNS).select(
        "account_id", "off_hours_txns", "txns",
        pct(F.col("off_hours_txns"), F.col("txns"), 1).alias("off_hours_pct"),
        (F.col("off_hours_txns") > F.col("txns") * OFF_HOURS_SHARE).alias("is_flagged"))


def x3_cohorts(wh: Warehouse) -> DataFrame:
    """Cohort = ISO week of an account's first transaction; activity by weeks
    since then. First-seen is a combinable min per account key."""
    f = (wh.fact_transactions.select("orig_account_key", "date_key")
         .join(F.broadcast(wh.dim_date.select("date_key", "calendar_date")), "date_key"))
    acct = wh.dim_account.select(F.col("account_key").alias("orig_account_key"), "account_id")
    per_day = (f.groupBy("orig_account_key", "calendar_date").agg(F.count(F.lit(1)).alias("n"))
               .join(acct, "orig_account_key")
               .groupBy("account_id", "calendar_date").agg(F.sum("n").alias("n")))
    first = per_day.groupBy("account_id").agg(F.min("calendar_date").alias("first_day"))
    week = lambda c: F.date_trunc("week", c).cast("date")
    j = per_day.join(first, "account_id").select(
        "account_id", "n", week(F.col("first_day")).alias("cohort_week"),
        (F.datediff(week(F.col("calendar_date")), week(F.col("first_day"))) / 7).cast("long")
        .alias("weeks_since_first"))
    return j.groupBy("cohort_week", "weeks_since_first").agg(
        F.countDistinct("account_id").cast("long").alias("active_accounts"),
        F.sum("n").cast("long").alias("txns"))


def x4_counterparties(wh: Warehouse) -> DataFrame:
    """All counterparties, customer or merchant, in one list."""
    f = wh.fact_transactions
    acc = (f.filter(F.col("dest_account_key").isNotNull()).groupBy("dest_account_key")
           .agg(F.count(F.lit(1)).alias("txns"), F.sum("amount").alias("_v"))
           .join(wh.dim_account.select(F.col("account_key").alias("dest_account_key"),
                                       F.col("account_id").alias("counterparty_id")), "dest_account_key")
           .groupBy("counterparty_id").agg(F.sum("txns").alias("txns"), F.sum("_v").alias("_v"))
           .withColumn("kind", F.lit("customer")))
    mer = (f.filter(F.col("dest_merchant_key").isNotNull()).groupBy("dest_merchant_key")
           .agg(F.count(F.lit(1)).alias("txns"), F.sum("amount").alias("_v"))
           .join(wh.dim_merchant.select(F.col("merchant_key").alias("dest_merchant_key"),
                                        F.col("merchant_id").alias("counterparty_id")), "dest_merchant_key")
           .select("counterparty_id", "txns", "_v").withColumn("kind", F.lit("merchant")))
    return acc.unionByName(mer).select("counterparty_id", "kind", F.col("txns").cast("long").alias("txns"),
                                       round_double(F.col("_v"), 2).alias("total_value"))


def x5_account_recent(wh: Warehouse, account_id: DataFrame,
                      days: int = FOCUS_DAYS) -> DataFrame:
    """One account's daily activity over the last ``days`` days of data.

    The date range is a filter on ``partition_date``, so a day-partitioned
    fact table is pruned to those folders before any row is read.
    """
    last = wh.dim_date.agg(F.max("calendar_date").alias("_last"))
    keys = wh.dim_account.join(account_id, "account_id").select(
        F.col("account_key").alias("orig_account_key"), "account_id")
    recent = wh.fact_transactions.filter(
        F.col("partition_date") > F.date_sub(last.scalar(), days))
    return (recent.join(keys, "orig_account_key")
            .groupBy("account_id", F.col("partition_date").alias("calendar_date"))
            .agg(F.count(F.lit(1)).alias("txns"), F.sum("amount").alias("_v"))
            .select("account_id", "calendar_date", "txns", round_double(F.col("_v"), 2).alias("total_value")))


def x6_zero_balance_profile(wh: Warehouse) -> DataFrame:
    """Share of rows whose four balances are all zero, fraud vs legitimate."""
    zero = F.lit(True)
    for c in ["balance_before_orig", "balance_after_orig", "balance_before_dest", "balance_after_dest"]:
        zero = zero & (F.coalesce(F.col(c), F.lit(0)) == 0)
    g = wh.fact_transactions.groupBy("is_fraud").agg(
        F.count(F.lit(1)).alias("txns"), F.count_if(zero).cast("long").alias("all_balances_zero"))
    return g.select(F.when(F.col("is_fraud"), "Actual fraud").otherwise("Legitimate").alias("actual"),
                    "txns", "all_balances_zero",
                    pct(F.col("all_balances_zero"), F.col("txns"), 2).alias("pct_all_zero"))


def x7_rule_flag(wh: Warehouse, threshold: float = RULE_THRESHOLD) -> DataFrame:
    """Rule TRANSFER and amount > threshold against the system flag and fraud."""
    f = wh.fact_transactions.join(
        F.broadcast(wh.dim_transaction_type.select("transaction_type_key", "type_code")),
        "transaction_type_key")
    rule = (F.col("type_code") == "TRANSFER") & (F.col("amount") > F.lit(threshold))
    return f.groupBy(rule.alias("rule_flag"), "is_flagged_by_system", "is_fraud").agg(
        F.count(F.lit(1)).alias("txns"))


def x8_dashboard_mart(wh: Warehouse) -> DataFrame:
    """Pre-aggregated feed: day x originator region x type."""
    per = (wh.fact_transactions.groupBy("partition_date", "orig_account_key", "transaction_type_key")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("v"),
                F.count_if(F.col("is_fraud")).alias("fr")))
    acct = wh.dim_account.select(F.col("account_key").alias("orig_account_key"), "region")
    types = F.broadcast(wh.dim_transaction_type.select("transaction_type_key", "type_code"))
    g = (per.join(acct, "orig_account_key").join(types, "transaction_type_key")
         .groupBy(F.col("partition_date").alias("calendar_date"), "region", "type_code")
         .agg(F.sum("n").cast("long").alias("txns"), F.sum("v").alias("_v"),
              F.sum("fr").cast("long").alias("fraud_txns")))
    return g.select("calendar_date", "region", "type_code", "txns",
                    round_double(F.col("_v"), 2).alias("total_value"),
                    avg_half_up(F.col("_v"), F.col("txns"), 2).alias("avg_value"), "fraud_txns")


def week_start(date_col) -> F.Column:
    return F.date_trunc("week", date_col).cast("date")


def x9_weekly_layout(wh: Warehouse) -> DataFrame:
    """Fact rows per weekly partition (Monday start) as a weekly layout would store them."""
    f = wh.fact_transactions.withColumn("partition_week", week_start(F.col("partition_date")))
    return f.groupBy("partition_week").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("partition_date").cast("long").alias("days"),
        round_double(F.sum("amount"), 2).alias("total_value"))


def rfm_scores_all(wh: Warehouse) -> DataFrame:
    from .analytics import q3_1_rfm_full
    return q3_1_rfm_full(wh)


EXTRA_FUNCS = {
    "global_ntile": global_ntile_q,
    "rfm_scores_all": rfm_scores_all,
    "global_rank": global_rank_q,
    "rank_with_nulls": rank_with_nulls,
    "x1_rolling_counts": x1_rolling_counts,
    "x2_hourly_spikes": x2_hourly_spikes,
    "x2_off_hours_accounts": x2_off_hours_accounts,
    "x3_cohorts": x3_cohorts,
    "x4_counterparties": x4_counterparties,
    "x6_zero_balance_profile": x6_zero_balance_profile,
    "x7_rule_flag": x7_rule_flag,
    "x8_dashboard_mart": x8_dashboard_mart,
    "x9_weekly_layout": x9_weekly_layout,
}


def _driver(fn):
    def run(spark, sf_dir):
        return fn(star_from_testdata(spark, sf_dir, TEST_SALT))
    run.__name__ = fn.__name__
    return run


EXTRA_QUERIES = {k: _driver(v) for k, v in EXTRA_FUNCS.items()}


def x5_focus_account(spark, sf_dir):
    """The test account of the driver key, masked with the test salt."""
    focus = spark.range(1).select(mask_id(F.lit(FOCUS_RAW_ID), TEST_SALT).alias("account_id"))
    return x5_account_recent(star_from_testdata(spark, sf_dir, TEST_SALT), focus)


EXTRA_QUERIES["x5_account_recent"] = x5_focus_account

def x10_incremental_type_mix(spark, sf_dir):
    """The type/channel mix (Q1.3) over a warehouse filled by the streaming
    incremental job instead of the batch jobs: the results must agree."""
    from ..streaming.incremental import run_events_incremental
    from .analytics import q1_3_type_mix
    from .jobs import read_warehouse
    root = run_events_incremental(spark, sf_dir, TEST_SALT)
    return q1_3_type_mix(read_warehouse(spark, f"{root}/warehouse"))


def x10_same_day_drops(spark, sf_dir):
    """Rows and value per day after eight drops that all hold every day: as if
    all rows had come at once."""
    from ..streaming.incremental import run_events_in_drops
    from .jobs import read_warehouse
    wh = read_warehouse(spark, f"{run_events_in_drops(spark, sf_dir, TEST_SALT)}/warehouse")
    return (wh.fact_transactions.groupBy(F.col("partition_date").alias("calendar_date"))
            .agg(F.count(F.lit(1)).alias("txn_count"), round_double(F.sum("amount"), 2).alias("total_value")))


EXTRA_QUERIES["x10_same_day_drops"] = x10_same_day_drops


EXTRA_QUERIES["x10_incremental_type_mix"] = x10_incremental_type_mix
