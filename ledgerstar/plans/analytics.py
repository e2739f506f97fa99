"""The eighteen analytical queries over the star schema.

Conventions (also used by the oracle): counts are BIGINT, rounded values are
DOUBLE, rounding is half-up on exact decimals, ties in every ranking or limit
are broken by a unique column so results are determined.

Scale notes. ``dim_date`` (at most 744 rows) and ``dim_transaction_type`` (5
rows) have fixed bounds and are broadcast. ``dim_account`` and
``dim_merchant`` grow with the data and are never broadcast by hint; facts
are aggregated per account/merchant key *before* joining them (partial
aggregation combines hot keys map-side), so the join sees one row per key.
Windows without PARTITION BY run only over results already reduced to at
most one row per hour, day or type. Global rankings over accounts use the
distributed operators of ``operators.ranking``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import avg_half_up, pct, round_double, safe_div
from ..operators.ranking import global_ntiles
from .star import Warehouse




def _count() -> Column:
    return F.count(F.lit(1))


def _dates(wh: Warehouse, *cols: str) -> DataFrame:
    return F.broadcast(wh.dim_date.select("date_key", *cols))


def _types(wh: Warehouse, *cols: str) -> DataFrame:
    return F.broadcast(wh.dim_transaction_type.select("transaction_type_key", *cols))


def _total() -> Window:
    return Window.partitionBy()


# ---------------------------------------------------------------------------
# 01 volume and trends
# ---------------------------------------------------------------------------
def _daily(wh: Warehouse) -> DataFrame:
    return (wh.fact_transactions.select("date_key", "amount")
            .join(_dates(wh, "calendar_date"), "date_key")
            .groupBy("calendar_date")
            .agg(_count().alias("txn_count"), F.sum("amount").alias("_value")))


def q1_1_daily_change(wh: Warehouse) -> DataFrame:
    w = Window.orderBy("calendar_date")
    prev = F.lag("txn_count").over(w)
    return _daily(wh).select(
        "calendar_date", "txn_count",
        round_double(F.col("_value"), 2).alias("total_value"),
        (F.col("txn_count") - prev).alias("count_change"),
        pct(F.col("txn_count") - prev, prev, 1).alias("count_pct_change"),
    ).orderBy("calendar_date")


def q1_2_moving_avg(wh: Warehouse) -> DataFrame:
    w = Window.orderBy("calendar_date").rowsBetween(-6, 0)
    return _daily(wh).select(
        "calendar_date", "txn_count",
        round_double(F.sum("txn_count").over(w).cast("decimal(38,0)")
                     / F.count(F.lit(1)).over(w), 1).alias("moving_avg_7d"),
    ).orderBy("calendar_date")


def q1_3_type_mix(wh: Warehouse) -> DataFrame:
    g = (wh.fact_transactions.select("transaction_type_key", "amount")
         .join(_types(wh, "type_code", "channel_category"), "transaction_type_key")
         .groupBy("type_code", "channel_category")
         .agg(_count().alias("txn_count"), F.sum("amount").alias("_value")))
    return g.select(
        "type_code", "channel_category", "txn_count",
        pct(F.col("txn_count"), F.sum("txn_count").over(_total()), 1).alias("pct_of_txns"),
        round_double(F.col("_value"), 2).alias("total_value"),
        pct(F.col("_value"), F.sum("_value").over(_total()), 1).alias("pct_of_value"),
        avg_half_up(F.col("_value"), F.col("txn_count"), 2).alias("avg_txn_value"),
    ).orderBy(F.desc("total_value"), "type_code")


def q1_4_hourly(wh: Warehouse) -> DataFrame:
    g = (wh.fact_transactions.select("date_key", "amount")
         .join(_dates(wh, "hour_of_day"), "date_key")
         .groupBy("hour_of_day")
         .agg(_count().alias("txn_count"), F.sum("amount").alias("_value")))
    return g.select(
        "hour_of_day", "txn_count",
        avg_half_up(F.col("_value"), F.col("txn_count"), 2).alias("avg_value"),
        F.rank().over(Window.orderBy(F.desc("txn_count"))).cast("long").alias("busiest_rank"),
    ).orderBy("hour_of_day")


def q1_5_weekend(wh: Warehouse) -> DataFrame:
    g = (wh.fact_transactions.select("date_key", "amount")
         .join(_dates(wh, "is_weekend", "calendar_date"), "date_key")
         .groupBy("is_weekend")
         .agg(_count().alias("txn_count"), F.countDistinct("calendar_date").alias("num_days"),
              F.sum("amount").alias("_value")))
    return g.select(
        F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"),
        "txn_count",
        F.col("num_days").cast("long").alias("num_days"),
        round_double(safe_div(F.col("txn_count").cast("decimal(20,0)"), F.col("num_days")), 0)
        .alias("avg_txns_per_day"),
        avg_half_up(F.col("_value"), F.col("txn_count"), 2).alias("avg_txn_value"),
    ).orderBy("day_type")


# ---------------------------------------------------------------------------
# 02 fraud and risk
# ---------------------------------------------------------------------------
def q2_1_fraud_by_type(wh: Warehouse) -> DataFrame:
    fraud = F.col("is_fraud")
    g = (wh.fact_transactions.select("transaction_type_key", "amount", "is_fraud")
         .join(_types(wh, "type_code"), "transaction_type_key")
         .groupBy("type_code")
         .agg(_count().alias("total_txns"),
              F.count_if(fraud).cast("long").alias("fraud_txns"),
              F.sum(F.when(fraud, F.col("amount"))).alias("_fraud_value")))
    return g.select(
        "type_code", "total_txns", "fraud_txns",
        pct(F.col("fraud_txns"), F.col("total_txns"), 4).alias("fraud_rate_pct"),
        round_double(F.coalesce(F.col("_fraud_value"), F.lit(0)), 2).alias("fraud_value"),
    ).orderBy(F.desc("fraud_txns"), "type_code")


def q2_2_fraud_by_hour(wh: Warehouse) -> DataFrame:
    g = (wh.fact_transactions.select("date_key", "is_fraud")
         .join(_dates(wh, "hour_of_day"), "date_key")
         .groupBy("hour_of_day")
         .agg(_count().alias("txns"), F.count_if(F.col("is_fraud")).cast("long").alias("fraud_txns")))
    return g.select(
        "hour_of_day", "txns", "fraud_txns",
        pct(F.col("fraud_txns"), F.col("txns"), 4).alias("hourly_fraud_rate"),
        pct(F.sum("fraud_txns").over(_total()), F.sum("txns").over(_total()), 4)
        .alias("overall_fraud_rate"),
    ).orderBy(F.desc("hourly_fraud_rate"), "hour_of_day")


def q2_3_percentiles(wh: Warehouse, exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """Continuous percentiles 0.5/0.9/0.99 and max per type.

    ``exact`` interpolates between exact order statistics found by a
    distributed count (see ``percentiles.exact_percentiles``); otherwise
    ``percentile_approx`` with the given accuracy is used (fixed memory per
    group, for very large groups).
    """
    from ..operators.percentiles import approx_percentiles, exact_percentiles
    f = (wh.fact_transactions.select("transaction_type_key", "amount")
         .join(_types(wh, "type_code"), "transaction_type_key")
         .select("type_code", "amount"))
    probs = [0.5, 0.9, 0.99, 1.0]  # the largest amount is one more order statistic, not one more scan
    names = ["median", "p90", "p99", "max_amount"]
    if exact:
        p = exact_percentiles(f, "type_code", "amount", probs, names)
    else:
        p = approx_percentiles(f, "type_code", "amount", probs, names, accuracy)
    return p.select(
        "type_code", *[round_double(F.col(n), 2).alias(n) for n in names],
    ).orderBy(F.desc("p99"), "type_code")


def q2_4_confusion(wh: Warehouse) -> DataFrame:
    flag = F.col("is_flagged_by_system")
    g = (wh.fact_transactions.groupBy("is_fraud")
         .agg(F.count_if(flag).cast("long").alias("flagged"),
              F.count_if(~flag).cast("long").alias("not_flagged"),
              _count().alias("total")))
    return g.select(
        F.when(F.col("is_fraud"), "Actual fraud").otherwise("Legitimate").alias("actual"),
        "flagged", "not_flagged", "total",
        pct(F.col("flagged"), F.col("total"), 2).alias("pct_flagged"),
    ).orderBy("actual")


def _per_orig_account(wh: Warehouse, *aggs: Column) -> DataFrame:
    """Facts reduced to one row per originating account version (partial agg)."""
    return wh.fact_transactions.groupBy("orig_account_key").agg(*aggs)


def _with_account(per_key: DataFrame, wh: Warehouse, *cols: str) -> DataFrame:
    acct = wh.dim_account.select(F.col("account_key").alias("orig_account_key"), *cols)
    return per_key.join(acct, "orig_account_key")


def q2_5_fraud_accounts(wh: Warehouse, k: int = 20) -> DataFrame:
    """Top-k originators by fraud value with their global RANK.

    The rank of a row in the top k depends only on rows above it, so the
    distributed top-k (TakeOrderedAndProject) runs first and the rank is
    computed over those k rows only.
    """
    fraud = F.col("is_fraud")
    per_key = _per_orig_account(
        wh, F.count_if(fraud).cast("long").alias("fraud_txns"),
        F.sum(F.when(fraud, F.col("amount"))).alias("_fraud_value"),
        _count().alias("total_txns"))
    g = (_with_account(per_key, wh, "account_id", "region")
         .groupBy("account_id", "region")
         .agg(F.sum("fraud_txns").alias("fraud_txns"), F.sum("_fraud_value").alias("_fraud_value"),
              F.sum("total_txns").alias("total_txns"))
         .filter(F.col("fraud_txns") > 0))  # versions without fraud count towards the account's total
    top = g.orderBy(F.col("_fraud_value").desc_nulls_last(), F.col("account_id"),
                    F.col("region").asc_nulls_first()).limit(k)
    return top.select(
        "account_id", "region", F.col("fraud_txns").cast("long").alias("fraud_txns"),
        round_double(F.col("_fraud_value"), 2).alias("fraud_value"),
        F.col("total_txns").cast("long").alias("total_txns"),
        F.rank().over(Window.orderBy(F.col("_fraud_value").desc_nulls_last()))
        .cast("long").alias("exposure_rank"),
    ).orderBy(F.col("fraud_value").desc_nulls_last(), "account_id")


# ---------------------------------------------------------------------------
# 03 customer segmentation
# ---------------------------------------------------------------------------
def _rfm_base(wh: Warehouse) -> DataFrame:
    as_of = wh.dim_date.agg(F.max("calendar_date").alias("_as_of"))  # one row
    per_key = (wh.fact_transactions.select("orig_account_key", "date_key", "amount")
               .join(_dates(wh, "calendar_date"), "date_key")
               .groupBy("orig_account_key")
               .agg(F.max("calendar_date").alias("_last"), _count().alias("frequency"),
                    F.sum("amount").alias("_value")))
    g = (_with_account(per_key, wh, "account_id", "region")
         .groupBy("account_id", "region")
         .agg(F.max("_last").alias("_last"), F.sum("frequency").alias("frequency"),
              F.sum("_value").alias("_value")))
    return g.select(
        "account_id", "region",
        F.datediff(as_of.scalar(), F.col("_last")).cast("long").alias("recency_days"),
        F.col("frequency").cast("long").alias("frequency"),
        F.round(F.col("_value"), 2).alias("_monetary"))


def q3_1_rfm(wh: Warehouse, k: int = 25) -> DataFrame:
    """RFM scores (distributed NTILE over all accounts), top k by monetary."""
    scored = q3_1_rfm_full(wh)
    return scored.orderBy(F.col("monetary").desc(), F.col("account_id").asc(),
                          F.col("region").asc_nulls_first()).limit(k) \
        .orderBy(F.desc("monetary"), "account_id")


def q3_1_rfm_full(wh: Warehouse) -> DataFrame:
    """RFM scores of every account (three distributed NTILEs in one pass)."""
    scores = {"r_score": -F.col("recency_days"), "f_score": F.col("frequency"), "m_score": F.col("_monetary")}
    scored = global_ntiles(_rfm_base(wh), scores, ["account_id", "region"], 5)
    return scored.select("account_id", "region", "recency_days", "frequency",
                         F.col("_monetary").cast("double").alias("monetary"),
                         *[F.col(c).cast("long").alias(c) for c in ["r_score", "f_score", "m_score"]])


def q3_2_deciles(wh: Warehouse) -> DataFrame:
    per_key = _per_orig_account(wh, F.sum("amount").alias("total_value"),
                                _count().alias("txn_count"))
    # account_id only serves as the unique tie-breaker of the order
    keyed = _with_account(per_key, wh, "account_id")
    deciled = global_ntiles(keyed, {"value_decile": -F.col("total_value")}, ["account_id", "orig_account_key"], 10)
    g = deciled.groupBy("value_decile").agg(
        _count().alias("accounts"), F.sum("total_value").alias("_value"),
        F.sum("txn_count").alias("_txns"))
    return g.select(
        F.col("value_decile").cast("long").alias("value_decile"), "accounts",
        round_double(F.col("_value"), 2).alias("decile_value"),
        pct(F.col("_value"), F.sum("_value").over(_total()), 1).alias("pct_of_total_value"),
        round_double(safe_div(F.col("_txns").cast("decimal(38,0)"), F.col("accounts")), 1)
        .alias("avg_txns_per_account"),
    ).orderBy("value_decile")


def q3_3_regions(wh: Warehouse) -> DataFrame:
    per_key = _per_orig_account(wh, _count().alias("_txns"), F.sum("amount").alias("_value"))
    g = (_with_account(per_key, wh, "region")
         .groupBy("region")
         .agg(_count().alias("accounts"), F.sum("_txns").alias("txns"),
              F.sum("_value").alias("_value")))
    return g.select(
        "region", "accounts", F.col("txns").cast("long").alias("txns"),
        round_double(F.col("_value"), 2).alias("total_value"),
        avg_half_up(F.col("_value"), F.col("accounts"), 2).alias("value_per_account"),
        pct(F.col("_value"), F.sum("_value").over(_total()), 1).alias("pct_of_value"),
    ).orderBy(F.desc("total_value"), "region")


def q3_4_largest_txn(wh: Warehouse, k: int = 20) -> DataFrame:
    """Each account version's largest transaction, top k.

    ROW_NUMBER per account would sort a hot account's rows in one task;
    ``min(struct(-amount, type_code))`` picks the same row (largest amount,
    ties to the smallest type code) with a combinable aggregate.
    """
    best = (wh.fact_transactions.select("orig_account_key", "transaction_type_key", "amount")
            .join(_types(wh, "type_code"), "transaction_type_key")
            .groupBy("orig_account_key")
            .agg(F.min(F.struct((-F.col("amount")).alias("neg"), F.col("type_code").alias("t")))
                 .alias("_b")))
    rows = _with_account(best, wh, "account_id", "region").select(
        "account_id", "region", F.col("_b.t").alias("type_code"),
        (-F.col("_b.neg")).alias("_amount"), "orig_account_key")
    top = rows.orderBy(F.desc("_amount"), "account_id", "type_code", "orig_account_key").limit(k)
    return top.select("account_id", "region", "type_code",
                      round_double(F.col("_amount"), 2).alias("largest_txn")) \
        .orderBy(F.desc("largest_txn"), "account_id")


# ---------------------------------------------------------------------------
# 04 merchants and advanced windows
# ---------------------------------------------------------------------------
def q4_1_merchant_spend(wh: Warehouse) -> DataFrame:
    per_m = (wh.fact_transactions.filter(F.col("dest_merchant_key").isNotNull())
             .groupBy("dest_merchant_key")
             .agg(_count().alias("_n"), F.sum("amount").alias("_value")))
    m = wh.dim_merchant.select(F.col("merchant_key").alias("dest_merchant_key"), "merchant_category")
    g = (per_m.join(m, "dest_merchant_key")
         .groupBy("merchant_category")
         .agg(F.sum("_n").alias("payments"), _count().alias("merchants"),
              F.sum("_value").alias("_value")))
    return g.select(
        "merchant_category", F.col("payments").cast("long").alias("payments"), "merchants",
        round_double(F.col("_value"), 2).alias("total_spend"),
        avg_half_up(F.col("_value"), F.col("payments"), 2).alias("avg_payment"),
        pct(F.col("_value"), F.sum("_value").over(_total()), 1).alias("pct_of_spend"),
    ).orderBy(F.desc("total_spend"), "merchant_category")


def q4_2_cumulative(wh: Warehouse) -> DataFrame:
    running = F.sum("_value").over(Window.orderBy("calendar_date"))
    return _daily(wh).select(
        "calendar_date",
        round_double(F.col("_value"), 2).alias("daily_value"),
        round_double(running, 2).alias("cumulative_value"),
        pct(running, F.sum("_value").over(_total()), 1).alias("pct_of_month_to_date"),
    ).orderBy("calendar_date")


def q4_3_top_accounts(wh: Warehouse, k: int = 3) -> DataFrame:
    """RANK <= k per region; Catalyst plans a map-side WindowGroupLimit, so
    only each task's top rows per region reach the region shuffle."""
    per_key = _per_orig_account(wh, F.sum("amount").alias("_value"), _count().alias("txns"))
    g = (_with_account(per_key, wh, "account_id", "region")
         .groupBy("region", "account_id")
         .agg(F.sum("_value").alias("_value"), F.sum("txns").alias("txns")))
    w = Window.partitionBy("region").orderBy(F.desc("_value"))
    ranked = g.withColumn("rank_in_region", F.rank().over(w)).filter(F.col("rank_in_region") <= k)
    return ranked.select(
        "region", F.col("rank_in_region").cast("long").alias("rank_in_region"), "account_id",
        round_double(F.col("_value"), 2).alias("total_value"),
        F.col("txns").cast("long").alias("txns"),
    ).orderBy("region", "rank_in_region", "account_id")


def q4_4_busiest_day(wh: Warehouse) -> DataFrame:
    g = (wh.fact_transactions.select("transaction_type_key", "date_key")
         .join(_types(wh, "type_code"), "transaction_type_key")
         .join(_dates(wh, "calendar_date"), "date_key")
         .groupBy("type_code", "calendar_date")
         .agg(_count().alias("txns")))
    w = Window.partitionBy("type_code").orderBy(F.desc("txns"))
    return (g.withColumn("_r", F.dense_rank().over(w)).filter(F.col("_r") == 1)
            .select("type_code", F.col("calendar_date").alias("busiest_day"), "txns")
            .orderBy(F.desc("txns"), "type_code", "busiest_day"))


QUERIES = {
    "q1_1_daily_change": q1_1_daily_change,
    "q1_2_moving_avg": q1_2_moving_avg,
    "q1_3_type_mix": q1_3_type_mix,
    "q1_4_hourly": q1_4_hourly,
    "q1_5_weekend": q1_5_weekend,
    "q2_1_fraud_by_type": q2_1_fraud_by_type,
    "q2_2_fraud_by_hour": q2_2_fraud_by_hour,
    "q2_3_percentiles": q2_3_percentiles,
    "q2_4_confusion": q2_4_confusion,
    "q2_5_fraud_accounts": q2_5_fraud_accounts,
    "q3_1_rfm": q3_1_rfm,
    "q3_2_deciles": q3_2_deciles,
    "q3_3_regions": q3_3_regions,
    "q3_4_largest_txn": q3_4_largest_txn,
    "q4_1_merchant_spend": q4_1_merchant_spend,
    "q4_2_cumulative": q4_2_cumulative,
    "q4_3_top_accounts": q4_3_top_accounts,
    "q4_4_busiest_day": q4_4_busiest_day,
}
