"""Data-quality checks (V1-V11) as aggregate reports.

Each report is a small DataFrame ``(check, violations)`` computed with as few
passes as possible: row-level predicates of one table share one aggregate,
key checks are partial-then-final aggregates, foreign keys are anti-joins.
``assert_ok`` runs a report and raises with every failing check listed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.masking import is_masked_id


def _long(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("long")


def _melt(row: DataFrame, checks: list[str]) -> DataFrame:
    """1-row wide report -> (check, violations) rows."""
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("check"), _long(F.col(c)).alias("violations")) for c in checks
    ])).alias("r")).select("r.check", "r.violations")


def staging_checks(fact: DataFrame) -> DataFrame:
    """V1, V2, V4 on the fact staging in one aggregate."""
    a, m = F.col("dest_account_id").isNotNull(), F.col("dest_merchant_id").isNotNull()
    row = fact.agg(
        F.count_if(a & m).alias("dest_both_set"),
        F.count_if(~a & ~m).alias("dest_neither_set"),
        F.count_if(F.col("amount") < 0).alias("negative_amounts"))
    return _melt(row, ["dest_both_set", "dest_neither_set", "negative_amounts"])


def orphan_originators(fact: DataFrame, accounts: DataFrame) -> DataFrame:
    """V3: distinct originator ids missing from the account dimension."""
    return (fact.select(F.col("orig_account_id").alias("account_id")).distinct()
            .join(accounts.select("account_id"), "account_id", "left_anti"))


def validate_staging(fact: DataFrame, accounts: DataFrame) -> DataFrame:
    """V1-V4 and the masked-id format of every account id (V11)."""
    orphans = orphan_originators(fact, accounts).agg(F.count(F.lit(1)).alias("orphan_originators"))
    fmt = accounts.agg(F.count_if(~is_masked_id(F.col("account_id"))).alias("bad_account_ids"))
    return (staging_checks(fact).unionByName(_melt(orphans, ["orphan_originators"]))
            .unionByName(_melt(fmt, ["bad_account_ids"])))


def domain_checks(dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """V6/V7 row predicates of the warehouse tables."""
    d = dim_date.agg(
        F.count_if(~F.col("hour_of_day").between(0, 23)).alias("hour_out_of_range"),
        F.count_if(~F.col("day_of_week").between(1, 7)).alias("day_of_week_out_of_range"),
        F.count_if(~F.col("month_number").between(1, 12)).alias("month_out_of_range"),
        F.count_if(~F.col("quarter").between(1, 4)).alias("quarter_out_of_range"))
    a, m = F.col("dest_account_key").isNotNull(), F.col("dest_merchant_key").isNotNull()
    f = fact.agg(
        F.count_if(F.col("amount") < 0).alias("fact_negative_amount"),
        F.count_if(a == m).alias("fact_dest_not_exactly_one"))
    return _melt(d, ["hour_out_of_range", "day_of_week_out_of_range", "month_out_of_range",
                     "quarter_out_of_range"]).unionByName(
        _melt(f, ["fact_negative_amount", "fact_dest_not_exactly_one"]))


def duplicate_keys(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """V8: number of key values held by more than one row."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).cast("long").alias("violations")) \
        .select(F.lit(name).alias("check"), "violations")


def uniqueness_checks(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        duplicate_keys(tables["dim_date"], ["date_key"], "dim_date.date_key"),
        duplicate_keys(tables["dim_transaction_type"], ["type_code"], "dim_transaction_type.type_code"),
        duplicate_keys(tables["dim_account"], ["account_id", "effective_start"],
                       "dim_account.account_id_effective_start"),
        duplicate_keys(tables["dim_account"].filter(F.col("is_current")), ["account_id"],
                       "dim_account.current_per_account"),
        duplicate_keys(tables["dim_merchant"], ["merchant_id"], "dim_merchant.merchant_id"),
        # deterministic hash surrogates: a collision would show here
        duplicate_keys(tables["dim_account"], ["account_key"], "dim_account.account_key"),
        duplicate_keys(tables["dim_merchant"], ["merchant_key"], "dim_merchant.merchant_key"),
        duplicate_keys(tables["fact_transactions"], ["transaction_key"], "fact.transaction_key"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _orphans(fact: DataFrame, fk: str, dim: DataFrame, pk: str, name: str) -> DataFrame:
    keys = fact.select(F.col(fk).alias(pk)).filter(F.col(pk).isNotNull()).groupBy(pk).agg(F.count(F.lit(1)).alias("_n"))
    return keys.join(dim.select(pk), pk, "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violations")).select(F.lit(name).alias("check"), "violations")


def foreign_key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """V9: fact rows whose key has no dimension row (one anti-join per key).

    The fact is first counted by key (combined before the shuffle), so each
    check joins distinct keys, not fact rows.
    """
    f = tables["fact_transactions"]
    parts = [
        _orphans(f, "date_key", tables["dim_date"], "date_key", "fact.date_key"),
        _orphans(f, "transaction_type_key", tables["dim_transaction_type"], "transaction_type_key",
                 "fact.transaction_type_key"),
        _orphans(f, "orig_account_key", tables["dim_account"], "account_key", "fact.orig_account_key"),
        _orphans(f, "dest_account_key", tables["dim_account"], "account_key", "fact.dest_account_key"),
        _orphans(f, "dest_merchant_key", tables["dim_merchant"], "merchant_key", "fact.dest_merchant_key"),
    ]
    return reduce(DataFrame.unionByName, parts)


NOT_NULL = {
    "dim_date": ["date_key", "full_timestamp", "step", "calendar_date", "hour_of_day", "day_of_week",
                 "day_name", "week_of_month", "month_number", "month_name", "quarter", "year",
                 "is_weekend"],
    "dim_account": ["account_key", "account_id", "account_status", "effective_start", "is_current"],
    "dim_merchant": ["merchant_key", "merchant_id"],
    "fact_transactions": ["date_key", "transaction_type_key", "orig_account_key", "amount",
                          "is_fraud", "is_flagged_by_system", "source_step", "loaded_at"],
}


def not_null_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """V10: NULL counts of required columns, one aggregate per table."""
    parts = []
    for t, cols in NOT_NULL.items():
        row = tables[t].agg(*[F.count_if(F.col(c).isNull()).alias(f"{t}_{c}") for c in cols])
        parts.append(_melt(row, [f"{t}_{c}" for c in cols]))
    return reduce(DataFrame.unionByName, parts).withColumn(
        "check", F.concat(F.lit("not_null:"), F.col("check")))


def masked_id_checks(raw_ids: DataFrame, masked: DataFrame) -> DataFrame:
    """V11: ids are 32 lowercase hex; masking keeps distinct ids distinct.

    ``raw_ids``/``masked`` are the (id) columns before and after masking of
    the same rows; distinct counts are compared (a collision lowers the
    masked count).
    """
    raw_distinct = raw_ids.agg(F.count_distinct(F.col("id"))).scalar()
    m = masked.agg(F.count_distinct(F.col("id")).alias("masked_distinct"),
                   F.count_if(~is_masked_id(F.col("id"))).alias("bad_format"))
    row = m.select((raw_distinct - F.col("masked_distinct")).alias("collisions"), "bad_format")
    return _melt(row, ["collisions", "bad_format"])


def assert_ok(report: DataFrame) -> dict[str, int]:
    """Run the report once (one row per check), fail listing every failing
    check, else return all counts."""
    counts = {r["check"]: r["violations"] for r in report.collect()}
    bad = {k: v for k, v in counts.items() if v}
    if bad:
        lines = ", ".join(f"{k}={v}" for k, v in bad.items())
        raise ValueError(f"validation failed: {lines}")
    return counts
