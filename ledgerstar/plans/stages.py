"""Driver-facing plans for the transform stages and the quality checks.

Each function takes (spark, sf_dir) and derives its input from the
``events`` table of that scale (whole table, dirty variant).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.masking import mask_id
from ..functions.typecodes import normalise_type
from ..operators import quality as Q
from ..operators.clean import clean, clean_report, rule_columns
from ..operators.dimensions import (account_dimension, date_dimension, dim_transaction_type,
                                    fact_staging, merchant_dimension)
from ..operators.enrich import enrich
from ..oracle import TEST_SALT
from ..schemas import RAW_COLUMNS, VALID_TYPE_CODES
from ..sources.raw import raw_transactions
from .star import star_from_testdata, transform


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_transactions(spark, sf_dir)


def _txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(clean(_raw(spark, sf_dir)), TEST_SALT)


def clean_rows(spark, sf_dir):
    return clean(_raw(spark, sf_dir))


def clean_rows_strict(spark, sf_dir):
    return clean(_raw(spark, sf_dir), strict_types=True)


def clean_report_q(spark, sf_dir):
    return clean_report(_raw(spark, sf_dir))


def dedup_rows(spark, sf_dir):
    """Rows that passed every rule but occurred more than once, with copies."""
    ok = F.lit(True)
    for _, passes in rule_columns():
        ok = ok & passes
    kept = _raw(spark, sf_dir).filter(ok).withColumn("type", normalise_type("type"))
    return (kept.groupBy(*RAW_COLUMNS).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def mask_ids(spark, sf_dir):
    """Distinct raw id -> masked id pairs over both roles."""
    c = clean(_raw(spark, sf_dir))
    ids = c.select(F.col("nameOrig").alias("raw_id")).union(c.select(F.col("nameDest").alias("raw_id")))
    return ids.distinct().select("raw_id", mask_id("raw_id", TEST_SALT).alias("masked_id"))


def classify_dest(spark, sf_dir):
    t = _txn(spark, sf_dir)
    return t.groupBy("dest_is_merchant").agg(
        F.count(F.lit(1)).alias("txns"),
        F.countDistinct("dest_id_masked").cast("long").alias("destinations"))


def step_time_keys(spark, sf_dir):
    t = _txn(spark, sf_dir)
    return t.groupBy("step", "full_timestamp", "calendar_date", "hour_of_day", "date_key").agg(
        F.count(F.lit(1)).alias("txns"))


def normalise_type_q(spark, sf_dir):
    """Raw type values, their normalised code and whether it is whitelisted."""
    per_raw = _raw(spark, sf_dir).groupBy(F.col("type").alias("raw_type")).agg(
        F.count(F.lit(1)).alias("rows"))
    code = normalise_type("raw_type")
    return per_raw.select("raw_type", code.alias("type_code"),
                          F.coalesce(code.isin(*VALID_TYPE_CODES), F.lit(False)).alias("valid"),
                          "rows")


def region_bucket(spark, sf_dir):
    s = transform(_raw(spark, sf_dir), TEST_SALT)
    a = s.dim_account.groupBy("region").agg(F.count(F.lit(1)).alias("accounts"))
    m = s.dim_merchant.groupBy("region").agg(F.count(F.lit(1)).alias("merchants"))
    return a.join(m, "region", "full_outer").select(
        "region", F.coalesce("accounts", F.lit(0)).cast("long").alias("accounts"),
        F.coalesce("merchants", F.lit(0)).cast("long").alias("merchants"))


def merchant_category_bucket(spark, sf_dir):
    s = transform(_raw(spark, sf_dir), TEST_SALT)
    return s.dim_merchant.groupBy("merchant_category", "region").agg(
        F.count(F.lit(1)).alias("merchants"))


def dim_account_q(spark, sf_dir):
    return account_dimension(fact_staging(_txn(spark, sf_dir)))


def dim_merchant_q(spark, sf_dir):
    return merchant_dimension(fact_staging(_txn(spark, sf_dir)))


def dim_date_q(spark, sf_dir):
    return date_dimension(fact_staging(_txn(spark, sf_dir)))


def fact_staging_q(spark, sf_dir):
    return fact_staging(_txn(spark, sf_dir))


def dim_transaction_type_q(spark, sf_dir):
    """The seeded types with how many cleaned rows use each."""
    t = _txn(spark, sf_dir).groupBy("type_code").agg(F.count(F.lit(1)).alias("txns"))
    return dim_transaction_type(spark).join(F.broadcast(t), "type_code", "left").select(
        "transaction_type_key", "type_code", "channel_category", "description",
        F.coalesce("txns", F.lit(0)).cast("long").alias("txns"))


# -- quality ------------------------------------------------------------------
def dq_report(spark, sf_dir):
    s = transform(_raw(spark, sf_dir), TEST_SALT)
    wh = star_from_testdata(spark, sf_dir, TEST_SALT)
    return Q.validate_staging(s.fact, s.dim_account).unionByName(
        Q.domain_checks(wh.dim_date, wh.fact_transactions))


def dq_orphans(spark, sf_dir):
    """Originators of all days missing from an account dimension built from
    days 1-15 only (late-arriving accounts)."""
    fact = fact_staging(_txn(spark, sf_dir))
    early = account_dimension(fact.filter(F.col("partition_date") <= F.lit("2024-01-15").cast("date")))
    return Q.orphan_originators(fact, early)


def dq_uniqueness(spark, sf_dir):
    return Q.uniqueness_checks(star_from_testdata(spark, sf_dir, TEST_SALT).tables())


def dq_foreign_keys(spark, sf_dir):
    return Q.foreign_key_checks(star_from_testdata(spark, sf_dir, TEST_SALT).tables())


def dq_not_null(spark, sf_dir):
    return Q.not_null_checks(star_from_testdata(spark, sf_dir, TEST_SALT).tables())


def dq_masked_ids(spark, sf_dir):
    c = clean(_raw(spark, sf_dir))
    raw_ids = c.select(F.col("nameOrig").alias("id")).union(c.select(F.col("nameDest").alias("id")))
    masked = raw_ids.select(mask_id("id", TEST_SALT).alias("id"))
    return Q.masked_id_checks(raw_ids, masked)


STAGE_QUERIES = {
    "clean_rows": clean_rows,
    "clean_rows_strict": clean_rows_strict,
    "clean_report": clean_report_q,
    "dedup_rows": dedup_rows,
    "mask_ids": mask_ids,
    "classify_dest": classify_dest,
    "step_time_keys": step_time_keys,
    "normalise_type": normalise_type_q,
    "region_bucket": region_bucket,
    "merchant_category_bucket": merchant_category_bucket,
    "dim_account": dim_account_q,
    "dim_merchant": dim_merchant_q,
    "dim_date": dim_date_q,
    "fact_staging": fact_staging_q,
    "dim_transaction_type": dim_transaction_type_q,
    "dq_report": dq_report,
    "dq_orphans": dq_orphans,
    "dq_uniqueness": dq_uniqueness,
    "dq_foreign_keys": dq_foreign_keys,
    "dq_not_null": dq_not_null,
    "dq_masked_ids": dq_masked_ids,
}


# -- sources and sinks ----------------------------------------------------------
def _scratch(spark, name: str) -> str:
    import uuid

    from ..session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def csv_roundtrip(spark, sf_dir):
    """Raw rows written as header CSV and read back with the explicit schema
    (no inference), then cleaned: must equal the cleaned rows."""
    from ..sources.raw import read_raw_csv, write_raw_csv
    path = _scratch(spark, "raw-csv")
    write_raw_csv(_raw(spark, sf_dir), path)
    return clean(read_raw_csv(spark, path))


def fact_partition_write(spark, sf_dir):
    """Fact staging written one folder per day and read back with partition
    discovery (``partition_date`` comes back typed as a date)."""
    from ..sources.sinks import write_fact
    path = _scratch(spark, "fact-days")
    write_fact(fact_staging_q(spark, sf_dir), path, replace_days_only=False)
    back = spark.read.parquet(path).withColumn("_file", F.input_file_name())
    return back.groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("_file").cast("long").alias("files"),
        F.round(F.sum("amount"), 2).alias("total_amount"))


STAGE_QUERIES["csv_roundtrip"] = csv_roundtrip
STAGE_QUERIES["fact_partition_write"] = fact_partition_write


def dim_single_file(spark, sf_dir):
    """The small dimensions written twice to the same folders (full overwrite)
    and read back: one file each, and no row of the first write."""
    from ..sources.sinks import write_dimension
    path = _scratch(spark, "dims")
    fact = fact_staging_q(spark, sf_dir)
    out = None
    for name, df, key in (("dim_date", date_dimension(fact), "date_key"), ("dim_merchant", merchant_dimension(fact), "merchant_id"),
                          ("dim_transaction_type", dim_transaction_type(spark), "type_code")):
        write_dimension(df.unionByName(df), f"{path}/{name}")
        write_dimension(df, f"{path}/{name}")
        back = spark.read.parquet(f"{path}/{name}").withColumn("_file", F.input_file_name())
        one = back.agg(F.lit(name).alias("dimension"), F.count(F.lit(1)).alias("rows"), F.countDistinct(key).cast("long").alias("keys"),
                       F.countDistinct("_file").cast("long").alias("files"))
        out = one if out is None else out.unionByName(one)
    return out


#: Balances that P24 reads as unknown: by hex digits of the originator.
NAN_ORIG, NAN_DEST = 7, 5


def nan_balances(spark, sf_dir):
    """Facts whose balances came as NaN, resolved: NULL in the warehouse, not NaN and not zero."""
    from ..operators import warehouse as W
    s = transform(_raw(spark, sf_dir), TEST_SALT)
    h = F.conv(F.substring("orig_account_id", 9, 2), 16, 10).cast("int")
    nan = F.lit(float("nan"))
    fact = s.fact.withColumns({"balance_before_orig": F.when(h % NAN_ORIG == 0, nan).otherwise(F.col("balance_before_orig")),
                               "balance_after_dest": F.when(h % NAN_DEST == 0, nan).otherwise(F.col("balance_after_dest"))})
    accounts = W.scd2_merge(None, s.dim_account, "2024-02-01 00:00:00").state
    out = W.resolve_fact(fact, accounts, W.type1_upsert(None, s.dim_merchant).state, dim_transaction_type(spark), "2024-02-01 00:00:00")
    return out.groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).cast("long").alias(f"unknown_{c}") for c in ("balance_before_orig", "balance_after_dest")],
        *[F.sum(c).cast("double").alias(f"sum_{c}") for c in ("balance_before_orig", "balance_after_dest")])


STAGE_QUERIES["dim_single_file"] = dim_single_file
STAGE_QUERIES["nan_balances"] = nan_balances
