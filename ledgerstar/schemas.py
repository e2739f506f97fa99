"""Schemas and fixed reference values of the transaction star schema."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written: the region and category
# buckets, the seeded type table and the simulation calendar are part of the
# data contract (changing one changes every derived attribute).
# ---------------------------------------------------------------------------
SIMULATION_START = "2024-01-01"  # step 1 = hour 0 of this day
MIN_STEP = 1
MAX_STEP = 744  # 31 days of hourly steps

REGIONS = ["Ontario", "Quebec", "British Columbia", "Alberta", "Atlantic", "Prairies"]
MERCHANT_CATEGORIES = [
    "Grocery", "Fuel", "Retail", "Restaurant", "Utilities",
    "Travel", "Healthcare", "Entertainment",
]

# (type_code, channel_category, description), in seeding order; the
# surrogate transaction_type_key is the 1-based position in this list.
TRANSACTION_TYPES = [
    ("CASH_IN", "ATM", "Customer deposits cash into account"),
    ("CASH_OUT", "ATM", "Customer withdraws cash from account"),
    ("DEBIT", "POS", "Point-of-sale debit transaction"),
    ("PAYMENT", "Online", "Payment made to a merchant"),
    ("TRANSFER", "Wire", "Funds transferred between accounts"),
]
VALID_TYPE_CODES = [code for code, _, _ in TRANSACTION_TYPES]

DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

DEFAULT_ACCOUNT_STATUS = "ACTIVE"
MERCHANT_PREFIX = "M"
MASK_HEX_CHARS = 32

# ---------------------------------------------------------------------------
# Raw source contract (11 columns, explicit, never inferred)
# ---------------------------------------------------------------------------
RAW_SCHEMA = T.StructType([
    T.StructField("step", T.IntegerType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("nameOrig", T.StringType(), False),
    T.StructField("oldbalanceOrg", T.DoubleType(), True),
    T.StructField("newbalanceOrig", T.DoubleType(), True),
    T.StructField("nameDest", T.StringType(), False),
    T.StructField("oldbalanceDest", T.DoubleType(), True),
    T.StructField("newbalanceDest", T.DoubleType(), True),
    T.StructField("isFraud", T.IntegerType(), False),
    T.StructField("isFlaggedFraud", T.IntegerType(), False),
])
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

MONEY = T.DecimalType(18, 2)

# ---------------------------------------------------------------------------
# Staging (natural keys) and warehouse (surrogate keys) layouts
# ---------------------------------------------------------------------------
DIM_ACCOUNT_STAGING = T.StructType([
    T.StructField("account_id", T.StringType(), False),
    T.StructField("region", T.StringType(), True),
    T.StructField("account_status", T.StringType(), False),
])

DIM_MERCHANT_STAGING = T.StructType([
    T.StructField("merchant_id", T.StringType(), False),
    T.StructField("merchant_category", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
])

DIM_DATE = T.StructType([
    T.StructField("date_key", T.LongType(), False),
    T.StructField("full_timestamp", T.TimestampNTZType(), False),
    T.StructField("step", T.IntegerType(), False),
    T.StructField("calendar_date", T.DateType(), False),
    T.StructField("hour_of_day", T.IntegerType(), False),
    T.StructField("day_of_week", T.IntegerType(), False),
    T.StructField("day_name", T.StringType(), False),
    T.StructField("week_of_month", T.IntegerType(), False),
    T.StructField("month_number", T.IntegerType(), False),
    T.StructField("month_name", T.StringType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("is_weekend", T.BooleanType(), False),
])

FACT_STAGING = T.StructType([
    T.StructField("orig_account_id", T.StringType(), False),
    T.StructField("dest_account_id", T.StringType(), True),
    T.StructField("dest_merchant_id", T.StringType(), True),
    T.StructField("date_key", T.LongType(), False),
    T.StructField("partition_date", T.DateType(), False),
    T.StructField("type_code", T.StringType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("balance_before_orig", T.DoubleType(), True),
    T.StructField("balance_after_orig", T.DoubleType(), True),
    T.StructField("balance_before_dest", T.DoubleType(), True),
    T.StructField("balance_after_dest", T.DoubleType(), True),
    T.StructField("is_fraud", T.BooleanType(), False),
    T.StructField("is_flagged_by_system", T.BooleanType(), False),
    T.StructField("source_step", T.IntegerType(), False),
])

DIM_TRANSACTION_TYPE = T.StructType([
    T.StructField("transaction_type_key", T.IntegerType(), False),
    T.StructField("type_code", T.StringType(), False),
    T.StructField("channel_category", T.StringType(), False),
    T.StructField("description", T.StringType(), True),
])

DIM_ACCOUNT = T.StructType([
    T.StructField("account_key", T.StringType(), False),
    T.StructField("account_id", T.StringType(), False),
    T.StructField("region", T.StringType(), True),
    T.StructField("account_status", T.StringType(), False),
    T.StructField("effective_start", T.TimestampNTZType(), False),
    T.StructField("effective_end", T.TimestampNTZType(), True),
    T.StructField("is_current", T.BooleanType(), False),
])

DIM_MERCHANT = T.StructType([
    T.StructField("merchant_key", T.StringType(), False),
    T.StructField("merchant_id", T.StringType(), False),
    T.StructField("merchant_category", T.StringType(), True),
    T.StructField("region", T.StringType(), True),
])

FACT_TRANSACTIONS = T.StructType([
    T.StructField("transaction_key", T.StringType(), False),
    T.StructField("date_key", T.LongType(), False),
    T.StructField("transaction_type_key", T.IntegerType(), False),
    T.StructField("orig_account_key", T.StringType(), False),
    T.StructField("dest_account_key", T.StringType(), True),
    T.StructField("dest_merchant_key", T.StringType(), True),
    T.StructField("amount", MONEY, False),
    T.StructField("balance_before_orig", MONEY, True),
    T.StructField("balance_after_orig", MONEY, True),
    T.StructField("balance_before_dest", MONEY, True),
    T.StructField("balance_after_dest", MONEY, True),
    T.StructField("is_fraud", T.BooleanType(), False),
    T.StructField("is_flagged_by_system", T.BooleanType(), False),
    T.StructField("source_step", T.IntegerType(), False),
    T.StructField("loaded_at", T.TimestampNTZType(), False),
    T.StructField("partition_date", T.DateType(), False),
])
