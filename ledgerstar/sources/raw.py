"""Raw transaction sources: the CSV contract and the test-table mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timekeys import timestamp_to_step
from ..schemas import RAW_COLUMNS, RAW_SCHEMA

CORRUPT_COLUMN = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """Header CSV with the explicit raw schema (any Hadoop-FS URI).

    No inference pass. Unparsable cells become NULL (PERMISSIVE mode), which
    the clean step then rejects; with ``keep_corrupt`` the raw line of such
    rows is kept in ``_corrupt_record`` for the quality report.
    """
    schema = RAW_SCHEMA
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if keep_corrupt:
        # a new StructType: ``add`` would modify the shared contract in place
        schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.schema(schema).csv(path)


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Header CSV; padding inside ids is kept (it is data, see the clean report)."""
    (df.select(*RAW_COLUMNS).write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


# ---------------------------------------------------------------------------
# Mapping of the driver's ``events`` table onto the raw contract.
# Event type -> transaction type, fraud modulus, flag threshold.
# ---------------------------------------------------------------------------
EVENT_TYPE_TO_TXN = {
    "click": "CASH_OUT",
    "view": "CASH_IN",
    "signup": "DEBIT",
    "purchase": "PAYMENT",
    "error": "TRANSFER",
}
FRAUD_EVENT_MODULUS = 97
FLAG_THRESHOLD = 200.0


def events_as_transactions(events: DataFrame, keep_event_id: bool = False) -> DataFrame:
    """Map ``events(event_id, ts, user_id, event_type, value, props)`` to raw rows."""
    mapping = F.create_map(*[F.lit(x) for kv in EVENT_TYPE_TO_TXN.items() for x in kv])
    k = F.get_json_object(F.col("props"), "$.k")
    base = events.select(
        F.col("event_id"),
        timestamp_to_step(F.col("ts").cast("timestamp_ntz")).alias("step"),
        F.element_at(mapping, F.col("event_type")).alias("type"),
        F.col("value").cast("decimal(18,2)").cast("double").alias("amount"),
        F.col("value").alias("_value"),
        F.col("user_id").cast("double").alias("_uid"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        F.when(F.col("event_type") == "purchase", F.lit("M")).otherwise(F.lit("C")).alias("_prefix"),
        k.alias("_k"),
    )
    fraud = (F.col("type").isin("TRANSFER", "CASH_OUT")
             & (F.col("event_id") % FRAUD_EVENT_MODULUS == 0))
    payment = F.col("type") == "PAYMENT"
    kd = F.col("_k").cast("double")
    out = base.select(
        "event_id", "step", "type", "amount", "nameOrig", "_uid", "_value", "_prefix", "_k",
        fraud.alias("_fraud"), payment.alias("_payment"), kd.alias("_kd"),
    ).select(
        "event_id",
        "step",
        "type",
        "amount",
        "nameOrig",
        F.when(F.col("_fraud"), 0.0).otherwise(F.col("_uid")).alias("oldbalanceOrg"),
        F.when(F.col("_fraud") | (F.col("_uid") < F.col("amount")), 0.0)
         .otherwise(F.col("_uid") - F.col("amount")).alias("newbalanceOrig"),
        F.concat(F.col("_prefix"), F.col("_k")).alias("nameDest"),
        F.when(F.col("_fraud") | F.col("_payment"), 0.0).otherwise(F.col("_kd")).alias("oldbalanceDest"),
        F.when(F.col("_fraud") | F.col("_payment"), 0.0)
         .otherwise(F.col("_kd") + F.col("amount")).alias("newbalanceDest"),
        F.col("_fraud").cast("int").alias("isFraud"),
        ((F.col("type") == "TRANSFER") & (F.col("_value") > FLAG_THRESHOLD)).cast("int").alias("isFlaggedFraud"),
    )
    cols = (["event_id"] if keep_event_id else []) + RAW_COLUMNS
    return out.select(*cols)


def with_defects(mapped: DataFrame) -> DataFrame:
    """Deterministic dirty variant of mapped rows (needs ``event_id``).

    Fixed moduli: step +744 (id % 89 = 5); hyphenated CASH types (% 10 = 3);
    UNKNOWN type (% 101 = 7, unless % 10 = 3); negated amount (% 71 = 2); NULL amount
    (% 73 = 2); NULL originator (% 79 = 1); two-space originator (% 83 = 1);
    trailing-space originator (% 61 = 1); empty destination (% 67 = 1);
    rows with id % 50 = 0 appear twice.
    """
    eid = F.col("event_id")
    hyphen = F.when(F.col("type").isin("CASH_IN", "CASH_OUT"),
                    F.regexp_replace(F.col("type"), "_", "-")).otherwise(F.col("type"))
    rows = F.struct(
        eid.alias("event_id"),
        F.when(eid % 89 == 5, F.col("step") + 744).otherwise(F.col("step")).alias("step"),
        F.when(eid % 10 == 3, hyphen)
         .when(eid % 101 == 7, F.lit("UNKNOWN"))
         .otherwise(F.col("type")).alias("type"),
        F.when(eid % 71 == 2, -F.col("amount"))
         .when(eid % 73 == 2, F.lit(None).cast("double"))
         .otherwise(F.col("amount")).alias("amount"),
        F.when(eid % 79 == 1, F.lit(None).cast("string"))
         .when(eid % 83 == 1, F.lit("  "))
         .when(eid % 61 == 1, F.concat(F.col("nameOrig"), F.lit(" ")))
         .otherwise(F.col("nameOrig")).alias("nameOrig"),
        "oldbalanceOrg", "newbalanceOrig",
        F.when(eid % 67 == 1, F.lit("")).otherwise(F.col("nameDest")).alias("nameDest"),
        "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud",
    )
    # unfolded, not a union: the events are read once, and filters on the rows
    # see finished columns in place of copies of what these are made from
    return mapped.select(F.inline(F.array_repeat(rows, F.when(eid % 50 == 0, 2).otherwise(1))))


def raw_transactions(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    """Raw 11-column transactions derived from ``{sf_dir}/events.parquet``."""
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    mapped = events_as_transactions(events, keep_event_id=True)
    rows = with_defects(mapped) if dirty else mapped
    return rows.select(*RAW_COLUMNS)
