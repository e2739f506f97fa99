"""Masking, destination classification and time keys (P1-P8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.masking import mask_id
from ..functions.timekeys import date_key_of, step_to_timestamp
from ..functions.typecodes import normalise_type
from ..schemas import MERCHANT_PREFIX


def enrich(df: DataFrame, salt: str) -> DataFrame:
    """Narrow projection: no shuffle. Raw identifiers are dropped here."""
    if not salt:
        raise ValueError("a masking salt is required")
    ts = step_to_timestamp("step")
    return df.select(
        "step", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest",
        "newbalanceDest", "isFraud", "isFlaggedFraud",
        mask_id("nameOrig", salt).alias("orig_account_id"),
        mask_id("nameDest", salt).alias("dest_id_masked"),
        F.col("nameDest").startswith(MERCHANT_PREFIX).alias("dest_is_merchant"),
        ts.alias("full_timestamp"),
        F.to_date(ts).alias("calendar_date"),
        F.hour(ts).alias("hour_of_day"),
        date_key_of(ts).alias("date_key"),
        normalise_type("type").alias("type_code"),
    )
