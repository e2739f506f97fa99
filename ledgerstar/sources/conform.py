"""Conform a DataFrame to a declared table contract (column order and types)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns in order, cast to the declared types.

    A missing column is an error (a silently NULL column would hide a broken
    upstream job); extra columns are dropped.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns for {schema.simpleString()[:60]}...: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
