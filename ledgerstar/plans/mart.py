"""Stored day aggregates that merge over any range of days.

* ``histogram``: rows per day, type and amount bucket. Percentiles of a range
  add up its days' histograms to find the buckets that hold the wanted order
  statistics; of the facts, only rows of these buckets are read.
* ``sketches``: the filterable dashboard feed by day, originator region and
  type, with HyperLogLog sketches of the distinct originators and merchants.
  Distinct numbers do not add up over rows of the feed, sketches do.

A day is a folder in each; writing a day again replaces it.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import round_double
from ..operators import percentiles
from .star import Warehouse

#: Logarithm of a sketch's registers: 2^14 of them, 16 KB at most. The standard error of a merged sketch is 1.04 / sqrt(registers), 0.8 %.
SKETCH_BITS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
#: An estimate stays within so many standard errors (99.99 % of all estimates).
SIGMAS = 4

HISTOGRAM = T.StructType([T.StructField("type_code", T.StringType()), T.StructField("bucket", T.LongType()), T.StructField("txns", T.LongType()),
                          T.StructField("partition_date", T.DateType())])
SKETCHES = T.StructType([T.StructField("region", T.StringType()), T.StructField("type_code", T.StringType()), T.StructField("txns", T.LongType()),
                         T.StructField("value", T.DecimalType(38, 2)), T.StructField("fraud_txns", T.LongType()),
                         T.StructField("accounts", T.BinaryType()), T.StructField("merchants", T.BinaryType()), T.StructField("partition_date", T.DateType())])


@dataclass
class Mart:
    histogram: DataFrame
    sketches: DataFrame


def _types(wh: Warehouse) -> DataFrame:
    return F.broadcast(wh.dim_transaction_type.select("transaction_type_key", "type_code"))  # five rows


def amount_histogram(wh: Warehouse) -> DataFrame:
    """Rows per day, type and bucket of the amount: about a thousand rows per day and type, however many facts there are."""
    counted = (wh.fact_transactions.where(F.col("amount").isNotNull())
               .groupBy("partition_date", "transaction_type_key", percentiles.value_bucket(F.col("amount")).alias("bucket"))
               .agg(F.count(F.lit(1)).alias("txns")))
    return counted.join(_types(wh), "transaction_type_key").select(*HISTOGRAM.names)


def daily_sketches(wh: Warehouse) -> DataFrame:
    """The dashboard feed with sketches. Facts are summed up by day, account
    version, type and merchant before they meet the accounts."""
    per = (wh.fact_transactions.groupBy("partition_date", "orig_account_key", "transaction_type_key", "dest_merchant_key")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("v"), F.count_if("is_fraud").alias("fr")))
    accounts = wh.dim_account.select(F.col("account_key").alias("orig_account_key"), "account_id", "region")
    return (per.join(accounts, "orig_account_key").join(_types(wh), "transaction_type_key").groupBy("partition_date", "region", "type_code")
            .agg(F.sum("n").alias("txns"), F.sum("v").cast("decimal(38,2)").alias("value"), F.sum("fr").alias("fraud_txns"),
                 F.hll_sketch_agg("account_id", F.lit(SKETCH_BITS)).alias("accounts"), F.hll_sketch_agg("dest_merchant_key", F.lit(SKETCH_BITS)).alias("merchants"))
            .select(*SKETCHES.names))


def write_mart(wh: Warehouse, path: str) -> None:
    """Write the days that ``wh`` holds; other days of the mart stay."""
    for df, name in ((amount_histogram(wh), "histogram"), (daily_sketches(wh), "sketches")):
        (df.hint("rebalance", "partition_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("partition_date").parquet(f"{path.rstrip('/')}/{name}"))


def read_mart(spark: SparkSession, path: str) -> Mart:
    return Mart(*[spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{name}") for name, schema in (("histogram", HISTOGRAM), ("sketches", SKETCHES))])


def range_percentiles(wh: Warehouse, mart: Mart, first: datetime.date, last: datetime.date,
                      probs: list[float], names: list[str]) -> DataFrame:
    """Exact continuous percentiles of the amount per type over the days from
    ``first`` to ``last``; a type without a row there has none.

    The buckets to read (types x probabilities x 2 at most) are found in the
    mart and become a filter on the amount that the scan of the facts checks
    against its statistics. The mart must hold the same days as ``wh``.
    """
    days = F.col("partition_date").between(F.lit(first), F.lit(last))
    hist = mart.histogram.where(days).groupBy("type_code", F.col("bucket").alias("_b")).agg(F.sum("txns").alias("_c"))
    targets = percentiles.rank_targets(hist, "type_code", probs, names)
    buckets = sorted(r[0] for r in targets.select("_b").distinct().collect())
    bounds = [percentiles.bucket_bounds(b) for b in buckets]
    near = reduce(Column.__or__, [F.col("amount").between(F.lit(low).cast("decimal(18,2)"), F.lit(high).cast("decimal(18,2)")) for low, high in bounds], F.lit(False))
    vals = (wh.fact_transactions.where(days & near).select("transaction_type_key", "amount").join(_types(wh), "transaction_type_key")
            .select("type_code", "amount", percentiles.value_bucket(F.col("amount")).alias("_b")))
    return percentiles.order_statistics(vals, targets, "type_code", "amount", names)


def filtered_feed(mart: Mart, where: Column | None = None, by: list[str] | None = None) -> DataFrame:
    """The feed under any filter on day, region and type, grouped by ``by``
    (columns of the feed; none: one row): txns, total_value, fraud_txns, and the
    estimated distinct originators and merchants with SKETCH_ERROR as standard
    error. The facts are not read."""
    rows = mart.sketches if where is None else mart.sketches.where(where)
    number = lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).cast("long").alias(c)
    return (rows.groupBy(*(by or [])).agg(F.sum("txns").cast("long").alias("txns"), round_double(F.sum("value"), 2).alias("total_value"),
                                          F.sum("fraud_txns").cast("long").alias("fraud_txns"), number("accounts"), number("merchants")))


def exact_distinct(wh: Warehouse, where: Column | None = None, by: list[str] | None = None) -> DataFrame:
    """The exact distinct originators and merchants under a filter on day,
    region and type, from the facts."""
    facts = wh.fact_transactions.select("partition_date", "orig_account_key", "transaction_type_key", "dest_merchant_key").distinct()
    accounts = wh.dim_account.select(F.col("account_key").alias("orig_account_key"), "account_id", "region")
    rows = facts.join(accounts, "orig_account_key").join(_types(wh), "transaction_type_key")
    rows = rows if where is None else rows.where(where)
    return rows.groupBy(*(by or [])).agg(F.countDistinct("account_id").alias("accounts"), F.countDistinct("dest_merchant_key").alias("merchants"))


def within_error(estimate: Column, exact: Column) -> Column:
    """Whether an estimate lies where it should; below one it is rounded."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), SIGMAS * SKETCH_ERROR * exact)
