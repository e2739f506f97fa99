"""Lookups of single accounts in a stored warehouse."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .star import Warehouse


def account_transactions(wh: Warehouse, account_id: str, first: datetime.date | None = None, last: datetime.date | None = None) -> DataFrame:
    """The facts that an account sent or received, with ``direction``; one that
    it sent to itself comes twice.

    The keys of the account's versions (one per load that changed it) are
    looked up first and stand in the filter: facts are sorted by originator
    inside a day's files and carry Bloom filters on the destination, so a
    scan skips the row groups that cannot hold the account.
    """
    keys = [r[0] for r in wh.dim_account.where(F.col("account_id") == account_id).select("account_key").collect()]
    facts = wh.fact_transactions
    if first is not None:
        facts = facts.where(F.col("partition_date") >= F.lit(first))
    if last is not None:
        facts = facts.where(F.col("partition_date") <= F.lit(last))
    sent, received = (facts.where(F.col(c).isin(keys)).withColumn("direction", F.lit(name))
                      for c, name in (("orig_account_key", "sent"), ("dest_account_key", "received")))
    return sent.unionByName(received)
