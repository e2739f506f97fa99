"""The transform and load jobs as DataFrame plans, and the star they produce.

``transform`` is raw -> clean -> enrich -> four staging datasets on natural
keys. ``load_batch`` applies one staged batch to a warehouse state:
insert-if-new dates, type-1 merchants, type-2 accounts, and facts resolved
to surrogate keys with replace-by-partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import warehouse as W
from ..operators.clean import clean
from ..operators.dimensions import (account_dimension, date_dimension, dim_transaction_type,
                                    fact_staging, merchant_dimension)
from ..operators.enrich import enrich
from ..sources.raw import raw_transactions

DEFAULT_BATCH_TS = "2024-02-01 00:00:00"


@dataclass
class Staged:
    dim_account: DataFrame
    dim_merchant: DataFrame
    dim_date: DataFrame
    fact: DataFrame
    hot: DataFrame | None = None  # ids that hold many rows, see warehouse.hot_ids


@dataclass
class Warehouse:
    fact_transactions: DataFrame
    dim_account: DataFrame
    dim_merchant: DataFrame
    dim_date: DataFrame
    dim_transaction_type: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "fact_transactions": self.fact_transactions,
            "dim_account": self.dim_account,
            "dim_merchant": self.dim_merchant,
            "dim_date": self.dim_date,
            "dim_transaction_type": self.dim_transaction_type,
        }


def enriched(raw: DataFrame, salt: str, strict_types: bool = False) -> DataFrame:
    return enrich(clean(raw, strict_types=strict_types), salt)


def transform(raw: DataFrame, salt: str, strict_types: bool = False) -> Staged:
    return stage(fact_staging(enriched(raw, salt, strict_types)))


def stage(fact: DataFrame) -> Staged:
    """A fact staging and the dimensions derived from it."""
    return Staged(account_dimension(fact), merchant_dimension(fact), date_dimension(fact), fact)


@dataclass
class LoadResult:
    warehouse: Warehouse
    date_inserted: DataFrame
    merchant_affected: DataFrame
    account_changes: DataFrame
    fact_audit: DataFrame


def load_batch(state: Warehouse | None, staged: Staged, batch_ts: str) -> LoadResult:
    """Apply one batch in the reference order: date, merchant, account, fact."""
    spark = staged.fact.sparkSession
    types = state.dim_transaction_type if state else dim_transaction_type(spark)
    dates = W.insert_if_new(state.dim_date if state else None, staged.dim_date, "date_key")
    merchants = W.type1_upsert(state.dim_merchant if state else None, staged.dim_merchant)
    accounts = W.scd2_merge(state.dim_account if state else None, staged.dim_account, batch_ts)
    new_facts = W.resolve_fact(staged.fact, accounts.state, merchants.state, types, batch_ts)
    facts = W.replace_partitions(state.fact_transactions if state else None, new_facts, staged.fact)
    audit = W.load_audit(staged.fact, accounts.state, merchants.state, types,
                         state.fact_transactions if state else None)
    wh = Warehouse(facts, accounts.state, merchants.state, dates.state, types)
    return LoadResult(wh, dates.inserted, merchants.affected, accounts.changes, audit)


def star_from_raw(raw: DataFrame, salt: str, batch_ts: str = DEFAULT_BATCH_TS) -> Warehouse:
    return load_batch(None, transform(raw, salt), batch_ts).warehouse


def star_from_testdata(spark: SparkSession, sf_dir: str, salt: str,
                       batch_ts: str = DEFAULT_BATCH_TS) -> Warehouse:
    """Lazy single-batch warehouse over the events-derived raw rows."""
    return star_from_raw(raw_transactions(spark, sf_dir), salt, batch_ts)
