"""One originator holding a third of all rows: results must equal the
textbook window formulations, and no plan may sort that account's rows in
one task."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerstar.plans import analytics
from ledgerstar.plans.sqlviews import register_views
from ledgerstar.plans.star import star_from_raw
from ledgerstar.schemas import RAW_SCHEMA


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    types = ["PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT"]
    rows = []
    for i in range(3000):
        orig = "C0" if i % 3 == 0 else f"C{rnd.randint(1, 200)}"
        t = rnd.choice(types)
        dest = f"M{rnd.randint(1, 30)}" if t == "PAYMENT" else f"C{rnd.randint(1, 300)}"
        amount = float(rnd.choice([5, 10, 10, 99.99, 250, 1000])) + i / 100.0
        fraud = 1 if t in ("TRANSFER", "CASH_OUT") and i % 41 == 0 else 0
        rows.append((1 + i % 720, t, amount, orig, 0.0, 0.0, dest, 0.0, 0.0, fraud, 0))
    wh = star_from_raw(spark.createDataFrame(rows, RAW_SCHEMA), "salt")
    register_views(wh, prefix="sk_")
    return wh


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_largest_txn_equals_row_number(spark, skewed):
    ref = spark.sql("""
        WITH r AS (
            SELECT a.account_id, a.region, t.type_code, f.amount,
                   ROW_NUMBER() OVER (PARTITION BY f.orig_account_key
                                      ORDER BY f.amount DESC, t.type_code) AS rn
            FROM sk_fact_transactions f
            JOIN sk_dim_account a ON a.account_key = f.orig_account_key
            JOIN sk_dim_transaction_type t ON t.transaction_type_key = f.transaction_type_key)
        SELECT account_id, region, type_code, CAST(ROUND(amount, 2) AS DOUBLE) AS largest_txn
        FROM r WHERE rn = 1 ORDER BY amount DESC, account_id, type_code LIMIT 20""")
    mine = analytics.q3_4_largest_txn(skewed)
    assert _rows(mine) == _rows(ref)
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_regions_equal_direct_join(spark, skewed):
    ref = spark.sql("""
        SELECT a.region, COUNT(DISTINCT a.account_key) AS accounts, COUNT(*) AS txns,
               CAST(ROUND(SUM(f.amount), 2) AS DOUBLE) AS total_value
        FROM sk_fact_transactions f JOIN sk_dim_account a ON a.account_key = f.orig_account_key
        GROUP BY a.region""")
    mine = analytics.q3_3_regions(skewed).select("region", "accounts", "txns", "total_value")
    assert _rows(mine) == _rows(ref)


def test_top_accounts_equal_rank(spark, skewed):
    ref = spark.sql("""
        WITH g AS (
            SELECT a.region, a.account_id, SUM(f.amount) AS v, COUNT(*) AS txns
            FROM sk_fact_transactions f JOIN sk_dim_account a ON a.account_key = f.orig_account_key
            GROUP BY a.region, a.account_id),
        r AS (SELECT *, RANK() OVER (PARTITION BY region ORDER BY v DESC) AS rk FROM g)
        SELECT region, CAST(rk AS BIGINT) AS rank_in_region, account_id,
               CAST(ROUND(v, 2) AS DOUBLE) AS total_value, txns
        FROM r WHERE rk <= 3""")
    assert _rows(analytics.q4_3_top_accounts(skewed)) == _rows(ref)


def test_hot_account_is_ranked_first(spark, skewed):
    top = analytics.q3_2_deciles(skewed).filter(F.col("value_decile") == 1).first()
    assert top["accounts"] >= 1 and top["pct_of_total_value"] > 30.0
