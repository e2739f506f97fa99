import pytest
from pyspark.sql import functions as F

from ledgerstar.operators import warehouse as W
from ledgerstar.operators.dimensions import dim_transaction_type

T1, T2, T3 = "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"
ACCT = "account_id string, region string, account_status string"


def _acc(spark, rows):
    return spark.createDataFrame(rows, ACCT)


def _history(spark):
    b1 = _acc(spark, [("a", "Ontario", "ACTIVE"), ("b", "Quebec", "ACTIVE"), ("c", None, "ACTIVE")])
    s1 = W.scd2_merge(None, b1, T1).state
    b2 = _acc(spark, [("a", "Prairies", "ACTIVE"), ("b", "Quebec", "ACTIVE"), ("c", None, "DORMANT"),
                      ("d", "Alberta", "ACTIVE")])
    r2 = W.scd2_merge(s1, b2, T2)
    return s1, b2, r2


def test_scd2_versions(spark):
    _, _, r2 = _history(spark)
    rows = {(r["account_id"], r["is_current"]): r for r in r2.state.collect()}
    assert len(r2.state.collect()) == 6
    assert rows[("a", False)]["region"] == "Ontario"
    assert str(rows[("a", False)]["effective_end"]) == "2024-03-01 00:00:00"
    assert rows[("a", True)]["region"] == "Prairies"
    assert rows[("a", True)]["effective_start"] == rows[("a", False)]["effective_end"]
    assert ("b", False) not in rows  # unchanged
    assert rows[("c", True)]["account_status"] == "DORMANT" and rows[("c", True)]["region"] is None
    rep = W.change_report(r2.changes).first()
    assert rep["closed_and_reopened"] == 2 and rep["inserted_new"] == 1


def test_scd2_invariants_and_rerun(spark):
    _, b2, r2 = _history(spark)
    again = W.scd2_merge(r2.state, b2, T3)
    assert W.change_report(again.changes).first().asDict() == {"closed_and_reopened": 0, "inserted_new": 0}
    key = ["account_id", "region", "account_status", "effective_start", "effective_end", "is_current"]
    assert sorted(map(tuple, again.state.select(key).collect()), key=str) == \
        sorted(map(tuple, r2.state.select(key).collect()), key=str)
    st = again.state
    assert st.filter("is_current").groupBy("account_id").count().filter("count > 1").count() == 0
    # every closed version ends where the next version of the account starts
    closed = st.filter(~F.col("is_current")).select("account_id", F.col("effective_end").alias("t"))
    opened = st.select("account_id", F.col("effective_start").alias("t"))
    assert closed.join(opened, ["account_id", "t"], "left_anti").count() == 0
    assert st.select("account_key").distinct().count() == st.count()


def test_closed_versions_never_change(spark):
    _, _, r2 = _history(spark)
    b3 = _acc(spark, [("a", "Quebec", "ACTIVE"), ("b", "Quebec", "DORMANT")])
    r3 = W.scd2_merge(r2.state, b3, T3)
    key = ["account_id", "region", "account_status", "effective_start", "effective_end"]
    closed2 = {tuple(r) for r in r2.state.filter("NOT is_current").select(key).collect()}
    closed3 = {tuple(r) for r in r3.state.filter("NOT is_current").select(key).collect()}
    assert closed2 <= closed3 and len(closed3 - closed2) == 2
    assert r3.state.filter("is_current").groupBy("account_id").count().filter("count > 1").count() == 0


def test_scd2_absent_accounts_stay_current(spark):
    s1, _, _ = _history(spark)
    r = W.scd2_merge(s1, _acc(spark, [("a", "Ontario", "ACTIVE")]), T2)
    assert r.state.filter("is_current").count() == 3


def test_scd2_refuses_duplicate_keys(spark):
    dup = _acc(spark, [("a", "Ontario", "ACTIVE"), ("a", "Quebec", "ACTIVE")])
    with pytest.raises(Exception):
        W.scd2_merge(None, dup, T1).state.collect()


def test_type1_upsert_overwrites_with_null_and_keeps_key(spark):
    cur = W.type1_upsert(None, spark.createDataFrame(
        [("m1", "Fuel", "Ontario"), ("m2", "Retail", "Quebec")],
        "merchant_id string, merchant_category string, region string")).state
    keys = {r["merchant_id"]: r["merchant_key"] for r in cur.collect()}
    new = W.type1_upsert(cur, spark.createDataFrame(
        [("m1", "Travel", None), ("m3", "Fuel", "Alberta")],
        "merchant_id string, merchant_category string, region string"))
    rows = {r["merchant_id"]: r for r in new.state.collect()}
    assert rows["m1"]["merchant_category"] == "Travel" and rows["m1"]["region"] is None
    assert rows["m1"]["merchant_key"] == keys["m1"]
    assert rows["m2"]["merchant_category"] == "Retail"
    assert len(rows) == 3 and new.affected.count() == 2


def test_insert_if_new(spark):
    cur = spark.createDataFrame([(1, "x")], "date_key long, v string")
    r = W.insert_if_new(cur, spark.createDataFrame([(1, "changed"), (2, "y")], "date_key long, v string"),
                        "date_key")
    got = {row["date_key"]: row["v"] for row in r.state.collect()}
    assert got == {1: "x", 2: "y"} and r.inserted.count() == 1


def test_replace_partitions(spark):
    old = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "partition_date string, v int")
    new = spark.createDataFrame([("2024-01-02", 20), ("2024-01-02", 21)], "partition_date string, v int")
    got = sorted(tuple(r) for r in W.replace_partitions(old, new).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 20), ("2024-01-02", 21)]


def test_fact_resolution_and_audit_conservation(spark):
    acct = W.scd2_merge(None, _acc(spark, [("a", "Ontario", "ACTIVE"), ("b", "Quebec", "ACTIVE")]), T1).state
    merch = W.type1_upsert(None, spark.createDataFrame(
        [("m1", "Fuel", "Ontario")], "merchant_id string, merchant_category string, region string")).state
    types = dim_transaction_type(spark)
    cols = ("orig_account_id string, dest_account_id string, dest_merchant_id string, date_key long, "
            "partition_date date, type_code string, amount double, balance_before_orig double, "
            "balance_after_orig double, balance_before_dest double, balance_after_dest double, "
            "is_fraud boolean, is_flagged_by_system boolean, source_step int")
    import datetime as dt
    d = dt.date(2024, 1, 1)
    staging = spark.createDataFrame([
        ("a", None, "m1", 2024010100, d, "PAYMENT", 1.005, None, None, None, None, False, False, 1),
        ("a", "b", None, 2024010100, d, "TRANSFER", 2.0, float("nan"), 0.0, 0.0, 2.0, True, False, 1),
        ("zz", "b", None, 2024010100, d, "TRANSFER", 3.0, 0.0, 0.0, 0.0, 3.0, False, False, 1),
        ("a", "b", None, 2024010100, d, "BOGUS", 4.0, 0.0, 0.0, 0.0, 4.0, False, False, 1),
    ], cols)
    fact = W.resolve_fact(staging, acct, merch, types, T1)
    rows = fact.collect()
    assert len(rows) == 2
    by_type = {r["transaction_type_key"]: r for r in rows}
    assert str(by_type[4]["amount"]) == "1.01"  # half-up to cents
    assert by_type[5]["balance_before_orig"] is None  # NaN -> NULL
    assert by_type[4]["dest_merchant_key"] is not None and by_type[4]["dest_account_key"] is None
    audit = W.load_audit(staging, acct, merch, types).first()
    assert audit["staged"] == 4 and audit["inserted"] == 2
    assert audit["unresolved_type"] == 1 and audit["unresolved_account"] == 1
    assert audit["staged"] == audit["inserted"] + audit["unresolved_type"] + audit["unresolved_account"]
