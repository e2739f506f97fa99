"""Exact rounding, versioned accounts, safe publishing, day replacement, keys
and constraints on load, and several drops for one day."""

import os
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from ledgerstar.functions.numeric import avg_half_up, pct
from ledgerstar.operators import quality as Q
from ledgerstar.operators import warehouse as W
from ledgerstar.operators.clean import clean_report
from ledgerstar.operators.dimensions import dim_transaction_type
from ledgerstar.plans import analytics, jobs
from ledgerstar.plans.star import Warehouse, star_from_raw
from ledgerstar.schemas import DIM_ACCOUNT, DIM_DATE, DIM_MERCHANT, FACT_TRANSACTIONS, RAW_COLUMNS, RAW_SCHEMA
from ledgerstar.sources import sinks, snapshots
from ledgerstar.sources.raw import write_raw_csv
from ledgerstar.streaming.incremental import start_incremental

SF = "/root/testdata/sf0.001"
T1, T2, T3 = "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"


def raw_row(step, orig, dest, amount=10.0, kind="TRANSFER", before=5.0, after=None, fraud=0):
    row = {"step": step, "type": kind, "amount": amount, "nameOrig": orig, "oldbalanceOrg": before, "newbalanceOrig": after,
           "nameDest": dest, "oldbalanceDest": 0.0, "newbalanceDest": 0.0, "isFraud": fraud, "isFlaggedFraud": 0}
    return tuple(row[c] for c in RAW_COLUMNS)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_SCHEMA)


def test_ratios_round_half_up_once(spark):
    cases = [("15000.00", 3000001), ("0.01", 2), ("-0.01", 2), ("1.005", 1), ("7.00", 0), ("99999999999999.99", 7), ("0.00", 5), ("2.50", 1000), ("-1.00", 3)]
    df = spark.createDataFrame([(Decimal(t).quantize(Decimal("0.01")), n) for t, n in cases], "t decimal(20,2), n long")
    got = df.select(avg_half_up(F.col("t"), F.col("n"), 2), pct(F.col("t"), F.col("n"), 1)).collect()
    with localcontext() as ctx:
        ctx.prec = 60
        for (t, n), r in zip(cases, got):
            t = Decimal(t).quantize(Decimal("0.01"))
            if n == 0:
                assert r[0] is None and r[1] is None
                continue
            assert r[0] == pytest.approx(float((t / n).quantize(Decimal("0.01"), ROUND_HALF_UP)), abs=1e-9, rel=1e-15)
            assert r[1] == pytest.approx(float((100 * t / n).quantize(Decimal("0.1"), ROUND_HALF_UP)), abs=1e-9, rel=1e-15)
    assert got[0][0] == 0.0  # 0.004999998, which a quotient of six places carries to 0.01


def test_fraud_accounts_count_all_versions(spark):
    accounts = W.scd2_merge(None, spark.createDataFrame([("a", "Ontario", "ACTIVE"), ("b", "Quebec", "ACTIVE")], "account_id string, region string, account_status string"), T1).state
    accounts = W.scd2_merge(accounts, spark.createDataFrame([("a", "Ontario", "DORMANT")], "account_id string, region string, account_status string"), T2).state
    keys = {(r.account_id, r.is_current): r.account_key for r in accounts.collect()}
    rows = [(keys["a", False], True, 10), (keys["a", False], False, 1), (keys["a", True], False, 2), (keys["a", True], False, 3), (keys["a", True], False, 4), (keys["b", True], False, 9)]
    fact = spark.createDataFrame(rows, "orig_account_key string, is_fraud boolean, amount int").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    got = analytics.q2_5_fraud_accounts(Warehouse(fact, accounts, None, None, None)).collect()
    assert [(r.account_id, r.fraud_txns, r.fraud_value, r.total_txns, r.exposure_rank) for r in got] == [("a", 1, 10.0, 5, 1)]


def test_failed_or_interrupted_transform_is_refused(spark, tmp_dir, monkeypatch):
    out = f"{tmp_dir}/staging"
    good = raw(spark, raw_row(1, "C1", "C2"))
    jobs.run_transform(good, out, "salt")
    assert jobs.read_staged(spark, out).fact.count() == 1
    for broken in ("assert_ok", "validate_staging"):
        with monkeypatch.context() as m:
            m.setattr(Q, broken, lambda *a: (_ for _ in ()).throw(ValueError("validation failed")))
            with pytest.raises(ValueError):
                jobs.run_transform(raw(spark, raw_row(1, "C1", "C2"), raw_row(2, "C3", "C2")), out, "salt")
        with pytest.raises(FileNotFoundError):
            jobs.read_staged(spark, out)
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_dimension", lambda *a, **k: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            jobs.run_transform(good, out, "salt")
    with pytest.raises(FileNotFoundError):
        jobs.read_staged(spark, out)


def test_empty_and_unresolved_batches_count_zero(spark, tmp_dir):
    r = jobs.run_transform(raw(spark, raw_row(0, "C1", "C2"), raw_row(1, "C1", "C2", kind="BOGUS")), f"{tmp_dir}/none", "salt")
    assert r["rows_in"] == 2 and r["rows_out"] == 0 and r["dropped_bad_step"] == 1 and r["dropped_bad_type"] == 1
    got = jobs.run_load(spark, jobs.read_staged(spark, f"{tmp_dir}/none"), f"{tmp_dir}/wh", T1)
    assert got["fact"] == {"staged": 0, "unresolved_type": 0, "unresolved_account": 0, "inserted": 0, "fan_out": 0, "deleted": 0}
    jobs.run_transform(raw(spark, raw_row(1, "C1", "C2")), f"{tmp_dir}/one", "salt")
    staged = jobs.read_staged(spark, f"{tmp_dir}/one")
    staged.dim_account = staged.dim_account.limit(0)
    got = jobs.run_load(spark, staged, f"{tmp_dir}/wh2", T1)
    assert got["fact"]["unresolved_account"] == 1 and got["fact"]["inserted"] == 0


def test_unresolved_day_is_replaced_and_counted(spark, tmp_dir):
    wh = f"{tmp_dir}/wh"
    rows = [raw_row(1, "C1", "C2"), raw_row(2, "C1", "C3"), raw_row(30, "C1", "C2"), raw_row(60, "C4", "C2")]
    jobs.run_transform(raw(spark, *rows), f"{tmp_dir}/s1", "salt")
    first = jobs.run_load(spark, jobs.read_staged(spark, f"{tmp_dir}/s1"), wh, T1)
    assert first["fact"]["inserted"] == 4 and first["fact"]["deleted"] == 0
    jobs.run_transform(raw(spark, raw_row(1, "C9", "C2"), raw_row(30, "C1", "C2", amount=7.0)), f"{tmp_dir}/s2", "salt")
    staged = jobs.read_staged(spark, f"{tmp_dir}/s2")
    own = staged.fact.where("amount = 10.0").select(F.col("orig_account_id").alias("account_id"))
    staged.dim_account = staged.dim_account.join(own, "account_id", "left_anti")  # day 1 cannot be resolved
    second = jobs.run_load(spark, staged, wh, T2)
    assert second["fact"] == {"staged": 2, "unresolved_type": 0, "unresolved_account": 1, "inserted": 1, "fan_out": 0, "deleted": 3}
    left = {(str(r.partition_date), float(r.amount)) for r in jobs.read_warehouse(spark, wh).fact_transactions.collect()}
    assert left == {("2024-01-02", 7.0), ("2024-01-03", 10.0)}


def test_duplicated_current_account_is_reported_as_fan_out(spark):
    acct = W.scd2_merge(None, spark.createDataFrame([("a", None, "ACTIVE")], "account_id string, region string, account_status string"), T1).state
    merch = W.type1_upsert(None, spark.createDataFrame([], "merchant_id string, merchant_category string, region string")).state
    staging = spark.createDataFrame([("a", "a", None, 1, "TRANSFER", 1.0)], "orig_account_id string, dest_account_id string, dest_merchant_id string, date_key long, type_code string, amount double")
    staging = staging.withColumn("partition_date", F.lit("2024-01-01").cast("date"))
    for n, dim in ((1, acct), (4, acct.union(acct))):
        audit = W.load_audit(staging, dim, merch, dim_transaction_type(spark)).first()
        assert (audit.staged, audit.inserted, audit.fan_out) == (1, n, n - 1)


def test_keys_tell_null_columns_apart(spark):
    df = spark.createDataFrame([(5.0, None), (None, 5.0), (None, None), (5.0, 5.0)], "a double, b double")
    keys = [r[0] for r in df.select(W.wide_key(F.col("a"), F.col("b"))).collect()]
    assert len(set(keys)) == 4 and all(len(k) == 32 for k in keys)
    pairs = spark.createDataFrame([("1", "1:1"), ("1,1:1", ""), ("", "1,1:1"), ("-", None)], "a string, b string")
    assert pairs.select(W.wide_key(F.col("a"), F.col("b"))).distinct().count() == 4


def test_facts_that_differ_by_null_balances_get_two_keys(spark):
    wh = star_from_raw(raw(spark, raw_row(1, "C1", "C2", before=5.0, after=None), raw_row(1, "C1", "C2", before=None, after=5.0)), "salt", T1)
    assert wh.fact_transactions.select("transaction_key").distinct().count() == 2


def test_type2_merge_is_one_join(spark):
    acct = spark.createDataFrame([("a", "Ontario", "ACTIVE")], "account_id string, region string, account_status string")
    state = W.scd2_merge(W.scd2_merge(None, acct, T1).state, acct, T2).state
    assert state._jdf.queryExecution().optimizedPlan().toString().count("Join FullOuter") == 1


def test_batches_come_in_order(spark, tmp_dir):
    jobs.run_transform(raw(spark, raw_row(1, "C1", "C2")), f"{tmp_dir}/s", "salt")
    staged = jobs.read_staged(spark, f"{tmp_dir}/s")
    jobs.run_load(spark, staged, f"{tmp_dir}/wh", T2)
    with pytest.raises(ValueError, match="earlier"):
        jobs.run_load(spark, staged, f"{tmp_dir}/wh", T1)
    again = jobs.run_load(spark, staged, f"{tmp_dir}/wh", T2)  # an exact replay
    assert again["fact"]["inserted"] == 1 and again["fact"]["deleted"] == 1
    staged.dim_account = staged.dim_account.withColumn("account_status", F.lit("DORMANT"))
    with pytest.raises(Exception, match="not later"):
        jobs.run_load(spark, staged, f"{tmp_dir}/wh", T2)
    assert jobs.read_warehouse(spark, f"{tmp_dir}/wh").dim_account.where("account_status = 'DORMANT'").count() == 0


def test_refused_constraints_publish_nothing(spark, tmp_dir):
    jobs.run_transform(raw(spark, raw_row(1, "C1", "C2")), f"{tmp_dir}/s", "salt")
    wh = f"{tmp_dir}/wh"
    jobs.run_load(spark, jobs.read_staged(spark, f"{tmp_dir}/s"), wh, T1)
    before = {k: sorted(map(str, df.collect())) for k, df in jobs.read_warehouse(spark, wh).tables().items()}
    changes = {
        "hour_of_day": lambda s: setattr(s, "dim_date", s.dim_date.withColumn("hour_of_day", F.lit(25)).withColumn("date_key", F.col("date_key") + 1)),
        "negative": lambda s: setattr(s, "fact", s.fact.withColumn("amount", F.lit(-1.0))),
        "twice": lambda s: setattr(s, "fact", s.fact.union(s.fact)),
        "no date": lambda s: setattr(s, "fact", s.fact.withColumn("date_key", F.lit(99).cast("long"))),
        "null amount": lambda s: setattr(s, "fact", s.fact.withColumn("amount", F.lit(None).cast("double"))),
        "both destinations": lambda s: setattr(s, "fact", s.fact.withColumn("dest_account_id", F.lit(None).cast("string"))),
    }
    for name, change in changes.items():
        staged = jobs.read_staged(spark, f"{tmp_dir}/s")
        change(staged)
        with pytest.raises(ValueError, match="validation failed"):
            jobs.run_load(spark, staged, wh, T2)
        after = {k: sorted(map(str, df.collect())) for k, df in jobs.read_warehouse(spark, wh).tables().items()}
        assert after == before, name


def test_schemas_of_written_tables(spark, tmp_dir):
    jobs.run_transform(raw(spark, raw_row(1, "C1", "M2", kind="PAYMENT")), f"{tmp_dir}/s", "salt")
    jobs.run_load(spark, jobs.read_staged(spark, f"{tmp_dir}/s"), f"{tmp_dir}/wh", T1)
    wh = jobs.read_warehouse(spark, f"{tmp_dir}/wh")
    for df, schema in ((wh.dim_account, DIM_ACCOUNT), (wh.dim_merchant, DIM_MERCHANT), (wh.dim_date, DIM_DATE), (wh.fact_transactions, FACT_TRANSACTIONS)):
        assert {(f.name, f.dataType) for f in df.schema} == {(f.name, f.dataType) for f in schema}


def test_drops_for_one_day_keep_every_row_and_append(spark, tmp_dir):
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/run"

    def run(name, *rows):
        if rows:
            write_raw_csv(raw(spark, *rows).coalesce(1), f"{src}/{name}")
        q = start_incremental(spark, src, root, "salt", glob="*.csv", max_files_per_trigger=1)
        q.awaitTermination()
        assert q.exception() is None

    def days():
        return {str(r[0]): r[1] for r in jobs.read_warehouse(spark, f"{root}/warehouse").fact_transactions.groupBy("partition_date").count().collect()}

    def written():
        return {p for p in snapshots.latest(spark, f"{root}/warehouse").parts["fact_transactions"].values()}

    run("a", raw_row(1, "C1", "C2"), raw_row(2, "C1", "C3"), raw_row(30, "C1", "C2"))
    first = written()
    run("b", raw_row(3, "C4", "C2"), raw_row(2, "C1", "C3"), raw_row(900, "C4", "C2"))
    assert days() == {"2024-01-01": 3, "2024-01-02": 1}
    assert first < written() and len(written()) == 3  # one more folder of the day, nothing rewritten
    run("none")  # nothing new
    run("c", raw_row(900, "C4", "C2"))  # nothing that can be loaded
    assert days() == {"2024-01-01": 3, "2024-01-02": 1}
    rejected = spark.read.parquet(f"{root}/rejected")
    assert sorted((r.nameOrig, r.rejected_by) for r in rejected.collect()) == [("C4", "bad_step")] * 2
    assert not os.path.exists(f"{root}/landing") and not os.listdir(f"{root}/staging")


def test_append_leaves_out_stored_rows_and_a_load_replaces_all_parts(spark, tmp_dir):
    wh = f"{tmp_dir}/wh"

    def load(name, ts, *rows, **more):
        jobs.run_transform(raw(spark, *rows), f"{tmp_dir}/{name}", "salt")
        return jobs.run_load(spark, jobs.read_staged(spark, f"{tmp_dir}/{name}"), wh, ts, **more)["fact"]

    a, b, c = raw_row(1, "C1", "C2"), raw_row(1, "C3", "C2"), raw_row(5, "C1", "C2", amount=2.0)
    assert load("s1", T1, a, append=True)["already_stored"] == 0
    got = load("s2", T2, a, b, c, append=True)
    assert (got["staged"], got["inserted"], got["already_stored"], got["deleted"]) == (2, 2, 1, 0)
    again = load("s3", T2, a, b, c, append=True)
    assert (again["inserted"], again["already_stored"]) == (0, 3)
    assert jobs.read_warehouse(spark, wh).fact_transactions.count() == 3
    assert load("s4", T3, c)["deleted"] == 3
    assert [float(r.amount) for r in jobs.read_warehouse(spark, wh).fact_transactions.collect()] == [2.0]


def test_rejected_rows_stay_and_count_like_the_report(spark, tmp_dir):
    rows = [raw_row(1, "C1", "C2"), raw_row(1, "C1", "C2"), raw_row(0, "C1", "C2"), raw_row(1, " ", "C2", amount=-1.0), raw_row(2, "C1", "", kind="BOGUS"),
            raw_row(3, "C1", "C2", amount=float("nan")), raw_row(3, " C1", "C2"), raw_row(4, "C1", "C2", kind="cash-in"), raw_row(4, "C1", "C2", kind="BOGUS")]
    for strict in (False, True):
        out = f"{tmp_dir}/{strict}"
        report = jobs.run_transform(raw(spark, *rows), out, "salt", strict_types=strict)
        want = clean_report(raw(spark, *rows), strict).first().asDict()
        assert {k: report[k] for k in want} == want
        rejected = jobs.read_rejected(spark, out)
        by_rule = {r[0]: r[1] for r in rejected.groupBy("rejected_by").count().collect()}
        assert by_rule == {k[8:]: v for k, v in want.items() if k.startswith("dropped_") and k != "dropped_duplicates" and v}
        assert rejected.columns[:11] == RAW_COLUMNS
        assert os.listdir(f"{out}/rows") and not any("accepted" in d for d in os.listdir(f"{out}/rows"))
