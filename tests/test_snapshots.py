"""The stored warehouse: what a load writes, crashes at every write, two loads
at once, cut-off manifests, old snapshots and their removal."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from ledgerstar.plans import jobs
from ledgerstar.plans.star import Staged
from ledgerstar.schemas import DIM_ACCOUNT_STAGING, DIM_DATE, DIM_MERCHANT_STAGING, FACT_STAGING
from ledgerstar.sources import snapshots

T1, T2, T3, T4 = (f"2024-0{m}-01 00:00:00" for m in (2, 3, 4, 5))


def account(n):
    return f"{n:032x}"


@pytest.fixture(scope="module")
def dates(spark):
    import datetime as dt
    rows = [(24 * d + h, dt.datetime(2024, 1, 1 + d, h), 24 * d + h + 1, dt.date(2024, 1, 1 + d), h, 1, "Monday", 1, 1, "January", 1, 2024, False) for d in range(3) for h in range(2)]
    return spark.createDataFrame(rows, DIM_DATE)


def staged(spark, dates, accounts, facts, merchants=()):
    """accounts: {n: status}; facts: (originator, day, amount)."""
    import datetime as dt
    a = spark.createDataFrame([(account(n), "Ontario", s) for n, s in accounts.items()], DIM_ACCOUNT_STAGING)
    m = spark.createDataFrame([(account(n), c, "Quebec") for n, c in merchants], DIM_MERCHANT_STAGING)
    f = spark.createDataFrame([(account(n), account(n), None, 24 * d, dt.date(2024, 1, 1 + d), "TRANSFER", float(x), 1.0, None, 0.0, 0.0, False, False, 24 * d + 1)
                               for n, d, x in facts], FACT_STAGING)
    return Staged(a, m, dates, f)


def files(root):
    found = {}
    for d, _, names in os.walk(root):
        for n in names:
            if n.endswith(".parquet"):
                p = os.path.join(d, n)
                found[os.path.relpath(p, root)] = os.stat(p).st_mtime_ns
    return found


def rows(spark, root, number=None):
    wh = jobs.read_warehouse(spark, root, number)
    return {k: sorted(map(str, df.select(sorted(df.columns)).collect())) for k, df in wh.tables().items()}


def test_one_changed_account_writes_one_bucket_and_one_closed_row(spark, tmp_dir, dates):
    root = f"{tmp_dir}/wh"
    everyone = {n: "ACTIVE" for n in range(1000)}
    jobs.run_load(spark, staged(spark, dates, everyone, [(n, 0, n) for n in range(50)]), root, T1, buckets=16)
    jobs.run_load(spark, staged(spark, dates, {**everyone, 5: "DORMANT"}, [(1, 1, 3)]), root, T2)
    before, old = files(root), snapshots.latest(spark, root)
    got = jobs.run_load(spark, staged(spark, dates, {**everyone, 5: "DORMANT", 7: "DORMANT"}, [(1, 2, 4)]), root, T3)
    assert got["accounts"] == {"closed_and_reopened": 1, "inserted_new": 0}
    after, new = files(root), snapshots.latest(spark, root)
    assert {k: after[k] for k in before} == before  # nothing stored is written again
    added = sorted({k.split("/")[0] + "/" + "/".join(p for p in k.split("/")[1:-1] if "bucket=" in p or "partition_date" in p) for k in set(after) - set(before)})
    changed = {b for b in new.parts["dim_account"] if new.parts["dim_account"][b] != old.parts["dim_account"][b]}
    assert len(changed) == 1 and len(new.parts["dim_account"]) == 16
    assert [a for a in added if a.startswith("dim_account/")] == [f"dim_account/bucket={changed.copy().pop()}"]
    assert [a for a in added if a.startswith("fact")] == ["fact_transactions/partition_date=2024-01-03"]
    assert not any(a.startswith("dim_merchant/") for a in added)
    last = set(new.parts[jobs.HISTORY].values()) - set(old.parts[jobs.HISTORY].values())
    assert len(last) == 1 and spark.read.parquet(f"{root}/{last.pop()}").count() == 1
    dim = jobs.read_warehouse(spark, root).dim_account
    assert dim.count() == 1002 and dim.where("is_current").count() == 1000
    assert [(r.account_status, r.is_current) for r in dim.where(F.col("account_id") == account(7)).orderBy("effective_start").collect()] == [("ACTIVE", False), ("DORMANT", True)]
    assert [r.account_id for r in jobs.account_changes(spark, root, new.number).collect()] == [account(7)]


def test_unchanged_batch_writes_facts_only(spark, tmp_dir, dates):
    root = f"{tmp_dir}/wh"
    batch = staged(spark, dates, {1: "ACTIVE"}, [(1, 0, 3)], [(9, "Fuel")])
    jobs.run_load(spark, batch, root, T1)
    a = snapshots.latest(spark, root)
    jobs.run_load(spark, batch, root, T2)
    b = snapshots.latest(spark, root)
    assert {k for k in b.parts if b.parts[k] != a.parts[k]} == {"fact_transactions"}
    jobs.run_load(spark, staged(spark, dates, {}, [], [(9, "Travel"), (10, None)]), root, T3)
    c = snapshots.latest(spark, root)
    assert {k for k in c.parts if c.parts[k] != b.parts[k]} == {"dim_merchant"}
    assert {(r.merchant_id, r.merchant_category) for r in jobs.read_warehouse(spark, root).dim_merchant.collect()} == {(account(9), "Travel"), (account(10), None)}


def test_a_crash_at_any_write_leaves_the_old_snapshot(spark, tmp_dir, dates, monkeypatch):
    root = f"{tmp_dir}/wh"
    jobs.run_load(spark, staged(spark, dates.where("date_key < 24"), {1: "ACTIVE", 2: "ACTIVE"}, [(1, 0, 3), (2, 0, 4)], [(9, "Fuel")]), root, T1)
    old = rows(spark, root)
    batch = staged(spark, dates, {1: "DORMANT", 3: "ACTIVE"}, [(1, 0, 5), (3, 1, 6)], [(9, "Travel")])
    names = [(snapshots, "write"), (snapshots, "write_parts"), (snapshots, "publish")]
    real = {name: getattr(module, name) for module, name in names}

    def crashing(name, at, count):
        def run(*a, **k):
            own = next(count)
            if own == at and name == "publish":
                raise OSError("killed")
            out = real[name](*a, **k)
            if own == at:
                raise OSError("killed")  # written, but nothing after it
            return out
        return run

    at = 0
    while True:
        at += 1
        count = itertools.count(1)
        with monkeypatch.context() as m:
            for module, name in names:
                m.setattr(module, name, crashing(name, at, count))
            try:
                jobs.run_load(spark, batch, root, T2)
            except OSError:
                assert rows(spark, root) == old, at
                continue
        break
    assert at == 9  # dates, merchants and their bucket, account changes, buckets, closed versions, facts, manifest; then it passes
    now = rows(spark, root)
    assert now != old and rows(spark, root, 1) == old
    removed = snapshots.expire(spark, root, keep=5, debris=True)
    assert removed and rows(spark, root) == now and rows(spark, root, 1) == old


def test_two_loads_at_once_and_a_cut_off_manifest(spark, tmp_dir, dates, monkeypatch):
    root = f"{tmp_dir}/wh"
    jobs.run_load(spark, staged(spark, dates, {1: "ACTIVE"}, [(1, 0, 3)]), root, T1)
    real, during = jobs.W.unresolved_counts, []

    def other_load(*a):
        if not during:
            during.append(1)
            jobs.run_load(spark, staged(spark, dates, {2: "ACTIVE"}, [(2, 1, 4)]), root, T2)
        return real(*a)

    with monkeypatch.context() as m:
        m.setattr(jobs.W, "unresolved_counts", other_load)
        with pytest.raises(snapshots.LoadConflict):
            jobs.run_load(spark, staged(spark, dates, {3: "ACTIVE"}, [(3, 1, 9)]), root, T2)
    now = rows(spark, root)
    assert len(now["dim_account"]) == 2 and len(now["fact_transactions"]) == 2
    with open(f"{root}/{snapshots.MANIFESTS}/0000000003.json", "w") as f:
        f.write('{"number": 3, "parts"')
    assert rows(spark, root) == now
    jobs.run_load(spark, staged(spark, dates, {3: "ACTIVE"}, [(3, 2, 9)]), root, T3)
    assert snapshots.latest(spark, root).number == 4 and len(rows(spark, root)["fact_transactions"]) == 3


def test_expired_snapshots_and_pruned_days(spark, tmp_dir, dates):
    root = f"{tmp_dir}/wh"
    for k, ts in enumerate((T1, T2, T3, T4)):
        jobs.run_load(spark, staged(spark, dates, {1: "ACTIVE"}, [(1, 0, k), (1, 1, k)] if k != 2 else [(1, 2, k)]), root, ts, keep=2)
    assert snapshots.numbers(spark, root) == [3, 4]
    kept = {p for n in (3, 4) for p in snapshots.read(spark, root, n).folders()}
    assert {os.path.dirname(f) for f in files(root)} == {os.path.normpath(p) for p in kept if files(f"{root}/{p}")}
    with pytest.raises(FileNotFoundError):
        jobs.read_warehouse(spark, root, 1)
    assert [float(r.amount) for r in jobs.read_warehouse(spark, root, 3).fact_transactions.orderBy("date_key").collect()] == [1.0, 1.0, 2.0]
    fact = jobs.read_warehouse(spark, root).fact_transactions
    assert [float(r.amount) for r in fact.orderBy("date_key").collect()] == [3.0, 3.0, 2.0]
    one = fact.where("partition_date = '2024-01-03'")
    assert "PartitionFilters: [isnotnull(partition_date" in one._jdf.queryExecution().simpleString()
    assert len(one.inputFiles()) >= 1 and one.count() == 1
