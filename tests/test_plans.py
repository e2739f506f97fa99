"""Plan shape checks: the properties that matter at scale."""

import os

import pytest

from ledgerstar.plans import analytics, extras, jobs
from ledgerstar.sources.raw import raw_transactions

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def wh(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="ledgerstar-plan-")
    jobs.run_transform(raw_transactions(spark, SF), f"{root}/staging", "salt")
    jobs.run_load(spark, jobs.read_staged(spark, f"{root}/staging"), f"{root}/wh",
                  "2024-02-01 00:00:00")
    return jobs.read_warehouse(spark, f"{root}/wh")


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_inputs(plan: str):
    """The operators between each single-partition exchange and the next
    exchange or scan below it (the work that feeds the single task)."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = []
            for nxt in lines[i + 1:]:
                below.append(nxt)
                if any(m in nxt for m in ("Exchange", "Scan", "QueryStage", "InMemoryTableScan")):
                    break
            yield "\n".join(below)


@pytest.mark.parametrize("name", sorted(analytics.QUERIES))
def test_single_partition_only_over_aggregates(spark, wh, name):
    """A window or sort without PARTITION BY may only see an aggregate's
    output (hours, days, types, deciles), never rows per account or fact."""
    plan = _final_plan(analytics.QUERIES[name](wh))
    for below in _single_partition_inputs(plan):
        assert "HashAggregate" in below or "ObjectHashAggregate" in below, (name, below)


def test_top_per_region_uses_window_group_limit(spark, wh):
    plan = _final_plan(analytics.q4_3_top_accounts(wh))
    assert "WindowGroupLimit" in plan


def test_recent_days_prune_fact_partitions(spark, wh):
    df = extras.x5_account_recent(wh, wh.dim_account.select("account_id").orderBy("account_id").limit(1))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    fact_scans = [line for line in plan.splitlines()
                  if "FileScan" in line and "fact_transactions" in line]
    assert fact_scans
    for line in fact_scans:
        pf = line.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
        assert "partition_date" in pf and "date_sub" in pf, line


def test_scan_reads_only_needed_columns(spark, wh):
    plan = analytics.q1_3_type_mix(wh)._jdf.queryExecution().executedPlan().toString()
    read = [line for line in plan.splitlines() if "ReadSchema" in line or "FileScan" in line]
    fact_scans = [line for line in read if "transaction_type_key" in line and "amount" in line]
    assert fact_scans and all("balance_before_orig" not in line for line in fact_scans)
