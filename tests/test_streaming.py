import os

import pytest
from pyspark.sql import functions as F

from ledgerstar.plans import analytics, jobs
from ledgerstar.plans.star import star_from_raw
from ledgerstar.sources.raw import raw_transactions, write_raw_csv
from ledgerstar.streaming.incremental import start_incremental

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_two_drops_then_nothing_new(spark, tmp_dir):
    raw = raw_transactions(spark, SF)
    early = raw.filter(F.col("step") <= 15 * 24)
    late = raw.filter(F.col("step") > 15 * 24)
    src, root = f"{tmp_dir}/landing", f"{tmp_dir}/run"

    def run_available_now():
        q = start_incremental(spark, src, root, "salt", fmt="csv", glob="*.csv")
        q.awaitTermination()
        assert q.exception() is None
        return len([p for p in q.recentProgress if p["numInputRows"] > 0])

    write_raw_csv(early, f"{src}/drop1")
    assert run_available_now() == 1
    n1 = jobs.read_warehouse(spark, f"{root}/warehouse").fact_transactions.count()
    write_raw_csv(late, f"{src}/drop2")
    assert run_available_now() == 1
    assert run_available_now() == 0  # nothing new: no batch, same state

    wh = jobs.read_warehouse(spark, f"{root}/warehouse")
    assert wh.fact_transactions.count() > n1
    batch = star_from_raw(raw, "salt")
    assert analytics.q1_3_type_mix(wh).collect() == analytics.q1_3_type_mix(batch).collect()
    assert analytics.q3_3_regions(wh).collect() == analytics.q3_3_regions(batch).collect()
