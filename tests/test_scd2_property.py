"""Random batch sequences through the type-2 merge; invariants after each."""

import random

from pyspark.sql import functions as F

from ledgerstar.operators import warehouse as W

REGIONS = ["Ontario", "Quebec", None]
STATUS = ["ACTIVE", "DORMANT"]


def _check(state_rows, expected_current, closed_before):
    by_acct = {}
    for r in state_rows:
        by_acct.setdefault(r["account_id"], []).append(r)
    assert set(by_acct) == set(expected_current)
    closed_now = set()
    for acct, versions in by_acct.items():
        cur = [v for v in versions if v["is_current"]]
        assert len(cur) == 1, acct
        assert cur[0]["effective_end"] is None
        assert (cur[0]["region"], cur[0]["account_status"]) == expected_current[acct]
        ordered = sorted(versions, key=lambda v: v["effective_start"])
        for a, b in zip(ordered, ordered[1:]):
            assert a["effective_end"] == b["effective_start"]  # no gap, no overlap
            assert not a["is_current"]
        for v in versions:
            if not v["is_current"]:
                closed_now.add((acct, v["region"], v["account_status"], v["effective_start"],
                                v["effective_end"]))
    assert closed_before <= closed_now  # closed versions never change
    return closed_now


def test_random_batches_keep_type2_invariants(spark):
    rnd = random.Random(17)
    accounts = [f"a{i}" for i in range(12)]
    state, expected, closed = None, {}, set()
    for b in range(5):
        batch = rnd.sample(accounts, rnd.randint(3, len(accounts)))
        rows = [(a, rnd.choice(REGIONS), rnd.choice(STATUS)) for a in batch]
        ts = f"2024-0{b + 1}-15 00:00:00"
        res = W.scd2_merge(state, spark.createDataFrame(
            rows, "account_id string, region string, account_status string"), ts)
        state = res.state.checkpoint(eager=True)
        changes = {r["account_id"]: r["action"] for r in res.changes.collect()}
        for a, reg, st in rows:
            if a not in expected:
                assert changes.get(a) == "inserted_new"
            elif expected[a] != (reg, st):
                assert changes.get(a) == "closed_and_reopened"
            else:
                assert a not in changes
            expected[a] = (reg, st)
        closed = _check(state.collect(), expected, closed)
        assert state.select("account_key").distinct().count() == state.count()
        assert state.filter(F.col("effective_start") == F.lit(ts).cast("timestamp_ntz")).count() == \
            len(changes)
