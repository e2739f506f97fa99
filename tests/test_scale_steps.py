"""Steps that must not cost more than their input: the raw rows are read in
one pass, a batch that is loaded twice is staged once, and dimensions that
grow do not travel through the driver."""

import datetime

from pyspark.sql import functions as F

from ledgerstar.operators import warehouse as W
from ledgerstar.operators.clean import clean
from ledgerstar.plans import jobs, scenario
from ledgerstar.plans.scenario import written_staging
from ledgerstar.plans.star import transform
from ledgerstar.sources.raw import events_as_transactions, raw_transactions, with_defects

KINDS = ["click", "view", "signup", "purchase", "error"]


def _events(spark, n=400):
    rows = [(i if i else None, datetime.datetime(2024, 1, 1 + i % 31, i % 24), None if i % 37 == 3 else i % 40, KINDS[i % 5], 0.25 * i, f'{{"k": {i % 9}}}') for i in range(n)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_rows_are_read_once_and_rules_see_finished_columns(spark, tmp_dir):
    _events(spark).write.parquet(f"{tmp_dir}/events.parquet")
    plan = _plan(clean(raw_transactions(spark, tmp_dir)))
    assert plan.split("+- == Initial Plan")[0].count("Scan parquet") == 1
    below = plan[plan.index("Generate"):]
    assert "get_json_object" in below and "regexp_replace(upper" not in below


def test_defects_repeat_every_fiftieth_row(spark):
    mapped = events_as_transactions(_events(spark), keep_event_id=True)
    got = {r[0]: r[1] for r in with_defects(mapped).groupBy("event_id").count().collect()}
    assert got == {None: 1} | {i: 2 if i % 50 == 0 else 1 for i in range(1, 400)}
    assert with_defects(mapped).columns == mapped.columns


def test_a_batch_loaded_again_is_staged_once(spark, monkeypatch):
    staged, loaded = [], []
    monkeypatch.setattr(scenario, "written_staging", lambda b, path: staged.append(path) or (b, path))
    monkeypatch.setattr(jobs, "run_load", lambda s, files, root, ts: loaded.append((files[0], ts)) or {})
    scenario._loaded(spark, "no-folder-a-batch-loaded-again", "twice", lambda: ["b1", "b2", "b2", "b3"], ["t1", "t2", "t3", "t4"])
    assert [b for b, _ in loaded] == ["b1", "b2", "b2", "b3"] and len(staged) == 3


def test_large_dimensions_are_shuffled(spark):
    dim, facts = spark.range(50).withColumnRenamed("id", "k"), spark.range(90).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in _plan(facts.join(W.shuffled_if_large(dim), "k", "left"))
    large = spark.range(W.BROADCAST_ROWS + 1).withColumnRenamed("id", "k")
    assert "Broadcast" not in _plan(facts.join(W.shuffled_if_large(large).select("k"), "k", "left"))


def test_few_ids_are_looked_up_without_a_shuffle(spark):
    facts = spark.range(6000).select(
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("a"), F.col("id") % 900)).alias("orig_account_id"),
        F.concat(F.lit("x"), F.col("id")).alias("dest_account_id"), F.lit(None).cast("string").alias("dest_merchant_id"))
    dim = spark.createDataFrame([(f"a{i}", f"k{i}") for i in range(700)] + [("a1", "second")], "id string, key string")
    plain = facts.join(dim.withColumnRenamed("id", "orig_account_id"), "orig_account_id", "left").select(*facts.columns, "key")
    got = W.lookup(facts, dim, "orig_account_id", "key", W.hot_ids(facts, 2.0), among=facts)
    assert got.count() == plain.count() and got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    assert "SortMergeJoin" not in _plan(got) and "ShuffledHashJoin" not in _plan(got)


def test_loads_are_the_same_with_and_without_broadcasts(spark, tmp_dir, monkeypatch):
    raw = with_defects(events_as_transactions(_events(spark).where("event_id is not null"), keep_event_id=True)).drop("event_id")

    def loaded(name):
        batch = written_staging(transform(raw, "salt"), f"{tmp_dir}/{name}-staging")
        first = jobs.run_load(spark, batch, f"{tmp_dir}/{name}", "2024-02-01 00:00:00")
        changed = batch.dim_account.withColumn("account_status", F.when(F.col("account_id") < "8", "DORMANT").otherwise(F.col("account_status")))
        batch.dim_account = changed
        second = jobs.run_load(spark, batch, f"{tmp_dir}/{name}", "2024-03-01 00:00:00")
        return first, second, jobs.read_warehouse(spark, f"{tmp_dir}/{name}")

    few = loaded("few")
    monkeypatch.setattr(W, "BROADCAST_ROWS", -1)
    many = loaded("many")
    assert few[:2] == many[:2] and few[0]["fact"]["inserted"] > 0 and few[1]["accounts"]["closed_and_reopened"] > 0
    for a, b in zip(few[2].tables().values(), many[2].tables().values(), strict=True):
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
