"""Day aggregates that merge, and account lookups, against the plain way."""

import datetime
import glob
import random
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerstar.operators.percentiles import bucket_bounds, value_bucket
from ledgerstar.plans import jobs, mart
from ledgerstar.plans.lookups import account_transactions
from ledgerstar.schemas import RAW_SCHEMA


def _rows(n, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        t = rnd.choice(["PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT"])
        dest = f"M{rnd.randint(1, 40)}" if t == "PAYMENT" else f"C{rnd.randint(1, 300)}"
        orig = "C0" if i % 3 == 0 else f"C{rnd.randint(1, 300)}"
        rows.append((1 + rnd.randint(0, 24 * 9), t, float(rnd.choice([0, 0.01, 5, 10, 10, 99.99, 1e6])) + i % 7, orig, 0.0, 0.0, dest, 0.0, 0.0, int(i % 50 == 0), 0))
    return rows


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("mart"))
    jobs.run_transform(spark.createDataFrame(_rows(4000, 1), RAW_SCHEMA), f"{root}/staging", "salt")
    jobs.run_load(spark, jobs.read_staged(spark, f"{root}/staging"), f"{root}/wh", "2024-02-01 00:00:00")
    wh = jobs.read_warehouse(spark, f"{root}/wh")
    mart.write_mart(wh, f"{root}/mart")
    return root, wh, mart.read_mart(spark, f"{root}/mart")


def _cont(values, p):
    v = sorted(values)
    h = 1 + (len(v) - 1) * Decimal(str(p))
    lo = int(h)
    return v[lo - 1] + (h - lo) * (v[min(lo, len(v) - 1)] - v[lo - 1])


@pytest.mark.parametrize(("first", "last"), [(1, 10), (3, 3), (2, 8)])
def test_range_percentiles(stored, first, last):
    _, wh, m = stored
    days = datetime.date(2024, 1, first), datetime.date(2024, 1, last)
    names = {0.0: "low", 0.5: "mid", 0.99: "high", 1.0: "top"}
    got = {r.type_code: r for r in mart.range_percentiles(wh, m, *days, list(names), list(names.values())).collect()}
    values = {}
    for t, a in (wh.fact_transactions.where(F.col("partition_date").between(*map(F.lit, days)))
                 .join(wh.dim_transaction_type, "transaction_type_key").select("type_code", "amount").collect()):
        values.setdefault(t, []).append(a)
    assert set(got) == set(values)
    for t, v in values.items():
        for p, name in names.items():
            assert Decimal(got[t][name]) == _cont(v, p), (t, p)


def test_a_range_without_rows(stored):
    _, wh, m = stored
    assert mart.range_percentiles(wh, m, datetime.date(2030, 1, 1), datetime.date(2030, 1, 2), [0.5], ["p"]).count() == 0
    empty = mart.filtered_feed(m, F.col("region") == "nowhere").first()
    assert (empty.txns, empty.accounts, empty.merchants) == (None, 0, 0)


def test_bucket_bounds_hold_their_values(spark):
    rnd = random.Random(2)
    values = [Decimal(rnd.randint(-10**k, 10**k)) / 100 for k in range(1, 16) for _ in range(40)] + [Decimal(0), Decimal("0.01"), Decimal("-0.01")]
    for v, b in spark.createDataFrame([(v,) for v in values], "v decimal(18,2)").select("v", value_bucket(F.col("v"))).collect():
        low, high = bucket_bounds(b)
        assert low <= v <= high, (v, b)


def test_filters_of_the_feed(stored):
    _, wh, m = stored
    total = wh.fact_transactions.count()
    regions = [r[0] for r in wh.dim_account.select("region").distinct().collect()]
    filters = [None, F.col("region") == regions[0], (F.col("region") != regions[0]) & F.col("type_code").isin("PAYMENT", "DEBIT"),
               F.col("partition_date") >= F.lit(datetime.date(2024, 1, 5))]
    for where in filters:
        est, exact = mart.filtered_feed(m, where).first(), mart.exact_distinct(wh, where).first()
        for c in ("accounts", "merchants"):
            assert abs(est[c] - exact[c]) <= max(1, mart.SIGMAS * mart.SKETCH_ERROR * exact[c])
    assert mart.filtered_feed(m).first().txns == total


def test_a_day_is_replaced(spark, stored, tmp_path):
    _, wh, m = stored
    path = str(tmp_path / "m")
    mart.write_mart(wh, path)
    day = F.col("partition_date") == F.lit(datetime.date(2024, 1, 4))
    one = jobs.Warehouse(wh.fact_transactions.where(day).limit(3), wh.dim_account, wh.dim_merchant, wh.dim_date, wh.dim_transaction_type)
    mart.write_mart(one, path)
    got = mart.read_mart(spark, path)
    n = lambda x: {r[0]: r[1] for r in x.groupBy("partition_date").agg(F.sum("txns")).collect()}
    want = n(m.histogram) | {datetime.date(2024, 1, 4): 3}
    assert n(got.histogram) == n(got.sketches) == want


def test_account_lookup(stored):
    _, wh, _ = stored
    for account in [r[0] for r in wh.dim_account.select("account_id").limit(3).collect()] + ["nobody"]:
        keys = wh.dim_account.where(F.col("account_id") == account).select("account_key")
        want = [wh.fact_transactions.join(keys.withColumnRenamed("account_key", c), c, "left_semi").count() for c in ("orig_account_key", "dest_account_key")]
        got = {r.direction: r["count"] for r in account_transactions(wh, account).groupBy("direction").count().collect()}
        assert [got.get("sent", 0), got.get("received", 0)] == want
    plan = account_transactions(wh, wh.dim_account.first()["account_id"], datetime.date(2024, 1, 2), datetime.date(2024, 1, 3))._jdf.queryExecution().toString()
    assert "PushedFilters: [In(orig_account_key" in plan.replace("IsNotNull(orig_account_key), ", "") or "EqualTo(orig_account_key" in plan


def test_facts_are_clustered_with_bloom_filters(spark, stored, tmp_path):
    """Small row groups of a day hold ranges of originators that do not
    overlap: a lookup reads one or two of them."""
    _, wh, _ = stored
    from ledgerstar.sources import snapshots
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "4096")
    conf.set("parquet.page.size", "1024")
    conf.set("parquet.block.size.row.check.min", "10")
    try:
        snapshots.write_parts(wh.fact_transactions, str(tmp_path / "f"), "partition_date", "orig_account_key", ["dest_account_key"])
    finally:
        for c in ("parquet.block.size", "parquet.page.size", "parquet.block.size.row.check.min"):
            conf.unset(c)
    groups = skipped = 0
    for path in glob.glob(str(tmp_path / "f" / "*" / "*.parquet")):
        meta = pq.ParquetFile(path).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        at = names.index("orig_account_key")
        ranges = [(meta.row_group(g).column(at).statistics.min, meta.row_group(g).column(at).statistics.max) for g in range(meta.num_row_groups)]
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
        key = ranges[0][0]
        groups += len(ranges)
        skipped += sum(not a <= key <= b for a, b in ranges)
    assert groups > 20 and skipped > groups / 2


def test_bloom_filters_serve_destinations(spark, stored, tmp_path):
    """Where a column outgrows its dictionary, which would serve as well, a
    row group has a Bloom filter."""
    _, wh, _ = stored
    from ledgerstar.sources import snapshots
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark._jvm.org.apache
    conf.set("parquet.enable.dictionary", "false")
    try:
        snapshots.write_parts(wh.fact_transactions.where("dest_account_key is not null"), str(tmp_path / "f"), "partition_date", "orig_account_key", ["dest_account_key"])
    finally:
        conf.unset("parquet.enable.dictionary")
    paths = glob.glob(str(tmp_path / "f" / "*" / "*.parquet"))
    assert paths
    for path in paths:
        reader = jvm.parquet.hadoop.ParquetFileReader.open(jvm.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.hadoop.fs.Path(path), conf))
        for block in reader.getFooter().getBlocks():
            with_bloom = {c.getPath().toDotString() for c in block.getColumns() if c.getBloomFilterOffset() > 0}
            assert with_bloom == {"dest_account_key"}
        reader.close()
