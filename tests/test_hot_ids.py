"""One id with a third of all rows: the key lookups find it, spread its rows
and give the same keys as a plain join."""

from pyspark.sql import functions as F

from ledgerstar.operators import warehouse as W

COLUMNS = "orig_account_id string, dest_account_id string, dest_merchant_id string, date_key int, amount double"


def _facts(spark, n=12_000):
    third = (F.col("id") % 3 == 0)
    return spark.range(n).select(
        F.when(third, F.lit("hot")).otherwise(F.concat(F.lit("a"), F.col("id") % 700)).alias("orig_account_id"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).when(third, F.lit("gone")).otherwise(F.concat(F.lit("a"), F.col("id") % 900)).alias("dest_account_id"),
        F.when(F.col("id") % 5 == 0, F.lit("m")).alias("dest_merchant_id"), (F.col("id") % 31).cast("int").alias("date_key"), F.col("id").cast("double").alias("amount"))


def _accounts(spark):
    return spark.createDataFrame([(f"a{i}", f"k{i}") for i in range(800)] + [("hot", "kh")], "id string, key string")


def test_hot_ids_are_those_with_many_rows(spark):
    got = {(r.role, r.id): r.n for r in W.hot_ids(_facts(spark), share=0.1).collect()}
    assert got == {("orig_account_id", "hot"): 4000, ("dest_account_id", "gone"): 3200, ("dest_merchant_id", "m"): 2400}
    assert W.hot_ids(_facts(spark, 0), share=0.1).count() == 0


def test_lookup_equals_a_plain_join(spark):
    facts, dim = _facts(spark), _accounts(spark)
    for share in (0.1, 0.0005, 2.0):  # the common ids, nearly all of them, none
        hot = W.hot_ids(facts, share)
        for col in ("orig_account_id", "dest_account_id"):
            plain = facts.join(dim.select(F.col("id").alias(col), F.col("key").alias("k")), col, "left").select(*facts.columns, "k")
            got = W.lookup(facts, dim, col, "k", hot).select(*facts.columns, "k")
            assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_no_task_gets_the_hot_id(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(keep, ("false", "-1", "8"), strict=True):
            spark.conf.set(k, v)
        facts, dim = _facts(spark), _accounts(spark)
        for col in ("orig_account_id", "dest_account_id"):
            n = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
            with_hot, without = (n(W.lookup(facts, dim, col, "k", hot)) for hot in (W.hot_ids(facts, 0.1), W.hot_ids(facts, 2.0)))
            assert with_hot[-1] <= 2 * with_hot[len(with_hot) // 2]
            assert without[-1] > 2 * without[len(without) // 2]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
