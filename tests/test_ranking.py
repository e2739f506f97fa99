import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerstar.operators.ranking import global_ntiles, global_places, global_ranks


def _data(spark, n, seed, values):
    r = random.Random(seed)
    rows = [(f"{r.randrange(16**6):06x}{i}", None if r.random() < 0.3 else "x", r.choice(values), r.choice([None, 0.5, -2.25, 7.0]), i) for i in range(n)]
    return spark.createDataFrame(rows, "id string, region string, v long, d double, n long").withColumn("d", F.col("d").cast("decimal(20,2)"))


CASES = [(0, 5, [1]), (1, 5, [3]), (3, 5, [1, 2]), (7, 3, [0]), (500, 10, [1]), (997, 10, [-5, 0, 1, 2, 1000]), (800, 4, range(10_000)), (900, 7, [7, 7, 7, 1, 2, 3, None])]


def _order(by):
    return [by, F.col("id").asc_nulls_first(), F.col("region").asc_nulls_first()]


def test_several_measures_equal_the_windows(spark):
    for n, k, values in CASES:
        df = _data(spark, n, n, list(values))
        measures = {"up": F.col("v"), "down": -F.col("v"), "dec": F.col("d")}
        orders = {"up": F.col("v").asc_nulls_first(), "down": F.col("v").desc_nulls_first(), "dec": F.col("d").asc_nulls_first()}
        for got, ref in ((global_ntiles(df, measures, ["id", "region"], k), lambda w: F.ntile(k).over(w)),
                         (global_places(df, measures, ["id", "region"]).drop("_total"), lambda w: F.row_number().over(w)),
                         (global_ranks(df, measures, ["id", "region"]), None)):
            want = df
            for name, by in orders.items():
                want = want.withColumn(name, ref(Window.orderBy(*_order(by))) if ref else F.rank().over(Window.orderBy(by)))
            assert got.columns == want.columns
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str), (n, k)


def test_one_measure_and_a_number_as_key(spark):
    df = _data(spark, 300, 5, [7, 7, 1, 2, 3])
    got = global_places(df, {"place": F.col("v")}, ["n"])
    want = df.withColumn("place", F.row_number().over(Window.orderBy("v", "n")))
    assert sorted((r.n, r.place, r._total) for r in got.collect()) == sorted((r.n, r.place, 300) for r in want.collect())


def test_nothing_is_written_sampled_or_sent_to_one_task(spark):
    import os
    folder = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = set(os.listdir(folder))
    df = _data(spark, 500, 3, range(50))
    out = global_ntiles(df, {"a": F.col("v"), "b": -F.col("v"), "c": F.col("d")}, ["id", "region"], 5)
    out.collect()
    assert set(os.listdir(folder)) == before
    plan = out._jdf.queryExecution().toString()
    assert "Exchange SinglePartition" not in plan and "rangepartitioning" not in plan
    # one reading to count, one to place; the buckets reuse the first
    logical = out._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Generate explode") <= 3
