import random
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerstar.operators.percentiles import exact_percentiles, value_bucket


def _cont(values, p):
    """PERCENTILE_CONT on exact decimals."""
    v = sorted(values)
    h = 1 + (len(v) - 1) * Decimal(str(p))
    lo = int(h)  # floor for h >= 1
    hi = lo if h == lo else lo + 1
    return v[lo - 1] + (h - lo) * (v[hi - 1] - v[lo - 1])


def test_exact_percentiles_match_definition(spark):
    rnd = random.Random(5)
    rows = []
    for g, n in [("a", 1), ("b", 2), ("c", 37), ("d", 500)]:
        for _ in range(n):
            # many ties and a wide range of magnitudes
            rows.append((g, Decimal(rnd.choice([0, 1, 5, 10, 10, 250, 99999]) * 100 + rnd.randint(0, 3))
                         / Decimal(100)))
    df = spark.createDataFrame(rows, "g string, v decimal(18,2)")
    probs, names = [0.5, 0.9, 0.99], ["p50", "p90", "p99"]
    got = {r["g"]: r for r in exact_percentiles(df, "g", "v", probs, names).collect()}
    for g in "abcd":
        vals = [v for k, v in rows if k == g]
        for p, name in zip(probs, names):
            assert Decimal(got[g][name]) == _cont(vals, p), (g, name)


def test_value_bucket_is_monotone(spark):
    xs = sorted({round(random.Random(1).uniform(-1e6, 1e9), 2) for _ in range(1)} |
                {0.0, 0.01, 0.99, 1.0, 1.01, 2.0, 1e6, 1e6 + 0.01, -0.01, -5.0})
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    b = [r[0] for r in df.select(value_bucket(F.col("x"))).collect()]
    pairs = sorted(zip(xs, b))
    assert all(b1 <= b2 for (_, b1), (_, b2) in zip(pairs, pairs[1:]))
